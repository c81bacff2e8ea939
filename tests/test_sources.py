"""File sources and sinks, and the stream windows."""

from pyspark.sql import functions as F

from inkspring.sources import files
from inkspring.streaming import windows


def test_pages_in_natural_order(spark, tmp_path):
    for name in ("p10.png", "p2.PNG", "p1.jpg", "notes.txt"):
        (tmp_path / name).write_bytes(name.encode())
    assert [r["name"] for r in files.pages(spark, str(tmp_path)).orderBy("ordinal").collect()] == ["p1.jpg", "p2.PNG", "p10.png"]


def test_json_with_mark_and_broken(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b"\xef\xbb\xbf" + '{"id": "x", "dialogues": [{"text": "é"}, {"text": null}]}'.encode())
    (tmp_path / "b.json").write_text("{broken")
    schema = "id string, utterances array<struct<text:string>>, dialogues array<struct<text:string>>"
    docs = files.json_documents(spark, str(tmp_path), schema)
    assert docs.where("id is not null").count() == 1
    assert [tuple(r) for r in files.utterances(docs.where("id = 'x'"), "id").orderBy("reading_order").collect()] == [("x", 0, "é"), ("x", 1, None)]


def test_transcript(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, None, "b", True), (1, 0, "A", "a", True), (2, 0, "B", "x", False), (3, 0, "B", "y", True)], "page int, ord int, speaker string, text string, essential boolean")
    got = {r["page"]: r["value"] for r in files.transcript(rows).collect()}
    assert got == {1: "--- Page 1 ---\n<A>: a\n<Other>: b", 3: "--- Page 3 ---\n<B>: y"}
    files.write_csv(rows, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 4


def test_windows_as_stream(spark, sf):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    q = windows.tumbling(stream).writeStream.outputMode("append").format("memory").queryName("hours").trigger(availableNow=True).start()
    q.awaitTermination()
    done = {(r["start"], r["event_type"]): r["n"] for r in spark.table("hours").collect()}
    want = {(r["start"], r["event_type"]): r["n"] for r in windows.tumbling(batch).collect()}
    assert done and all(want[k] == n for k, n in done.items())
    assert windows.sessions(batch).agg(F.sum("n")).first()[0] == batch.count() == windows.sliding(batch).agg(F.sum("n")).first()[0] // 2
