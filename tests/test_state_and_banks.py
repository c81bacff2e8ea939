"""Streams with state over several batches, incremental reuse that runs again, and banks of vectors."""

import datetime

import pytest
from pyspark.sql import functions as F

from inkspring.operators import sequences as Q
from inkspring.plans import QUERIES
from inkspring.sources import bank
from inkspring.streaming import reuse, state

FIRST = datetime.datetime(2024, 1, 1, 9)
DAY_ONE = (FIRST - datetime.datetime(1970, 1, 1)).days
EVENTS = "user_id long, event_type string, ts timestamp"


def batches(spark, folder, days, schema=EVENTS):
    """A stream with one batch for every list of rows."""
    for i, rows in enumerate(days):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/b{i:02d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def sighting(user, day, hour=9, kind="a"):
    return (user, kind, datetime.datetime(2024, 1, 1 + day, hour))


def decided(spark, tmp_path, days, gap=1):
    done = state.finished(state.decided(batches(spark, tmp_path / "in", days), gap), spark, "t").collect()
    assert len(done) == len({(r["user_id"], r["page"]) for r in done})
    return {(r["user_id"], r["page"] - DAY_ONE): r["state"] for r in done}


def test_a_sighting_two_pages_later_does_not_promote(spark, tmp_path):
    assert decided(spark, tmp_path, [[sighting(1, 0)], [sighting(1, 2)]]) == {(1, 0): "closed"}


def test_a_sighting_on_the_next_page_promotes_across_batches(spark, tmp_path):
    assert decided(spark, tmp_path, [[sighting(1, 0), sighting(1, 0, 11)], [sighting(1, 1)], [sighting(1, 1, 22)]]) == {(1, 0): "promoted"}


def test_time_closes_what_nothing_follows(spark, tmp_path):
    """Another key's pages move the watermark; the first key gets no row any more."""
    got = decided(spark, tmp_path, [[sighting(1, 0), sighting(2, 0)], [sighting(2, 1)], [sighting(2, 2)], [sighting(2, 3)]])
    assert got == {(1, 0): "closed", (2, 0): "promoted", (2, 1): "promoted", (2, 2): "promoted"}


def test_a_wider_gap(spark, tmp_path):
    assert decided(spark, tmp_path, [[sighting(1, 0)], [sighting(1, 3)], [sighting(1, 4)]], gap=3) == {(1, 0): "promoted", (1, 3): "promoted"}


def test_streams_equal_the_finished_tables(spark, sf, tmp_path):
    """Many batches of the event log against the same rules over the whole table."""
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    days = [[tuple(r) for r in e.where((F.dayofmonth("ts") >= d) & (F.dayofmonth("ts") < d + 5)).select("user_id", "event_type", "ts", "event_id", "value").collect()] for d in range(1, 32, 5)]
    days = [d for d in days if d]
    stream = batches(spark, tmp_path / "e", days, EVENTS + ", event_id long, value double")
    done = {tuple(r) for r in state.finished(state.decided(stream, 1), spark, "p").collect()}
    page = F.floor(F.unix_millis("ts") / state.DAY).cast("long")
    want = {tuple(r) for r in Q.pending(e.select("user_id", "event_type", page.alias("page")).distinct(), ["user_id", "event_type"], "page", 1).select("user_id", "event_type", "page", "state").collect()}
    assert {r for r in want if r[3] != "pending"} == done and len(done) > 100
    rows = stream.select("user_id", "event_id", "ts", "value", (F.col("event_type") == "error").alias("starts"))
    memory = {tuple(r) for r in state.finished(state.remembered(rows), spark, "m").collect()}
    assert memory == {tuple(r) for r in QUERIES["W11_scene_memory"](spark, sf).select("user_id", "event_id", "memory", "previous", "missing").collect()}


def test_work_is_done_once(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", [[(1, "a"), (2, "b"), (3, "a")], [(4, "b"), (5, "c")]], "id long, text string")
    seen = []

    def work(new):
        out = new.select("request", F.upper("text").alias("result"))
        seen.append(sorted(r["result"] for r in out.collect()))
        return out

    def go(run, log):
        seen.clear()
        reuse.work_on(stream.select(F.sha2("text", 256).alias("request"), "text"), work, str(tmp_path / "sink"), str(tmp_path / log), run)
        rows = spark.read.option("basePath", str(tmp_path / "sink")).parquet(str(tmp_path / "sink"))
        return [list(s) for s in seen], sorted(r["result"] for r in rows.collect())

    assert go("one", "log1") == ([["A", "B"], ["C"]], ["A", "B", "C"])
    assert go("one", "log1") == ([], ["A", "B", "C"]), "nothing is new to the same log"
    assert go("two", "log2") == ([[], []], ["A", "B", "C"]), "another run finds all results"
    # batches of run one are run again, as after a loss of their log: they put the same rows in the same place
    assert go("one", "log3")[1] == ["A", "B", "C"]
    spark.createDataFrame([(9, "d")], "id long, text string").coalesce(1).write.parquet(str(tmp_path / "in" / "late"))
    assert go("two", "log2") == ([["D"]], ["A", "B", "C", "D"])


def meta(story, version=bank.VERSION, model="m", **config):
    import json

    return (story, json.dumps({"schema_version": version, "story_name": story, "model_fingerprint": model, "config": {k: str(v) for k, v in (bank.EXPECTED | config).items()}}))


def test_banks_come_back(spark, tmp_path):
    vectors = [("a/ä", "1", 0, [1.0, 2.0]), ("a/ä", "1", 1, [3.0, 4.0]), ("a/ä", "n/2", 0, [5.0, 6.0]), ("b", "1", 0, [7.0]), ("c", "1", 0, [8.0]), ("d", "1", 0, [9.0]), ("e", "1", 0, [1.5]), (None, "1", 0, [1.0]), ("b", None, 0, [1.0]), ("b", "2", 0, None)]
    docs = [meta("a/ä"), meta("b", max_crops_per_character=4), meta("c", version=2), meta("d", model="other"), meta("none")]
    bank.save(spark.createDataFrame(vectors, bank.SCHEMA), spark.createDataFrame(docs, "story string, json string"), str(tmp_path / "k"))
    banks, rows = bank.load(spark, str(tmp_path / "k"), "m")
    got = {r["story"]: (r["upgraded"], r["issue"], r["config"]["max_crops_per_character"]) for r in banks.collect()}
    assert got == {"a/ä": (False, None, "16"), "b": (True, None, "16"), "c": (False, "schema", "16"), "d": (False, "model", "16"), "none": (False, None, "16")}
    assert sorted(map(tuple, rows.collect())) == [("a/ä", "1", 0, [1.0, 2.0]), ("a/ä", "1", 1, [3.0, 4.0]), ("a/ä", "n/2", 0, [5.0, 6.0]), ("b", "1", 0, [7.0])]
    assert rows.rdd.getNumPartitions() >= 1 and len(list((tmp_path / "k" / "arrays").glob("*.npz"))) == 5 and not list((tmp_path / "k" / "arrays").glob("*.part"))
    # writing again puts the same archives in place
    bank.save(spark.createDataFrame(vectors, bank.SCHEMA), spark.createDataFrame(docs, "story string, json string"), str(tmp_path / "k"))
    assert bank.load(spark, str(tmp_path / "k"), "m")[1].count() == 4


def test_an_empty_bank_folder(spark, tmp_path):
    spark.dataSource.register(bank.BankSource)
    assert spark.read.format("bank").option("path", str(tmp_path / "nothing")).load().count() == 0


@pytest.mark.parametrize("kind", ["float32", "float64", "int16"])
def test_arrays_of_other_kinds_and_single_vectors(spark, tmp_path, kind):
    import numpy as np

    np.savez(tmp_path / "s.npz", x=np.array([[1, 2], [3, 4]], kind), y=np.array([5, 6], kind), z=np.zeros((0, 2), kind))
    spark.dataSource.register(bank.BankSource)
    rows = spark.read.format("bank").option("path", str(tmp_path)).load().orderBy("character", "ord").collect()
    assert [tuple(r) for r in rows] == [("s", "x", 0, [1.0, 2.0]), ("s", "x", 1, [3.0, 4.0]), ("s", "y", 0, [5.0, 6.0])]
