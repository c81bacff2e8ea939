"""Streams: the append-only event log read as a stream, and the same windows over the finished table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspring.plans.windows import _SCENES
from inkspring.registry import query, table
from inkspring.sources import shared
from inkspring.streaming import reuse, state, windows


def _text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query("E22_tumbling_windows", oracle="SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(table(spark, sf_dir, "events")).select(_text("start").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


@query("E22_sliding_windows", oracle="SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS s FROM events) GROUP BY 1")
def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding(table(spark, sf_dir, "events")).select(_text("start").alias("start"), "n")


@query("E22_session_windows", oracle="WITH l AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k")
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sessions(table(spark, sf_dir, "events")).select("user_id", _text("start").alias("start"), "n")


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table read as a stream."""
    schema = table(spark, sf_dir, name).schema
    # a stream reads a folder: the table's own, or the one that holds its only file
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    own = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    reader = spark.readStream.schema(schema)
    return reader.parquet(f"{sf_dir}/{name}.parquet") if own else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query("E22_event_stream", oracle="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type of the event log read as a stream to its present end."""
    stream = streamed(spark, sf_dir, "events")
    name = f"events_{uuid.uuid4().hex}"
    q = stream.groupBy("event_type").agg(F.count("*").alias("n")).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


@query("W27_pending_stream", oracle="""WITH s AS (SELECT user_id, event_type, ts::DATE - DATE '1970-01-01' AS page FROM events GROUP BY ALL), n AS (SELECT *, lead(page) OVER (PARTITION BY user_id, event_type ORDER BY page) AS next FROM s)
SELECT user_id, event_type, page, CASE WHEN next IS NOT NULL AND next - page <= 1 THEN 'promoted' WHEN next IS NOT NULL OR page < (SELECT max(page) FROM s) - 1 THEN 'closed' ELSE 'pending' END AS state FROM n""")
def pending_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings decided by a stream with timers; those that still wait at its end are pending."""
    done = state.finished(state.decided(streamed(spark, sf_dir, "events"), 1), spark, "sightings")
    seen = table(spark, sf_dir, "events").select("user_id", "event_type", F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long").alias("page")).distinct()
    waiting = seen.join(done.select("user_id", "event_type", "page"), ["user_id", "event_type", "page"], "left_anti")
    return done.unionByName(waiting.withColumn("state", F.lit("pending")))


@query("W11_memory_stream", oracle=f"""WITH {_SCENES}, m AS (SELECT user_id, scene, event_id, ts, value, value >= 10 AS ok FROM s)
SELECT user_id, event_id, round(coalesce(sum(CASE WHEN ok THEN value END) OVER w, 0), 6) AS memory, last_value(CASE WHEN ok THEN event_id END IGNORE NULLS) OVER w AS previous, count(CASE WHEN NOT ok THEN 1 END) OVER w AS missing
FROM m WINDOW w AS (PARTITION BY user_id, scene ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def memory_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The memory of scenes as state of a stream; events of type error begin a scene."""
    e = streamed(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value", (F.col("event_type") == "error").alias("starts"))
    return state.finished(state.remembered(e), spark, "memory")


@query("U22_incremental", oracle="SELECT sha256(text) AS request, max(length(text)) AS n_chars, 'first' AS run FROM documents WHERE text IS NOT NULL GROUP BY 1")
def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of every distinct text, worked on once: a second run over the same stream finds them all."""
    path = shared.fresh(spark, "results")
    for run in ("first", "second"):
        requests = streamed(spark, sf_dir, "documents").where("text is not null").select(F.sha2("text", 256).alias("request"), "text")
        reuse.work_on(requests, lambda new: new.select("request", F.char_length("text").cast("long").alias("n_chars")), f"{path}/rows", f"{path}/log-{run}", run)
    return spark.read.schema("request string, n_chars long, run string, batch int").option("basePath", f"{path}/rows").parquet(f"{path}/rows").select("request", "n_chars", "run")
