"""Stateful streams: sightings that wait for another one, and what a scene knows of its past.

Both keep a few values a key in the state store. A micro-batch bounds how many rows of a key are sorted at once; the
trigger sets its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from inkspring.sources import shared

DAY = 86_400_000
#: The state store that keeps typed state; a session may have set another one.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class PendingWindow(StatefulProcessor):
    """A sighting waits: another at most ``gap`` pages later promotes it, a later one or the passing of time closes it."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "page long")

    def _expiry(self, page: int) -> int:
        return (page + self.gap + 1) * DAY

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pages = sorted({int(p) for part in rows for p in part["page"]})
        before = self.waiting.get()[0] if self.waiting.exists() else None
        if before is not None:
            self.handle.deleteTimer(self._expiry(before))
        out = []
        for page in pages:
            if before is not None and page != before:
                out.append((*key, before, "promoted" if page - before <= self.gap else "closed"))
            before = page
        self.waiting.update((before,))
        self.handle.registerTimer(self._expiry(before))
        yield pd.DataFrame(out, columns=["user_id", "event_type", "page", "state"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        page = self.waiting.get()[0]
        self.waiting.clear()
        yield pd.DataFrame([(*key, page, "closed")], columns=["user_id", "event_type", "page", "state"])

    def close(self) -> None:
        pass


class SceneMemory(StatefulProcessor):
    """What each event of a user knows of the ones before it in its scene; a start marker begins a scene and forgets."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("memory", "total double, previous long, missing long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, previous, missing = self.memory.get() if self.memory.exists() else (0.0, None, 0)
        out = []
        for r in pd.concat(list(rows)).sort_values(["ts", "event_id"]).itertuples():
            if r.starts:
                total, previous, missing = 0.0, None, 0
            out.append((key[0], int(r.event_id), round(total, 6), previous, missing))
            if r.value >= 10:
                total, previous = total + float(r.value), int(r.event_id)
            else:
                missing += 1
        self.memory.update((total, previous, missing))
        made = pd.DataFrame(out, columns=["user_id", "event_id", "memory", "previous", "missing"])
        yield made.astype({"previous": "Int64"})

    def close(self) -> None:
        pass


def finished(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run a stream over all that is there now, into a table in the shared folder, and read that."""
    path = shared.fresh(spark, name)
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/log").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STORE[0], before) if before else spark.conf.unset(STORE[0])
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def decided(sightings: DataFrame, gap: int) -> DataFrame:
    """user_id, event_type, page, state of the sightings of a stream ``(user_id, event_type, ts)`` as they are decided.

    Pages are days; time passes with the watermark, which closes what has waited too long.
    """
    rows = sightings.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / DAY).cast("long").alias("page"))
    grouped = rows.withWatermark("ts", "0 seconds").groupBy("user_id", "event_type")
    return grouped.transformWithStateInPandas(PendingWindow(gap), "user_id long, event_type string, page long, state string", "Append", "EventTime")


def remembered(events: DataFrame) -> DataFrame:
    """user_id, event_id, memory, previous, missing of a stream ``(user_id, event_id, ts, value, starts)``."""
    return events.groupBy("user_id").transformWithStateInPandas(SceneMemory(), "user_id long, event_id long, memory double, previous long, missing long", "Append", "None")
