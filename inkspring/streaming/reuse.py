"""Incremental reuse: a stream of requests, of which only those without a stored result are worked on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspring.sources import shared


def work_on(requests: DataFrame, work: Callable[[DataFrame], DataFrame], sink: str, log: str, run: str) -> None:
    """Run ``work`` on the new requests of a stream ``(request, ...)`` and add its rows to ``sink``.

    Every batch meets the results that are there by an anti-join on the request (a hash of all inputs), works once on
    each new request, and writes a folder of its own (``run`` and number of the batch), in place of what an attempt of
    the same batch left. So a batch that runs again adds nothing, and neither does a new run over the same requests.
    """
    spark = requests.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        new = rows.dropDuplicates(["request"])
        if shared.exists(spark, sink):
            known = spark.read.option("basePath", sink).parquet(sink).where(~((F.col("run") == run) & (F.col("batch") == number)))
            new = new.join(known.select("request"), "request", "left_anti")
        work(new).write.mode("overwrite").parquet(f"{sink}/run={run}/batch={number}")

    requests.writeStream.foreachBatch(batch).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
