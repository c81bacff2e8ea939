"""Model inference as a pluggable provider: pure functions of a request, run in batches on the executors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Provider(Protocol):
    """What a model must offer; it is sent to the executors, so it must be picklable and cheap to open."""

    name: str

    def infer(self, requests: list[str]) -> list[str]: ...


class Fixed:
    """A provider without a model: the answer is a digest of the request. Deterministic, for tests and dry runs."""

    name = "fixed"

    def infer(self, requests: list[str]) -> list[str]:
        return [hashlib.sha256(r.encode()).hexdigest()[:12] for r in requests]


def answered(requests: DataFrame, provider: Provider, done: DataFrame | None = None) -> DataFrame:
    """key, request_hash, answer for ``requests(key, request)``.

    Equal requests are asked once. Answers in ``done(request_hash, answer)`` are reused, so a rerun asks nothing twice.
    """
    hashed = requests.withColumn("request_hash", F.sha2(F.concat(F.lit(provider.name + "\0"), "request"), 256))
    asked = hashed.select("request_hash", "request").dropDuplicates(["request_hash"])
    if done is not None:
        asked = asked.join(done, "request_hash", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"request_hash": f["request_hash"], "answer": provider.infer(f["request"].tolist())})

    new = asked.mapInPandas(run, "request_hash string, answer string")
    known = new if done is None else new.unionByName(done.select("request_hash", "answer"))
    return hashed.join(known, "request_hash", "left").select("key", "request_hash", "answer")


def batches(rows: DataFrame, key: str, order: str, cost: str, limit: int) -> DataFrame:
    """``rows`` with batch: consecutive rows of a key whose costs start within the same ``limit`` of the running sum."""
    from pyspark.sql import Window as W

    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("batch", F.floor(F.coalesce(F.sum(cost).over(w), F.lit(0)) / limit))
