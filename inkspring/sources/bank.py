"""Character banks: one archive of arrays per story (``<story>.npz``), and its metadata as one JSON document.

``BankSource`` (format ``bank``) reads and writes the archives: a partition is one archive, a row one vector of a character. Archives are
reached through Arrow's file systems, so any store that these open will do. ``load`` joins them with the metadata.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from inkspring.sources.files import json_documents

SCHEMA = "story string, character string, ord int, vector array<float>"
_ARROW = pa.schema([("story", pa.string()), ("character", pa.string()), ("ord", pa.int32()), ("vector", pa.list_(pa.float32()))])

# The version of the metadata, and the settings that an older bank is raised to.
VERSION = 1
EXPECTED = {"min_crops_per_character": 2, "max_crops_per_character": 16, "min_embeddings_per_character": 2, "max_embeddings_per_character": 16, "prototype_strategy": "closest-2-to-16-paired-mean-v2"}


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Archive(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class BankReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        """One partition an archive; a folder that is not there, or is empty, has one partition without rows."""
        store, at = _place(self.path)
        found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
        return [Archive(i.base_name) for i in sorted(found, key=lambda i: i.base_name) if i.is_file and i.extension == "npz"] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, at = _place(self.path)
        with store.open_input_stream(f"{at}/{partition.name}") as f, np.load(io.BytesIO(f.read()), allow_pickle=False) as arrays:
            story = unquote(partition.name.removesuffix(".npz"))
            for key in sorted(arrays.files):
                rows = np.atleast_2d(arrays[key].astype(np.float32))
                n, width = rows.shape
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([story] * n), pa.array([unquote(key)] * n), pa.array(np.arange(n, dtype=np.int32)), vectors], schema=_ARROW)


class BankWriter(DataSourceWriter):
    """Rows come sorted by story, character and ord within a partition, a story in one partition (``save`` sees to it)."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        store, at = _place(self.path)
        store.create_dir(at, recursive=True)
        for story, rows in groupby(iterator, key=lambda r: r["story"]):
            arrays = {quote(c, safe=""): np.array([r["vector"] for r in some], np.float32) for c, some in groupby(rows, key=lambda r: r["character"])}
            name = f"{at}/{quote(story, safe='')}.npz"
            held = io.BytesIO()
            np.savez(held, **arrays)
            # written aside and moved, so that a task that is lost or run again leaves a whole archive
            with store.open_output_stream(f"{name}.{id(held)}.part") as f:
                f.write(held.getvalue())
            store.move(f"{name}.{id(held)}.part", name)
        return WriterCommitMessage()


class BankSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bank"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BankReader:
        return BankReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> BankWriter:
        return BankWriter(self.options["path"])


def save(vectors: DataFrame, metadata: DataFrame, path: str) -> None:
    """Write ``vectors(story, character, ord, vector)`` as archives and ``metadata(story, json)`` beside them.

    A story is one archive by its format, so its vectors meet in one task; stories are dealt over all tasks.
    """
    vectors.sparkSession.dataSource.register(BankSource)
    whole = vectors.where("story is not null and character is not null and vector is not null").selectExpr("story", "character", "cast(ord as int) ord", "cast(vector as array<float>) vector")
    whole.repartition("story").sortWithinPartitions("story", "character", "ord").write.format("bank").mode("append").option("path", f"{path}/arrays").save()
    metadata.select("story", F.col("json").alias("value")).write.mode("overwrite").partitionBy("story").text(f"{path}/metadata")


def _setting(key: str) -> Column:
    return F.get_json_object("config", f"$.{key}")


def load(spark: SparkSession, path: str, model: str) -> tuple[DataFrame, DataFrame]:
    """(banks, vectors): the state of every bank of a folder, and the vectors of the good ones.

    ``banks``: story, version, model, upgraded (an older setting was raised) and issue: ``schema`` for another version,
    ``model`` for vectors of another model; the config as it counts from now on. A bank without metadata has no vectors;
    one without an archive is empty.
    """
    spark.dataSource.register(BankSource)
    docs = json_documents(spark, f"{path}/metadata/*", "schema_version int, story_name string, model_fingerprint string, config map<string,string>").where("story_name is not null")
    old = F.lit(False)
    for key, value in EXPECTED.items():
        old = old | ~F.coalesce(F.element_at("config", key) == str(value), F.lit(False))
    raised = F.create_map(*[x for k, v in EXPECTED.items() for x in (F.lit(k), F.lit(str(v)))])
    kept = F.map_filter(F.coalesce("config", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(*EXPECTED))
    issue = F.when(~F.coalesce(F.col("schema_version") == VERSION, F.lit(False)), "schema").when(~F.coalesce(F.col("model_fingerprint") == model, F.lit(False)), "model")
    banks = docs.select(F.col("story_name").alias("story"), F.col("schema_version").alias("version"), F.col("model_fingerprint").alias("model"), old.alias("upgraded"), issue.alias("issue"), F.map_concat(kept, raised).alias("config"))
    arrays = spark.read.format("bank").option("path", f"{path}/arrays").load()
    return banks, arrays.join(banks.where("issue is null").select("story"), "story", "left_semi")
