"""Places in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh(spark: SparkSession, name: str) -> str:
    """A path of its own under ``spark.checkpoint.dir``, or the session's checkpoint folder.

    Only a session that is one machine (master ``local``, as in tests) may have neither; it gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        path = jsc.getCheckpointDir().get()
    return f"{path.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
