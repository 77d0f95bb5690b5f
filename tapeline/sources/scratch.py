"""A folder for tables that a query writes and reads again."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir, deleted when the driver exits; a temporary
    folder only where Spark runs on one machine and none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tapeline-")
        spark.sparkContext.setCheckpointDir(root)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/tapeline-{tag}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def clean() -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone
            fs.delete(path, True)

    atexit.register(clean)
    return path.toString()
