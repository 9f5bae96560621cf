"""Session set-up and the shared folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "curbcount", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the zone pinned and adaptive execution on.

    The number of shuffle partitions is left to the cluster: it is an upper bound that
    adaptive execution coalesces, so it should be set from the data size
    (bytes shuffled / ~128 MB), not from the code.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a missing
    setting is an error, since executors do not share the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="curbcount-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or below the open scratch folder."""
    root = _scratch.get() or f"{shared_dir(spark)}/curbcount"
    return f"{root}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Collects the intermediate tables of a job that runs to its end, and removes them after.

    Frames built inside read from this folder, so they must be written out before it closes.
    """
    root = new_path(spark, "scratch")
    token = _scratch.set(root)
    try:
        yield root
    finally:
        _scratch.reset(token)
        remove(spark, root)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own tables, wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with data that outlives any executor, and gives the optimizer the
    real size of the result.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
