"""Served result files: each publication is a new version, readers follow the last full one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbcount import schemas
from curbcount.session import remove

#: Versions that stay beside the newest one, for readers that have just opened them.
KEEP_VERSIONS = 5


def publish(df: DataFrame, root: str, epoch: int, run: str = "", keep: int = KEEP_VERSIONS) -> str:
    """Write one version with a header, then announce it.

    The announcement is written after the data job has committed, so a reader never meets a
    half-written result. ``run`` names what counts the epochs (a stream's checkpoint): the same epoch of
    the same run replaces its own version, any other is newer than all before, so a job that starts
    again at epoch 0 is still served. All but the newest ``keep`` versions before it are removed.
    """
    spark = df.sparkSession
    marks = [r.asDict() for r in _marks(spark, root)]
    own = [m["version"] for m in marks if (m["run"], m["epoch"]) == (run, epoch)]
    newest = max((m["version"] for m in marks), default=-1)
    version = own[0] if own else max(newest + 1, epoch)
    data = f"{root}/data/version={version:012d}"
    df.write.mode("overwrite").option("header", True).csv(data)
    mark = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(run).alias("run"), F.lit(epoch).cast("bigint").alias("epoch"))
    mark.coalesce(1).write.mode("overwrite").json(f"{root}/published/mark={version:012d}")
    for old in sorted(m["version"] for m in marks if m["version"] < version)[: -keep or None]:
        remove(spark, f"{root}/published/mark={old:012d}")
        remove(spark, f"{root}/data/version={old:012d}")
    return data


def _marks(spark: SparkSession, root: str) -> list:
    """The few announcements that stand; none before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/published")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return spark.read.schema("version BIGINT, run STRING, epoch BIGINT").json(f"{root}/published").select("version", "run", "epoch").collect()


def latest_version(spark: SparkSession, root: str) -> int:
    """Number of the last announced version."""
    return max(r["version"] for r in _marks(spark, root))


def read_latest(spark: SparkSession, root: str, schema: StructType | list[str] | str) -> DataFrame:
    path = f"{root}/data/version={latest_version(spark, root):012d}"
    reader = spark.read.schema(schemas.resolve(schema)).option("header", True)
    return reader.option("enforceSchema", False).csv(path)
