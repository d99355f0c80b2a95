"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Sizes that depend on the cluster (executors, shuffle partitions) are left to
# spark-submit; these are the switches every job wants.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "replylens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``. Where the driver and its
    executors are one process, a folder in the warehouse does as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what is in it goes when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


@contextlib.contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Writes inside give back the disk of their shuffles when they end.

    Otherwise it is held until the driver happens to collect its garbage, and jobs of several
    writes hold the shuffles of all of them.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cut_lineage(df: DataFrame, name: str = "table", compression: str | None = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What is read often, or by several parts of a plan, is then computed once, and a lost
    executor costs a re-read of files instead of a replay. Texts are most of what is stored, and
    zstd takes far less room for them than the default; None leaves the session's own.
    """
    path = new_folder(df.sparkSession, name)
    with shuffles_end(df.sparkSession):
        df.write.options(**({"compression": compression} if compression else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
