"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
import warnings
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan here relies on: re-planning at run time, splitting of
# skewed join partitions even when that costs a shuffle, and a fixed time zone.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def check_settings(spark: SparkSession) -> None:
    """Dates and months depend on the time zone; a caller's session is checked, not changed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        warnings.warn(f"session time zone is {zone}: set spark.sql.session.timeZone to UTC or use session.tune", stacklevel=3)


def scratch_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names in spark.checkpoint.dir.

    Where nothing is named, a folder of the warehouse, which driver and executors share as
    well. On a cluster a warehouse on the machine's own disk is no such folder, and is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    check_shared(spark.sparkContext.master, scheme)
    return folder


def check_shared(master: str, scheme: str) -> None:
    """Executors of a cluster can't see a folder on the driver's disk."""
    if scheme == "file" and master.partition("[")[0] != "local":
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")


_stored: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, remembered for `clear_scratch`."""
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _stored:
        atexit.register(clear_scratch, spark)
    _stored.append(path)
    return path


def clear_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete what this process has stored, or what it stored after the first `since` tables."""
    conf = spark._jsc.hadoopConfiguration()
    while len(_stored) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(_stored.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Tables stored inside the block are deleted at its end."""
    before = len(_stored)
    try:
        yield
    finally:
        clear_scratch(spark, before)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Store a frame several branches read, so that it is computed once.

    A Parquet table in the shared folder: it cuts the lineage, survives executor loss,
    and each branch reads only the columns and rows it needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
