"""Results that others read while they are replaced: one CSV file, and tables by month."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import setops
from tallyloom.sources.tables import dates_as_text


def _hadoop(spark: SparkSession, path: str):
    """Hadoop's path, and the file system it lies on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _replace(spark: SparkSession, source, target) -> None:
    """Rename over an existing file in one step of the file system."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark._sc._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(source, target, how)


def publish_csv(df: DataFrame, path: str, order: Sequence[str | Column], header: bool = True) -> None:
    """Write one CSV file of exactly this name, its rows in the given order.

    Header line, dates as text, missing values as ``NA``. For results of a bounded size, since one task
    writes them. The file is written beside its place and renamed into it when it is complete: a reader
    sees the old file or the new one, and after a failure the old one stays as it was.
    """
    spark = df.sparkSession
    target, fs = _hadoop(spark, path)
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    folder = _hadoop(spark, aside)[0]
    try:
        one = dates_as_text(df.coalesce(1).sortWithinPartitions(*order))
        one.write.option("header", header).option("nullValue", "NA").csv(aside)
        parts = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        if len(parts) > 1:
            raise RuntimeError(f"{aside} has {len(parts)} parts")
        if not parts:  # a frame without partitions has no part file
            raise ValueError("nothing was written")
        _replace(spark, parts[0], target)
    finally:
        fs.delete(folder, True)


def write_months(df: DataFrame, path: str, month: str = "month") -> None:
    """Replace the months that ``df`` has in a Parquet table kept by month; the others keep their files.

    Files of a month are written aside and the month's folder is moved into place when all tasks
    have ended, so nobody reads half a month, and a write that was cut off can be repeated.
    """
    (
        df.repartition(F.col(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month)
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, like: DataFrame, month: str = "month") -> DataFrame:
    """The table with the columns and types of ``like``; months that aren't asked for aren't listed."""
    return spark.read.schema(like.schema).parquet(path).select(like.columns)


def redeliver(path: str, new: DataFrame, keys: Sequence[str], month: str = "month") -> None:
    """New rows replace those of their key in the table, month by month.

    Only the months of the delivery are read, merged and replaced; ``keys`` includes the month. Twice
    the same delivery changes nothing, so a delivery that failed on its way is simply repeated.
    """
    if month not in keys:
        raise ValueError(f"{month} has to be one of the keys")
    spark = new.sparkSession
    months = [r[0] for r in new.select(month).distinct().collect()]  # as many as the calendar has
    if None in months:
        raise ValueError("a row of a delivery has no month")
    if months:
        old = read_months(spark, path, new, month).filter(F.col(month).isin(months))
        write_months(setops.upsert(old, new, keys), path, month)
