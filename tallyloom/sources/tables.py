"""Table, sheet and folder readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A landed warehouse table; filters and column choice reach the Parquet scan.

    A known schema spares the look into the files that infers it.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int
) -> DataFrame:
    """A warehouse table read in key ranges, one connection per range."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts
    )


def read_sheet(
    spark: SparkSession, path: str, schema: T.StructType, keep: Sequence[str] | None = None
) -> DataFrame:
    """A sheet landed as CSV: header line skipped, names and types from the schema.

    Text that does not fit the declared type becomes NULL.
    """
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return df.select(*keep) if keep else df


def parse_lines(df: DataFrame, line: str, ddl: str, keep: Sequence[str]) -> DataFrame:
    """The same typing for sheet lines that already sit in a text column."""
    return df.select(F.from_csv(line, ddl).alias("r")).select(*[F.col(f"r.{c}") for c in keep])


def read_folder(spark: SparkSession, glob: str) -> DataFrame:
    """Every file of a folder as one scan, with the file name of each row."""
    df = spark.read.parquet(glob)
    return df.withColumn("file", file_name(F.col("_metadata.file_path")))


def file_name(path: Column, suffix: str = "parquet") -> Column:
    """Name of a file, or of the folder that holds the part files of a table."""
    name = F.regexp_extract(path, rf"([^/]+\.{suffix})(?:/[^/]*)?$", 1)
    return F.when(name != "", name).otherwise(F.substring_index(path, "/", -1))


def with_file_meta(df: DataFrame, file: str = "file") -> DataFrame:
    """Site and report month from a name such as ``"Some Site 202512.xlsx"``."""
    stamp = F.regexp_extract(file, r"(\d{6})", 1)
    return df.withColumns(
        {
            "site": F.trim(F.regexp_extract(file, r"^(.*?)\s*\d{6}", 1)),
            "month": F.try_to_timestamp(F.concat(stamp, F.lit("01")), F.lit("yyyyMMdd")).cast("date"),
        }
    )


def files_from(df: DataFrame, prefixes: Sequence[str] = (), first_month: str | None = None) -> DataFrame:
    """Choose files by site prefix and from a report month on."""
    if prefixes:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | F.col("site").startswith(p)
        df = df.filter(hit)
    if first_month:
        df = df.filter(F.col("month") >= F.lit(first_month).cast("date"))
    return df


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def params(
    spark: SparkSession, rows: Sequence[tuple], schema: str, broadcast_rows: int = 10_000
) -> DataFrame:
    """A literal code list as a table; broadcast only while its row count is small."""
    df = spark.createDataFrame(list(rows), schema)
    return F.broadcast(df) if len(rows) <= broadcast_rows else df


def dates_as_text(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


def write_csv(df: DataFrame, path: str) -> None:
    """A folder with one file per partition: header line, dates as text, missing values as ``NA``.

    A result of bounded size that others read as one file goes to ``publish.publish_csv``.
    """
    dates_as_text(df).write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)
