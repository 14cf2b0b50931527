"""Folders of sheets landed as CSV: chosen by name, of differing columns, with their bad rows."""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.tables import file_name, with_file_meta

_STAMP = re.compile(r"^(.*?)\s*(\d{6})")
_BAD = "_corrupt_record"


@dataclass(frozen=True)
class NamedFile:
    """A file by its name: site and report month are missing where the name doesn't tell them."""

    path: str
    name: str
    site: str | None
    month: dt.date | None


def list_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[NamedFile]:
    """The files of a folder from its listing alone, in order of their names; none is opened."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = sorted((f.getPath().getName(), f.getPath().toString()) for f in found if f.isFile())
    return [_named(path, name) for name, path in names if name.endswith(suffix) and not name.startswith((".", "_"))]


def _named(path: str, name: str) -> NamedFile:
    m = _STAMP.match(name)
    if not m:
        return NamedFile(path, name, None, None)
    year, month = int(m[2][:4]), int(m[2][4:])
    return NamedFile(path, name, m[1].strip(), dt.date(year, month, 1) if year and 1 <= month <= 12 else None)


def choose(files: Sequence[NamedFile], prefixes: Sequence[str] = (), first_month: dt.date | None = None) -> list[NamedFile]:
    """Files whose site begins with one of the prefixes, from a report month on."""
    return [
        f for f in files
        if (not prefixes or (f.site or "").startswith(tuple(prefixes)))
        and (first_month is None or (f.month is not None and f.month >= first_month))
    ]


def read_files(spark: SparkSession, files: Sequence[NamedFile], schema: T.StructType, path_column: str = "file") -> DataFrame:
    """All rows of the files in the columns of ``schema``, with file, site, month and what is wrong.

    Columns are found by their header, whatever their order. A column a file lacks is missing in its
    rows, one that the schema doesn't know is left out. A value that doesn't fit its type is missing,
    and ``bad`` names the columns of such values; a line of another number of fields has ``bad`` as
    well. ``line`` holds the text of a bad line. Files of equal headers are read together.
    """
    columns = [path_column, "site", "month", *schema.fieldNames(), "bad", "line"]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        by_header.setdefault(_header(spark, f.path), []).append(f.path)
    # a file without a header has no rows
    frames = [_read(spark, paths, header, schema, path_column) for header, paths in by_header.items() if header]
    if not frames:
        kinds = [T.StructField(c, T.StringType()) for c in (path_column, "site")] + [T.StructField("month", T.DateType())]
        kinds += [*schema.fields, T.StructField("bad", T.StringType()), T.StructField("line", T.StringType())]
        return spark.createDataFrame([], T.StructType(kinds))
    return reduce(DataFrame.unionByName, frames).select(columns)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in a file's first line; an empty file has none."""
    first = spark.read.text(path).limit(1).collect()
    return tuple(v.strip() for v in next(csv.reader([first[0][0]]), ())) if first else ()


def _read(spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: T.StructType, path_column: str) -> DataFrame:
    # names of the file may repeat or be empty, so its columns go by number
    raw = [f"c{i}" for i in range(len(header))]
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*raw, _BAD]])
    df = (
        spark.read.schema(text).option("header", True).option("enforceSchema", True).option("nullValue", "NA")
        # all fields are parsed, or else a wrong number of them goes unnoticed
        .option("columnPruning", False).option("columnNameOfCorruptRecord", _BAD).csv(paths)
    )
    df = df.withColumn("__path", F.col("_metadata.file_path"))
    at = {name: c for c, name in reversed(list(zip(raw, header)))}  # the first of equal names counts
    given = {f.name: F.trim(F.col(at[f.name])) if f.name in at else F.lit(None).cast("string") for f in schema}
    typed = {f.name: given[f.name].try_cast(f.dataType) for f in schema}
    wrong = [F.when(given[n].isNotNull() & (given[n] != "") & typed[n].isNull(), F.lit(n)) for n in schema.fieldNames()]
    fields = F.when(F.col(_BAD).isNotNull(), F.lit("number of fields"))
    bad = F.array_join(F.array_compact(F.array(fields, *wrong)), ", ")
    bad = F.nullif(bad, F.lit(""))
    whole = F.array_join(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in raw]), ",")
    out = df.select(
        F.url_decode(file_name(F.col("__path"), "csv")).alias(path_column), *[typed[n].alias(n) for n in schema.fieldNames()],
        bad.alias("bad"), F.when(bad.isNotNull(), F.coalesce(F.col(_BAD), whole)).alias("line"),
    )
    return with_file_meta(out, path_column)
