"""The fixed measure schema and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURE_ROW = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("month", T.DateType()),
        T.StructField("numerator", T.DoubleType()),
        T.StructField("denominator", T.DoubleType()),
        T.StructField("network", T.StringType()),
        T.StructField("aggregation", T.StringType()),
    ]
)

SERIES_KEY = ("site", "measure")
ROW_KEY = ("site", "measure", "month")


def measure_rows(df: DataFrame) -> DataFrame:
    """Bring a frame into the measure schema; a missing column is an error."""
    missing = [f.name for f in MEASURE_ROW if f.name not in df.columns]
    if missing:
        raise ValueError(f"not measure rows, missing {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in MEASURE_ROW])
