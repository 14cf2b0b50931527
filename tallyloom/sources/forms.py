"""Form cells ``(file, sheet, row, col, value)`` to typed values.

A form has a fixed number of cells, so one group per file stays small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extract_cells(
    cells: DataFrame, layout: DataFrame, kind: str = "kind", names: Sequence[str] = ()
) -> DataFrame:
    """Named numbers of each file, from the cell positions its layout kind gives them.

    ``cells`` carries the layout kind of its file; ``layout`` is
    ``(kind, sheet, row, col, name)``. A form without the cell gives NULL.
    """
    at = cells.join(layout, [kind, "sheet", "row", "col"], "left")
    number = F.col("value").try_cast("double")
    return at.groupBy("file").agg(
        *[F.max(F.when(F.col("name") == n, number)).alias(n) for n in names]
    )


def extract_block(
    cells: DataFrame, first_row: int, last_row: int | None, columns: Mapping[int, tuple[str, str]]
) -> DataFrame:
    """A cell block as typed rows; rows whose cells are all empty are dropped.

    ``columns`` maps a column number to its name and type.
    """
    inside = F.col("row") >= first_row
    if last_row is not None:
        inside = inside & (F.col("row") <= last_row)
    block = cells.filter(inside & F.col("col").isin(list(columns)) & F.col("value").isNotNull())
    return block.groupBy("file", "row").agg(
        *[
            F.max(F.when(F.col("col") == c, F.col("value"))).try_cast(kind).alias(name)
            for c, (name, kind) in columns.items()
        ]
    )


def or_placeholder(files: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per known file: the aggregated row, or missing values when it had none."""
    return files.select(*keys).distinct().join(rows, list(keys), "left")


def turnover(leavers: Column, opening: Column, closing: Column) -> Column:
    """Leavers over mean headcount; no headcount gives NULL."""
    return F.try_divide(leavers, (opening + closing) / F.lit(2.0))
