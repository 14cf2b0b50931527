"""Windows over keys that may hold a third of all rows.

A window gathers all rows of its key in one task. Here rows are dealt by ranges of key and order, so
that a large key lies in many ranges. Numbers, neighbours and running sums are made within each
stretch (the rows of one key in one range), and what a stretch needs from those before or after
it, a count, a sum or the values of one row, is handed on from range to range and joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.joins import null_safe_join
from tallyloom.session import materialise

_RANGE, _TIE = "__range", "__tie"


@dataclass(frozen=True)
class LongWindow:
    """Stored rows with the number of their range; missing values come first."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    ranges: int

    def add(
        self, number: str | None = None, lag: Mapping[str, str] | None = None, lead: Mapping[str, str] | None = None,
        total: Mapping[str, str] | None = None,
    ) -> LongWindow:
        """Add the row's number in its key, the value one row before or after (name -> column), and
        running sums (name -> column), which are missing while all values so far are."""
        lag, lead, total = dict(lag or {}), dict(lead or {}), dict(total or {})
        rows = self.rows.repartitionByRange(self.ranges, _RANGE)
        place = F.struct(*self.order, _TIE)
        here = Window.partitionBy(_RANGE, *self.keys).orderBy(*self.order, _TIE)
        so_far = here.rowsBetween(Window.unboundedPreceding, 0)
        local = rows.withColumns(
            {"__n": F.row_number().over(here), "__more": F.lead(F.lit(True)).over(here)}
            | {f"__lag_{n}": F.lag(c).over(here) for n, c in lag.items()}
            | {f"__lead_{n}": F.lead(c).over(here) for n, c in lead.items()}
            | {f"__sum_{n}": F.sum(c).over(so_far) for n, c in total.items()}
        )
        side = self._handed_on(rows, place, lag, lead, total)
        joined = null_safe_join(local, side, [_RANGE, *self.keys], "left")
        made = {}
        if number:
            made[number] = (F.col("__n") + F.coalesce("__before", F.lit(0))).cast("long")
        for n in lag:
            made[n] = F.when(F.col("__n") == 1, F.col(f"__first_{n}")).otherwise(F.col(f"__lag_{n}"))
        for n in lead:
            made[n] = F.when(F.col("__more").isNull(), F.col(f"__after_{n}")).otherwise(F.col(f"__lead_{n}"))
        for n in total:
            here_, before = F.col(f"__sum_{n}"), F.col(f"__total_{n}")
            made[n] = F.when(here_.isNotNull() & before.isNotNull(), here_ + before).otherwise(F.coalesce(here_, before))
        keep = [c for c in self.rows.columns if c not in made]
        return LongWindow(joined.select(*keep, *[c.alias(n) for n, c in made.items()]), self.keys, self.order, self.ranges)

    def _handed_on(self, rows: DataFrame, place, lag: dict, lead: dict, total: dict) -> DataFrame:
        """One row for the first and the last stretch of each range; only as many come to the driver."""
        stretches = rows.groupBy(_RANGE, *self.keys).agg(
            F.count("*").alias("n"),
            *[F.max_by(c, place).alias(f"lag_{n}") for n, c in lag.items()],
            *[F.min_by(c, place).alias(f"lead_{n}") for n, c in lead.items()],
            *[F.sum(c).alias(f"sum_{n}") for n, c in total.items()],
        )
        whole = F.struct(*[c for c in stretches.columns if c != _RANGE])
        by_key = F.struct(*self.keys)
        ends = stretches.groupBy(_RANGE).agg(
            F.min_by(whole, by_key).alias("head"), F.max_by(whole, by_key).alias("tail"), F.count("*").alias("stretches")
        )
        schema = ends.schema["head"].dataType
        found = sorted(ends.collect(), key=lambda r: r[_RANGE])
        key = lambda stretch: tuple(stretch[k] for k in self.keys)
        out: dict[tuple, dict] = {}
        carried: dict = {}
        for left, right in zip([None, *found[:-1]], found):
            if left is None or key(left["tail"]) != key(right["head"]):
                carried = {}
                continue
            tail, again = left["tail"], carried if left["stretches"] == 1 else {}
            carried = {"__before": tail["n"] + again.get("__before", 0)}
            for n in total:
                parts = [x for x in (tail[f"sum_{n}"], again.get(f"__total_{n}")) if x is not None]
                carried[f"__total_{n}"] = sum(parts[1:], parts[0]) if parts else None
            for n in lag:
                carried[f"__first_{n}"] = tail[f"lag_{n}"]
            out.setdefault((right[_RANGE], *key(right["head"])), {}).update(carried)
            after = {f"__after_{n}": right["head"][f"lead_{n}"] for n in lead}
            out.setdefault((left[_RANGE], *key(tail)), {}).update(after)
        made = [("__before", T.LongType())] + [(f"__total_{n}", schema[f"sum_{n}"].dataType) for n in total]
        made += [(f"__first_{n}", schema[f"lag_{n}"].dataType) for n in lag]
        made += [(f"__after_{n}", schema[f"lead_{n}"].dataType) for n in lead]
        fields = [rows.schema[_RANGE], *[rows.schema[k] for k in self.keys], *[T.StructField(n, t) for n, t in made]]
        data = [(*k, *[values.get(n) for n, _ in made]) for k, values in out.items()]
        return rows.sparkSession.createDataFrame(data, T.StructType([T.StructField(f.name, f.dataType) for f in fields]))

    def stored(self) -> LongWindow:
        """The same, written once, where several steps follow."""
        return LongWindow(materialise(self.rows, "ranges"), self.keys, self.order, self.ranges)

    def result(self) -> DataFrame:
        return self.rows.drop(_RANGE, _TIE)


def over(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> LongWindow:
    """Deal the rows by ranges of key and order; of rows equal in both any may come first, but always the same."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(ranges, *keys, *order, _TIE)
    # what lies in which range is decided once
    stored = materialise(dealt.withColumn(_RANGE, F.spark_partition_id()), "ranges")
    return LongWindow(stored, tuple(keys), tuple(order), ranges)


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """Number of each run of equal neighbouring values (missing ones are equal) in its key, and the row's number."""
    numbered = over(df, keys, order, ranges).add(number="row_no", lag={"__was": value})
    changed = ((F.col("row_no") == 1) | ~F.col(value).eqNullSafe(F.col("__was"))).cast("long")
    marked = LongWindow(
        numbered.rows.withColumn("__new", changed).drop("__was"), numbered.keys, numbered.order, numbered.ranges
    ).stored()
    return marked.add(total={"run_no": "__new"}).result().drop("__new")
