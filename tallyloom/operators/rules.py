"""Rules kept as rows: codes to classes by prefix, joined instead of written as conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULE = "rule int, prefix string, exact boolean"


def by_prefix(df: DataFrame, code: str, rules: DataFrame, values: Sequence[str], longest: bool = True) -> DataFrame:
    """Every row with the ``values`` of the rule that its code meets; missing where it meets none.

    ``rules``: rule (a number), prefix, exact, and the values. A rule with ``exact`` wants the whole
    code, any other one that begins with its prefix; an empty prefix holds for every code. Of several
    the longest prefix counts, an exact one before others of its length, and then the smallest rule
    number; with ``longest=False`` the smallest rule number alone, as in an ordered list. Missing
    codes meet no rule.

    Only the different codes are compared: each is cut to the prefix lengths that the rules have
    and equi-joined to them, so a rule table may be as large as it likes.
    """
    sizes = sorted(r[0] for r in rules.select(F.length("prefix")).distinct().collect() if r[0] is not None)
    codes = df.select(F.col(code).alias("__code")).filter("__code IS NOT NULL").distinct()
    cuts = codes.withColumn("__n", F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"))).filter(
        F.length("__code") >= F.col("__n")
    ).withColumn("__prefix", F.expr("substring(__code, 1, __n)"))
    met = cuts.join(rules.withColumnRenamed("prefix", "__prefix"), "__prefix").filter(
        ~F.coalesce("exact", F.lit(False)) | (F.length("__code") == F.col("__n"))
    )
    first = [(-F.col("__n")).alias("n"), (~F.coalesce("exact", F.lit(False))).alias("open")] if longest else []
    best = met.groupBy("__code").agg(F.min_by(F.struct(*values), F.struct(*first, "rule")).alias("__best"))
    joined = df.join(best, F.col(code) == F.col("__code"), "left")
    return joined.select(*df.columns, *[F.col("__best")[v].alias(v) for v in values])
