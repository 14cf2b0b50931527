"""Numerator / denominator measures from event facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import groups, joins
from tallyloom.operators.groups import distinct_sets, merged_count


def event_measure(
    events: DataFrame, denominators: DataFrame, site: str, date: str, event: str
) -> DataFrame:
    """Distinct events per month and site, with the denominator of that site and month."""
    counted = events.groupBy(F.trunc(date, "MM").alias("month"), F.col(site).alias("site")).agg(
        F.countDistinct(event).cast("double").alias("numerator")
    )
    return joins.null_safe_join(counted, denominators, ["month", "site"], "left")


def events_after_first(
    events: DataFrame, scores: DataFrame, first_keys: Sequence[str], match_keys: Sequence[str], date: str, score_date: str
) -> DataFrame:
    """Events strictly after the subject's first score at that site.

    ``first_keys`` say whose scores compete for being the first; ``match_keys``, which may hold
    more (an attribution flag), have to agree with a row of that first day.
    """
    first = groups.keep_extreme(scores, first_keys, score_date, largest=False)
    first = first.select(*match_keys, F.col(score_date).alias("first_score")).distinct()
    return joins.null_safe_join(events, first, match_keys).filter(F.col(date) > F.col("first_score"))


def site_and_network_rates(
    population: DataFrame, events: DataFrame, member: str, event: str, network_sites: Sequence[str],
    network: str, zero_fill: bool = True, recount: bool = True, measure_names: Sequence[str] = (),
    dense_members: bool = False,
) -> DataFrame:
    """Monthly rates per site and for a network of sites.

    ``recount`` counts distinct members and events over the network's sites together, so one in
    two sites counts once; otherwise the network has the sums of the site values. With
    ``measure_names`` events carry a ``measure`` column, and every measure is set against the one
    population. ``dense_members`` says that members are whole numbers from 0 without large gaps:
    their sets are kept as bitmaps, and the network merges its sites' bitmaps instead
    of their members.
    """
    inside = F.col("site").isin(list(network_sites))
    # a row counts for its site and, inside the network, for the network: one pass for both
    levels = F.explode(F.array_compact(F.array(F.col("site"), F.when(inside, F.lit(network)))))

    def distinct(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
        spread = df.withColumn("site", levels) if recount else df
        return spread.groupBy(*by).agg(F.countDistinct(column).cast("double").alias(name))

    by = ["month", "site"]
    if dense_members and recount:
        sets = distinct_sets(population, by, member)
        den = merged_count(sets.withColumn("site", levels), by).withColumnRenamed("n", "denominator")
        den = den.withColumn("denominator", F.col("denominator").cast("double"))
    else:
        den = distinct(population, by, member, "denominator")
    if measure_names:
        by = ["measure", *by]
        den = den.withColumn("measure", F.explode(F.array(*[F.lit(m) for m in measure_names])))
    out = groups.ratio(distinct(events, by, event, "numerator"), den, by, zero_fill)
    if not recount:
        out = out.withColumn("site", levels).groupBy(*by).agg(
            F.sum("denominator").alias("denominator"), F.sum("numerator").alias("numerator")
        )
    level = F.when(F.col("site") == network, "Network").otherwise("Practice")
    return out.withColumn("aggregation", level)
