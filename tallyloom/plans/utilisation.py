"""Encounters and claims of a population to site and network rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.operators import groups, joins
from tallyloom.plans import measures, reconcile

SHAPE = (
    "month", "skey", "encounter", "day", "day_key", "site", "subject", "source", "code_list", "birth", "age", "measure",
)
MERGE_KEY = ("month", "measure", "site", "subject", "day_key", "code_list")


def in_population(events: DataFrame, population: DataFrame, day: str = "day", max_age: int = 18) -> DataFrame:
    """Events of members of the month they fall in, below an age on that day.

    ``population``: month, subject, site, birth.
    """
    held = joins.join_in_month(events, population, ["subject"], day)
    return held.withColumn("age", dates.age_at(F.col("birth"), F.col(day))).filter(F.col("age") < max_age)


def with_codes(events: DataFrame, value_set: DataFrame, key: str, code: str, n: int = 3) -> DataFrame:
    """Events whose diagnosis is in a value set, with its first codes as one text."""
    return events.join(groups.code_list(value_set, [key], code, n), key)


def shaped(rows: DataFrame, skey: Column, source: Column | None = None) -> DataFrame:
    """One source in the common shape; ``skey`` is what the numerator counts."""
    out = rows.withColumns({"skey": skey, "day_key": dates.key_of_date(F.col("day"))})
    if source is not None:
        out = out.withColumn("source", source)
    return out.withColumn("source", F.col("source").cast("double")).select(*SHAPE)


def encounter_key(encounter: Column) -> Column:
    return F.concat(F.lit("X."), encounter.cast("string"))


def utilisation_rates(
    population: DataFrame, as_of_age: Column, sources: Sequence[DataFrame], network_sites: Sequence[str], network: str,
    max_age: int = 18, zero_fill: bool = True, recount: bool = True, dense_members: bool = False,
) -> DataFrame:
    """Merged sources over the population, per measure, month and site or network.

    Denominator: members below the age at the day ``as_of_age`` gives for a month. Of the
    rows for one subject, day and code list the lowest source number counts. ``dense_members`` as in
    ``measures.site_and_network_rates``.
    """
    young = population.filter(dates.age_at(F.col("birth"), as_of_age) < max_age)
    merged = reconcile.merge_priority(sources, MERGE_KEY, "source", [F.col("skey")])
    return measures.site_and_network_rates(
        young, merged, "subject", "skey", network_sites, network, zero_fill, recount,
        measure_names=(reconcile.INPATIENT, reconcile.ED), dense_members=dense_members,
    )
