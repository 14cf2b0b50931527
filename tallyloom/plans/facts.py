"""Warehouse facts to the event rows the measures start from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates, logic
from tallyloom.operators import groups, joins


def attributed(df: DataFrame, rules: DataFrame, member: str, date: str, flag: str) -> DataFrame:
    """Rows of members that count for a site, with that site.

    ``rules`` is ``(member, site, valid_to, flag)``: an open ``valid_to`` or ``flag``
    does not restrict; a member counts before ``valid_to`` only, and only on rows whose
    ``flag`` column has the value of the rule.
    """
    tagged = rules.withColumnsRenamed({"member": member, "flag": "__flag"})
    before = logic.open_or(F.col("valid_to"), F.col(date) < F.col("valid_to").cast("date"))
    flagged = logic.open_or(F.col("__flag"), F.col(flag) == F.col("__flag"))
    return joins.join_where(df, tagged, [member], before & flagged).drop("valid_to", "__flag")


def billed_encounters(
    encounters: DataFrame, billing: DataFrame, owners: DataFrame, codes: Sequence[str], transaction: str = "charge"
) -> DataFrame:
    """Encounters with a positive billed quantity of the codes, and their owner of that day.

    ``encounters``: encounter, subject, owner_key, day, ...; ``billing``: encounter, code,
    quantity, transaction, inactive; ``owners``: owner_key, owner, valid_from, valid_to.
    Lines are summed per encounter and code before they meet the encounters.
    """
    quantity = (
        billing.filter(
            F.col("code").isin(list(codes)) & logic.eq_ci(F.col("transaction"), transaction) & (F.col("inactive") == 0)
        )
        .groupBy("encounter", "code")
        .agg(F.sum("quantity").alias("quantity"))
        .filter("quantity > 0")
    )
    held = encounters.filter("encounter > 0").join(quantity, "encounter")
    return joins.scd2_join(held, owners, ["owner_key"], "day", "valid_from", "valid_to").drop("valid_from", "valid_to")


def latest_answers(answers: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """The answers of each key given last; ties of every ordering column are kept."""
    return groups.keep_chain(answers.distinct(), keys, order)


def form_outcomes(
    rows: DataFrame, files: DataFrame, keys: Sequence[str], improved: Column, min_sessions: int = 6, quiet: int = 91
) -> DataFrame:
    """Improved and all patients of patient-level forms per file.

    A row counts when treatment ended in the report month ``month``, or after enough
    sessions with nothing seen for ``quiet`` days before the next month. Files without
    such a row give missing values.
    """
    ended = F.trunc("end_date", "MM") == F.col("month")
    gone = (F.col("sessions") >= min_sessions) & (
        F.col("last_seen") < F.date_sub(dates.ceil_month(F.col("month")), quiet)
    )
    counted = (
        rows.filter(F.col("pat_id").isNotNull() & (ended | gone))
        .groupBy(*keys)
        .agg(F.sum(improved).cast("double").alias("numerator"), F.count("*").cast("double").alias("denominator"))
    )
    return files.select(*keys).distinct().join(counted, list(keys), "left")
