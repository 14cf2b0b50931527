"""Encounter and claim classes, matching and source priority."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates, logic
from tallyloom.operators import groups, joins, setops

INPATIENT = "Inpatient Admissions"
ED = "ED Visits (Discharged)"

@dataclass(frozen=True)
class CodeClass:
    """Codes listed exactly, or by prefix unless a longer prefix rules them out.

    ``length`` and ``least`` bound how long a code with one of the prefixes is.
    """

    exact: Sequence[str] = ()
    prefixes: Sequence[str] = ()
    unless: Sequence[str] = ()
    length: int | None = None
    least: int = 0

    def holds(self, code: Column) -> Column:
        # prefix tests work on the bytes of the code and are cheaper than patterns
        def any_prefix(values: Sequence[str]) -> Column:
            return reduce(lambda a, b: a | b, [code.startswith(v) for v in values], F.lit(False))

        fits = F.length(code) == self.length if self.length else F.length(code) >= self.least
        return code.isin(list(self.exact)) | (any_prefix(self.prefixes) & ~any_prefix(self.unless) & fits)


# Revenue code classes.
REVENUE_CLASS = {
    "urgent": CodeClass(exact=("0456",)),
    "emergency": CodeClass(exact=("0981",), prefixes=("045",), unless=("0456",)),
    "observation": CodeClass(exact=("0760", "0762", "0769")),
    "inpatient": CodeClass(exact=("1000", "1001", "1002"), prefixes=("01", "020", "021"), unless=("018",)),
}


# The same classes where claims aren't mapped to an encounter. Its patterns ask for
# exactly four characters after 045 and for a third character after 01.
UNMAPPED_REVENUE_CLASS = REVENUE_CLASS | {
    "emergency": CodeClass(exact=("0981",), prefixes=("045",), unless=("0456",), length=4),
    "inpatient": CodeClass(exact=("1000", "1001", "1002"), prefixes=("01", "020", "021"), unless=("018",), least=3),
}


@dataclass(frozen=True)
class EncounterLists:
    """Code lists of the encounter rules, all parameters."""

    inpatient_types: Sequence = ()
    ed_types: Sequence = ()
    untyped: object = None
    untyped_name: str = "Hospital Encounter"
    excluded_classes: Sequence = ()
    elective: Sequence[str] = ("Elective", "Routine Elective")
    bed_classes: Sequence[str] = ("Observation", "Inpatient Encounter")
    observation: str = "Observation"
    expired: str = "Expired"


def encounter_rules(lists: EncounterLists) -> list[tuple[Column, str]]:
    """The ordered rules of an encounter's measure; the first that holds counts.

    Reads type_category, encounter_type, is_outpatient, is_admission, patient_class,
    class_category, disposition, admission_type, is_ed, has_following_admission and
    message_type. A missing flag counts as none, a missing code is in no list.
    """
    c = F.col
    untyped = (c("type_category") == F.lit(lists.untyped)) & (c("encounter_type") == lists.untyped_name)

    def flag(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0))

    def of(name: str, values: Sequence) -> Column:
        return F.coalesce(c(name).isin(list(values)), F.lit(False))

    inpatient = (
        (of("type_category", lists.inpatient_types) | untyped)
        & (flag("is_outpatient") != 1)
        & ((c("is_admission") == 1) | (c("patient_class") == lists.observation))
        & (F.coalesce(c("disposition"), F.lit("")) != lists.expired)
    )
    ed = (
        (of("type_category", lists.ed_types) | untyped)
        & ~of("class_category", lists.excluded_classes)
        & ~of("admission_type", lists.elective)
        & (c("is_ed") == 1)
        & (flag("is_admission") == 0)
        & (flag("has_following_admission") == 0)
        & ~of("message_type", lists.bed_classes)
        & ~of("patient_class", lists.bed_classes)
    )
    return [(inpatient, INPATIENT), (ed, ED)]


def classify(df: DataFrame, rules: Sequence[tuple[Column, str]], name: str = "measure") -> DataFrame:
    """Ordered rules, first match wins; rows without a match are dropped."""
    return df.withColumn(name, logic.case(rules)).filter(F.col(name).isNotNull())


def source_class(own: Column, claims: Column, hidden: Column, billing: Column) -> Column:
    """Source 1-4 from four 0/1 flags, NULL for other combinations."""
    return logic.case(
        [
            ((own == 1) & (claims == 0) & (hidden == 0) & (billing == 0), 1),
            ((own == 0) & (claims == 1) & (hidden == 1) & (billing == 1), 2),
            ((own == 0) & (claims == 0) & (hidden == 1) & (billing == 0), 3),
            ((own == 0) & (claims == 1) & (hidden == 1) & (billing == 0), 4),
        ]
    )


def line_flags(df: DataFrame, code: str, classes: Mapping[str, CodeClass] = REVENUE_CLASS) -> DataFrame:
    """0/1 flag per code class."""
    return df.withColumns(
        {name: F.when(c.holds(F.col(code)), 1).otherwise(0) for name, c in classes.items()}
    )


def claim_class(
    lines: DataFrame, keys: Sequence[str], code: str, admission: Column | None = None,
    classes: Mapping[str, CodeClass] = REVENUE_CLASS,
) -> DataFrame:
    """Line codes to claim flags to claim class; unclassified claims are dropped.

    ``admission`` is a 0/1 line flag that rules out the emergency class.
    """
    admitted = F.lit(0) if admission is None else admission
    claims = (
        line_flags(lines.withColumn("admitted", admitted), code, classes)
        .groupBy(*keys)
        .agg(*[F.max(n).alias(n) for n in [*classes, "admitted"]])
    )
    bed = (F.col("observation") == 1) | (F.col("inpatient") == 1)
    calm = (F.col("emergency") == 0) & (F.col("urgent") == 0)
    ed_only = (F.col("emergency") == 1) & (F.col("urgent") == 0) & ~bed & (F.col("admitted") == 0)
    return classify(claims, [(bed & calm, INPATIENT), (ed_only, ED)])


def unmatched(
    claims: DataFrame, mapped: DataFrame, claim_key: Sequence[str], reported: DataFrame, same: Sequence[str]
) -> DataFrame:
    """Claims not mapped to an encounter and without an equal line already reported."""
    return joins.anti(joins.anti(claims, mapped, claim_key), reported, same)


def unmatched_in_population(
    claims: DataFrame, mapped: DataFrame, claim_key: Sequence[str], reported: DataFrame, same: Sequence[str],
    population: DataFrame, value_set: DataFrame, member: str, code: str, start: str, end: str, birth: str,
    one_per: Sequence[str], order: Sequence[Column], max_age: int = 18,
) -> DataFrame:
    """Unmatched claims of a month's population, as a source of measures.

    The claim starts and ends inside a month in which ``population`` (member, month) holds its
    subject, its code is in ``value_set``, the subject is younger than ``max_age`` at its start,
    and of equal ``one_per`` columns the first row in ``order`` stays.
    """
    inside = F.col(end) <= F.last_day(start)
    young = dates.age_at(F.col(birth), F.col(start)) < max_age
    rows = unmatched(claims.filter(inside & young), mapped, claim_key, reported, same)
    rows = joins.semi(rows, value_set, [code])
    rows = joins.join_in_month(rows, population.select(member, "month").distinct(), [member], start)
    return groups.head_per(rows, one_per, order)


def merge_priority(
    frames: Sequence[DataFrame], keys: Sequence[str], source: str, tie: Sequence[Column] = ()
) -> DataFrame:
    """Sources in one shape; per key the row with the lowest source number."""
    return groups.head_per(setops.append(*frames), keys, [F.col(source), *tie])
