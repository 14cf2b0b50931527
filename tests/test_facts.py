from pyspark.sql import functions as F

from conftest import rows
from tallyloom.functions import dates
from tallyloom.plans import episodes, facts, reconcile, utilisation

ED, IP = reconcile.ED, reconcile.INPATIENT


def test_attribution_by_date_and_flag(spark, frame):
    rules = spark.createDataFrame(
        [("a", "s1", "2023-07-02", None), ("b", "s1", None, 77), ("c", "s2", None, None)],
        "member string, site string, valid_to string, flag int",
    )
    df = frame(
        "id int, who string, d date, dept int",
        (1, "a", "2023-07-01", 1), (2, "a", "2023-07-02", 1), (3, "b", "2024-01-01", 77), (4, "b", "2024-01-01", 5), (5, "c", "2025-01-01", 5), (6, "x", "2024-01-01", 77),
    )
    got = facts.attributed(df, rules, "who", "d", "dept")
    assert rows(got, "id", "site") == [(1, "s1"), (3, "s1"), (5, "s2")]


def test_billed_encounters(frame):
    enc = frame("encounter int, subject int, owner_key int, day date", (1, 10, 7, "2024-01-05"), (2, 10, 7, "2024-02-05"), (3, 11, 7, "2024-01-05"), (-1, 12, 7, "2024-01-05"))
    bill = frame(
        "encounter int, code string, quantity double, transaction string, inactive int",
        (1, "90791", 1.0, "Charge", 0), (1, "90791", 1.0, "charge", 0), (2, "90791", 1.0, "Charge", 0), (2, "90791", -1.0, "Charge", 0),
        (3, "90791", 1.0, "Payment", 0), (3, "90791", 1.0, "Charge", 1), (3, "11111", 1.0, "Charge", 0), (-1, "90791", 1.0, "Charge", 0),
    )
    own = frame("owner_key int, owner string, valid_from date, valid_to date", (7, "old", "2023-01-01", "2024-01-31"), (7, "new", "2024-02-01", None))
    assert rows(facts.billed_encounters(enc, bill, own, ["90791"]), "encounter", "quantity", "owner") == [(1, 2.0, "old")]


def test_latest_answers_keep_ties_then_lowest_owner(frame):
    df = frame("k int, at int, owner string, v int", (1, 5, "b", 1), (1, 5, "a", 2), (1, 5, "a", 2), (1, 4, "a", 3), (1, 5, "a", 4))
    assert rows(facts.latest_answers(df, ["k"], [("at", True), ("owner", False)]), "v") == [(2,), (4,)]


def test_form_rows_of_the_report_month(frame):
    form = frame(
        "site string, month date, pat_id string, start_score double, end_date date, end_score double, last_seen date, sessions double",
        ("a", "2024-03-01", "1", 20.0, "2024-03-31", 8.0, "2024-03-31", 3.0), ("a", "2024-03-01", "2", 20.0, "2024-02-29", 8.0, "2024-02-28", 3.0),
        ("a", "2024-03-01", "3", 20.0, None, 19.0, "2023-12-31", 6.0), ("a", "2024-03-01", "4", 20.0, None, 1.0, "2024-01-01", 6.0),
        ("a", "2024-03-01", None, 20.0, "2024-03-02", 8.0, None, 6.0), ("b", "2024-03-01", "5", 20.0, None, None, None, None),
    )
    got = facts.form_outcomes(form, form, ["site", "month"], episodes.improved(F.col("start_score"), F.col("end_score")))
    # 91 days before 1 April is 1 January, which is not before itself
    assert rows(got, "site", "numerator", "denominator") == [("a", 1.0, 2.0), ("b", None, None)]


def test_utilisation_flow(frame):
    pop = frame(
        "month date, subject int, site string, birth date",
        ("2024-01-01", 1, "x", "2010-01-01"), ("2024-01-01", 2, "y", "2010-01-01"), ("2024-01-01", 3, "y", "2006-01-15"), ("2024-01-01", 4, "z", "2010-01-01"),
    )
    enc = frame(
        "encounter int, subject int, day date, dx int, source int, measure string",
        (10, 1, "2024-01-05", 1, 1, IP), (11, 1, "2024-02-05", 1, 1, IP), (12, 3, "2024-01-14", 1, 3, ED), (13, 3, "2024-01-15", 1, 3, ED), (14, 2, "2024-01-31", 9, 1, IP),
    )
    codes = frame("dx int, code string", (1, "F32"), (1, "F31"))
    inside = utilisation.with_codes(utilisation.in_population(enc, pop), codes, "dx", "code")
    assert rows(inside, "encounter", "code_list", "age") == [(10, "F31; F32", 14), (12, "F31; F32", 17)]
    own = utilisation.shaped(inside, utilisation.encounter_key(F.col("encounter")))
    claim = utilisation.shaped(inside.filter("encounter = 10"), F.lit("claim.1"), F.lit(2.1))
    got = utilisation.utilisation_rates(pop, F.last_day("month"), [claim, own], ["x", "y"], "net")
    assert rows(got, "measure", "site", "numerator", "denominator") == [
        (ED, "net", 1.0, 2.0), (ED, "x", 0.0, 1.0), (ED, "y", 1.0, 1.0), (ED, "z", 0.0, 1.0),
        (IP, "net", 1.0, 2.0), (IP, "x", 1.0, 1.0), (IP, "y", 0.0, 1.0), (IP, "z", 0.0, 1.0),
    ]
