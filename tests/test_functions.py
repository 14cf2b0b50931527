import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.functions import dates, logic, numbers, text


def one(frame, kind, value, expr):
    return frame(f"x {kind}", (value,)).select(expr.alias("y")).collect()[0][0]


@pytest.mark.parametrize(
    "day, floor, ceil, end",
    [
        ("2024-01-31", "2024-01-01", "2024-02-01", "2024-01-31"),
        ("2024-02-29", "2024-02-01", "2024-03-01", "2024-02-29"),
        ("2024-03-01", "2024-03-01", "2024-04-01", "2024-03-31"),
    ],
)
def test_month_boundaries(frame, day, floor, ceil, end):
    d = F.col("x")
    df = frame("x date", (day,)).select(dates.floor_month(d), dates.ceil_month(d), dates.month_end(d))
    assert rows(df) == [(floor, ceil, end)]


@pytest.mark.parametrize(
    "birth, on, age",
    [
        ("2004-02-29", "2022-02-28", 17),
        ("2004-02-29", "2022-03-01", 18),
        ("2004-05-10", "2022-05-10", 18),
        ("2004-05-10", "2022-05-09", 17),
        ("2004-05-10", "2022-04-30", 17),
        ("2004-05-10", "2022-06-01", 18),
    ],
)
def test_age_turns_on_the_birthday(frame, birth, on, age):
    df = frame("b date, d date", (birth, on))
    assert rows(df.select(dates.age_at(F.col("b"), F.col("d")))) == [(age,)]


def test_date_keys_and_sentinels(frame):
    df = frame("k int", (20240229,), (-1,), (None,))
    assert rows(df.select("k", dates.date_of_key(F.col("k")))) == [(-1, None), (20240229, "2024-02-29"), (None, None)]


def test_month_names_both_ways(frame):
    df = frame("m string", ("September",), ("Sept",)).select("m", dates.month_no(F.col("m")))
    assert rows(df) == [("Sept", None), ("September", "09")]
    assert one(frame, "date", "2024-09-30", dates.month_name(F.col("x"))) == "September"


def test_parse_date_ignores_the_time_part(frame):
    assert str(one(frame, "string", "3/9/2024 0:00", dates.parse_date(F.col("x")))) == "2024-03-09"


def test_negated_membership_and_missing_values(frame):
    df = frame("x string", ("a",), ("b",), (None,))
    assert rows(df.filter(logic.not_in(F.col("x"), ["a"]))) == [("b",), (None,)]
    assert rows(df.filter(logic.not_in_sql(F.col("x"), ["a"]))) == [("b",)]


def test_if_else_keeps_unknown(frame):
    df = frame("x int", (1,), (3,), (None,))
    assert rows(df.select("x", logic.if_else(F.col("x") > 2, "hi", "lo"))) == [(1, "lo"), (3, "hi"), (None, None)]


def test_case_without_match_is_null(frame):
    df = frame("x int", (1,), (2,), (9,))
    rules = [(F.col("x") == 1, "one"), (F.col("x") <= 2, "few")]
    assert rows(df.select("x", logic.case(rules))) == [(1, "one"), (2, "few"), (9, None)]


def test_open_interval(frame):
    df = frame("s date, e date", ("2024-01-01", None), ("2024-01-01", "2024-02-01"), ("2024-03-01", None))
    kept = df.filter(logic.valid_on(dates.day("2024-02-02"), F.col("s"), F.col("e")))
    assert rows(kept) == [("2024-01-01", None)]


def test_text_helpers(frame):
    assert one(frame, "string", "CHSN LIBERTY primary", text.prefixed_title(F.col("x"), "CHSN ")) == "CHSN Liberty Primary"
    assert one(frame, "string", "Some Site 202512.xlsx", text.first_number(F.col("x"))) == "202512"
    assert one(frame, "string", "none", text.first_number(F.col("x"))) is None
    assert one(frame, "string", "3/9/24 extra piece", text.split_first(F.col("x"))) == "3/9/24"
    assert one(frame, "double", 1234567.5, text.thousands(F.col("x"))) == "1,234,568"
    assert one(frame, "double", 2.5, text.thousands(F.col("x"))) == "2"
    assert one(frame, "string", None, text.join_present("; ", F.lit("a"), F.col("x"), F.lit("b"))) == "a; b"


def test_bad_numbers_and_empty_denominators(frame):
    assert one(frame, "string", "S9485", numbers.to_num(F.col("x"))) is None
    assert one(frame, "double", 0.0, numbers.rate(F.lit(1.0), F.col("x"))) is None


@pytest.mark.parametrize("code, hit", [("0456", False), ("0450", True), ("045", False), ("04501", False)])
def test_anchored_character_class(frame, code, hit):
    assert one(frame, "string", code, F.col("x").rlike("^045[^6]$")) is hit


def test_case_insensitive_equality(frame):
    assert one(frame, "string", "Charge", logic.eq_ci(F.col("x"), "charge")) is True
