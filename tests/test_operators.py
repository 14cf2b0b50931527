import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.functions import dates
from tallyloom.operators import calendar, groups, joins, project, setops, windows


def test_natural_join_matches_missing_keys(frame):
    a = frame("k string, f int, x int", ("p", 1, 10), ("p", None, 11), (None, None, 12))
    b = frame("k string, f int, y int", ("p", None, 1), (None, None, 2), ("q", 1, 3))
    assert rows(joins.natural_join(a, b), "k", "f", "x", "y") == [("p", None, 11, 1), (None, None, 12, 2)]
    right = joins.natural_join(a, b, "right")
    assert rows(right, "k", "f", "x", "y") == [("p", None, 11, 1), ("q", 1, None, 3), (None, None, 12, 2)]
    assert rows(joins.anti(a, b, ["k", "f"]), "x") == [(10,)]
    assert rows(joins.semi(a, b, ["k", "f"]), "x") == [(11,), (12,)]


def test_strict_inequality_left_join(frame):
    s = frame("k int, s date", (1, "2024-01-05"), (2, "2024-01-05"), (3, "2024-01-01"))
    e = frame("k int, e date", (1, "2024-01-05"), (1, "2024-01-06"), (1, "2024-01-09"), (2, "2024-01-05"))
    got = joins.left_join_where(s, e, ["k"], F.col("s") < F.col("e"), ["e"])
    assert rows(got, "k", "e") == [(1, "2024-01-06"), (1, "2024-01-09"), (2, None), (3, None)]
    plain = joins.join_where(s, e, ["k"], F.col("s") < F.col("e"), "left")
    assert rows(got, "k", "s", "e") == rows(plain, "k", "s", "e")


def test_right_join_then_filter_acts_as_inner(frame):
    a = frame("k int, own int", (1, 0), (2, 1))
    b = frame("k int, y int", (1, 7), (2, 8), (3, 9))
    assert rows(a.join(b, "k", "right").filter("own <> 1"), "k", "y") == [(1, 7)]


def test_either_key_matches_once(frame):
    fact = frame("id int, a int, b int", (1, 10, 10), (2, 10, 20), (3, None, 20), (4, 30, 40))
    dim = frame("d int, name string", (10, "x"), (20, "y"))
    assert rows(joins.join_either(fact, dim, ["a", "b"], "d"), "id", "name") == [(1, "x"), (2, "x"), (2, "y"), (3, "y")]


def test_version_valid_on_the_day(frame):
    fact = frame("k int, d date", (1, "2024-01-31"), (1, "2024-02-01"), (1, "2023-01-01"))
    dim = frame("k int, s date, e date, v int", (1, "2024-01-01", "2024-01-31", 1), (1, "2024-02-01", None, 2))
    assert rows(joins.scd2_join(fact, dim, ["k"], "d", "s", "e"), "d", "v") == [("2024-01-31", 1), ("2024-02-01", 2)]


def test_overlay_takes_the_right_value_where_present(frame):
    base = frame("k int, a int, b int", (1, 1, 1), (2, 2, 2))
    over = frame("k int, a int, b int", (1, 9, None))
    assert rows(joins.overlay(base, over, ["k"], ["a", "b"]), "k", "a", "b") == [(1, 9, 1), (2, 2, 2)]


def test_expand_months_clips_and_stays_empty_when_reversed(frame):
    df = frame("k int, s date, e date", (1, "2023-12-20", "2024-02-02"), (2, "2024-03-31", None), (3, "2024-05-01", None), (4, "2024-03-01", "2024-02-01"))
    lo, hi = dates.day("2024-01-01"), dates.day("2024-04-15")
    got = joins.expand_months(df, F.col("s"), F.col("e"), lo, hi)
    assert rows(got, "k", "month") == [(1, "2024-01-01"), (1, "2024-02-01"), (2, "2024-03-01"), (2, "2024-04-01")]


def test_uniqueness_check(frame):
    df = frame("k int, v int", (1, 1), (1, 2), (2, 3))
    assert rows(joins.duplicate_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(ValueError):
        joins.assert_unique(df, ["k"])
    assert joins.assert_unique(df, ["k", "v"]) is df


def test_null_rules_of_aggregates(frame):
    df = frame("g int, x int", (1, 5), (1, None), (1, 5), (2, 7), (3, None))
    agg = df.groupBy("g").agg(
        F.max("x").alias("skip"), groups.strict(F.max("x"), "x").alias("strict"),
        groups.count_distinct_with_null("x").alias("values"), F.countDistinct("x").alias("present"),
    )
    assert rows(agg) == [(1, 5, None, 2, 1), (2, 7, 7, 1, 1), (3, None, None, 1, 0)]


def test_extremes_keep_ties_and_missing_keys(frame):
    df = frame("k string, d int, v int", ("a", 1, 1), ("a", 3, 2), ("a", 3, 3), (None, 2, 4), (None, 1, 5), ("b", None, 6), ("c", 1, 7), ("c", None, 8))
    assert rows(groups.keep_extreme(df, ["k"], "d"), "v") == [(2,), (3,), (4,), (7,)]
    assert rows(groups.keep_extreme(df, ["k"], "d", largest=False), "v") == [(1,), (5,), (7,)]
    assert rows(groups.keep_extreme(df, ["k"], "d", strict_nulls=True), "v") == [(2,), (3,), (4,)]


@pytest.mark.parametrize(
    "order, kept",
    [
        ([("a", True), ("b", True)], [(2,), (3,)]),
        ([("a", True), ("b", False)], [(1,)]),
        ([("a", False), ("b", False)], [(5,)]),
    ],
)
def test_tie_break_chain(frame, order, kept):
    df = frame("k int, a int, b int, v int", (1, 9, 1, 1), (1, 9, 4, 2), (1, 9, 4, 3), (1, 9, None, 4), (1, 2, 8, 5), (1, None, 9, 6))
    assert rows(groups.keep_chain(df, ["k"], order), "v") == kept


def test_chain_without_second_value_drops_the_group(frame):
    df = frame("k int, a int, b int", (1, 9, None), (1, 2, 5))
    assert rows(groups.keep_chain(df, ["k"], [("a", True), ("b", True)])) == []


def test_singletons(frame):
    df = frame("k int, v string", (1, "a"), (1, "b"), (2, "c"), (None, "d"))
    assert rows(groups.keep_singletons(df, ["k"])) == [(2, "c"), (None, "d")]


def test_code_list_and_pivot_number_within_their_key(frame):
    df = frame("k int, s string, c string", (1, "x", "F3"), (1, "x", "F1"), (1, "x", "F1"), (1, "x", "F2"), (1, "x", "F4"), (1, "y", "G1"))
    assert rows(groups.code_list(df, ["k", "s"], "c"), "k", "s", "code_list") == [(1, "x", "F1; F2; F3"), (1, "y", "G1")]
    assert rows(groups.pivot_rownum(df, ["k", "s"], "c", 3)) == [(1, "x", "F1", "F2", "F3"), (1, "y", "G1", None, None)]


def test_ratio_zero_fill(frame):
    num, den = frame("k int, numerator int", (1, 3)), frame("k int, denominator int", (1, 6), (2, 5))
    assert rows(groups.ratio(num, den, ["k"]), "k", "numerator") == [(1, 3.0), (2, 0.0)]
    assert rows(groups.ratio(num, den, ["k"], zero_fill=False), "k", "numerator") == [(1, 3.0)]


def test_runs_and_their_lengths(frame):
    df = frame("s string, t int, v string", *[("a", i, v) for i, v in enumerate("YYNYYY")], ("b", 0, "Y"))
    got = rows(windows.runs(df, ["s"], ["t"], "v"), "s", "t", "run_no", "run_pos", "run_len")
    assert got == [("a", 0, 1, 1, 2), ("a", 1, 1, 2, 2), ("a", 2, 2, 1, 1), ("a", 3, 3, 1, 3), ("a", 4, 3, 2, 3), ("a", 5, 3, 3, 3), ("b", 0, 1, 1, 1)]


def test_fill_goes_one_step_only(frame):
    df = frame("k int, t int, v int", (1, 1, 5), (1, 2, None), (1, 3, None))
    assert rows(windows.fill1(df, ["k"], ["t"], "v"), "t", "v") == [(1, 5), (2, 5), (3, None)]


def test_upsert_is_idempotent(frame):
    old, new = frame("k string, v int", ("a", 1), ("b", 2), (None, 3)), frame("k string, v int", ("b", 9), ("c", 8), (None, 7))
    once = setops.upsert(old, new, ["k"])
    assert rows(once) == [("a", 1), ("b", 9), ("c", 8), (None, 7)]
    assert rows(setops.upsert(once, new, ["k"])) == rows(once)


def test_ordered_upserts_equal_a_chain(frame):
    base = frame("k int, v string", (1, "base"), (2, "base"), (3, "base"), (3, "base2"))
    a = frame("k int, v string", (2, "a"), (3, "a"), (4, "a"))
    b = frame("k int, v string", (3, "b"), (4, "b"), (5, "b"))
    c = frame("k int, v string", (4, "c"), (1, "c"))
    chain = setops.upsert(setops.upsert(base, a, ["k"]).unionByName(b), c, ["k"])
    assert rows(setops.upsert_all(base, [(a, True), (b, False), (c, True)], ["k"])) == rows(chain)


def test_append_is_strict_about_names(frame):
    from pyspark.errors import AnalysisException

    a, b = frame("x int, month date", (1, "2024-01-01")), frame("x int, report_month date", (2, "2024-02-01"))
    with pytest.raises(AnalysisException):
        setops.append(a, b).collect()
    assert rows(setops.append_aligned(a, b, {"report_month": "month"})) == [(1, "2024-01-01"), (2, "2024-02-01")]


def test_column_runs_and_unpivot(frame):
    df = frame("a int, b int, c int, d int", (1, 2, 3, 4))
    assert project.cols_between(df, "b", "d").columns == ["b", "c", "d"]
    assert rows(project.unpivot(df, ["a"], {"b": "B", "c": "C"}, "m", "v")) == [(1, "B", 2), (1, "C", 3)]


def test_calendar(frame):
    lo, as_of = dates.day("2024-01-01"), dates.day("2024-03-31")
    months = frame("x int", (1,)).select(F.explode(calendar.month_array(lo, as_of, 30)).alias("month"))
    assert rows(months) == [("2024-01-01",), ("2024-02-01",), ("2024-03-01",)]
    assert rows(calendar.closed_months(months, as_of)) == [("2024-01-01",), ("2024-02-01",)]
    assert rows(calendar.closed_months(months, dates.day("2024-03-10"), 15)) == [("2024-01-01",)]
    assert rows(calendar.index_months(months, dates.day("2024-01-15"), as_of)) == [("2024-02-01", "2024-02-29")]
    grid = calendar.month_grid(frame("site string", ("a",), ("b",)), ["m", "n"], lo, as_of)
    assert grid.count() == 2 * 2 * 3
