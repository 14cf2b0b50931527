import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.functions import dates
from tallyloom.plans import measures, population, reconcile


def bounds():
    return dates.day("2024-01-01"), dates.day("2024-04-01")


def test_latest_assignment_per_month(frame):
    df = frame(
        "m int, start date, name string",
        (1, "2023-06-01", "old"), (1, "2023-09-09", "b"), (1, "2023-09-09", "a"), (1, "2024-02-28", "feb"), (1, "2024-02-10", "early feb"), (2, "2024-05-01", "late"),
    )
    got = population.latest_member(df, "m", "start", [F.col("name")], *bounds())
    assert rows(got, "month", "name") == [("2024-01-01", "a"), ("2024-02-01", "feb"), ("2024-03-01", "feb"), ("2024-04-01", "feb")]


def test_trailing_days_reach_into_the_next_month(frame):
    df = frame("m int, d date", (1, "2024-01-31"), (2, "2024-01-01"), (3, "2024-02-01"), (4, "2024-03-02"), (5, "2024-01-30"), (6, "2024-01-02"))
    got = rows(population.active_members(df, ["m"], "d", *bounds()), "month", "m")
    # 30 days to 31 January start on the 2nd; those to 29 February on 31 January
    assert got == [("2024-01-01", 1), ("2024-01-01", 5), ("2024-01-01", 6), ("2024-02-01", 1), ("2024-02-01", 3), ("2024-03-01", 4)]


def test_all_spans_must_cover_the_month_start(frame):
    df = frame("m int, s1 date, e1 date, s2 date, e2 date", (1, "2023-12-15", "2024-03-01", "2024-01-01", None), (2, "2024-01-02", None, "2023-01-01", None), (3, "2024-01-01", "2024-01-31", "2024-01-01", "2024-03-31"))
    got = population.valid_members(df, ["s1", "s2"], ["e1", "e2"], *bounds())
    assert rows(got, "m", "month") == [
        (1, "2024-01-01"), (1, "2024-02-01"), (1, "2024-03-01"), (2, "2024-02-01"), (2, "2024-03-01"), (2, "2024-04-01"), (3, "2024-01-01"),
    ]


def test_eligibility_flag(frame):
    months = ["2024-01-01", "2024-02-01", "2024-03-01"]
    pop = frame("m int, month date", *[(k, month) for k in (1, 2, 3, 4) for month in months])
    spans = frame("m int, s date, e date, death date", (1, "2024-01-31", "2024-03-01", None), (2, "2023-01-01", None, "2024-02-01"), (3, "2024-02-01", "2024-02-01", None))
    got = population.eligibility_flag(pop, spans, "m", "s", "e", "death", *bounds()).filter("eligible = 1")
    assert rows(got, "m", "month") == [(1, "2024-01-01"), (1, "2024-02-01"), (2, "2024-01-01")]
    assert population.eligibility_flag(pop, spans, "m", "s", "e", "death", *bounds()).count() == 12


@pytest.mark.parametrize(
    "code, kind",
    [("0456", "urgent"), ("0450", "emergency"), ("0459", "emergency"), ("0981", "emergency"), ("0762", "observation"), ("0120", "inpatient"), ("0180", None), ("0209", "inpatient"), ("0219", "inpatient"), ("0220", None), ("1000", "inpatient"), ("10001", None), (None, None)],
)
def test_revenue_code_classes(frame, code, kind):
    df = reconcile.line_flags(frame("c string", (code,)), "c")
    hit = [n for n in reconcile.REVENUE_CLASS if df.select(n).collect()[0][0] == 1]
    assert hit == ([kind] if kind else [])


def test_claim_class(frame):
    lines = frame(
        "claim int, c string, adm int",
        (1, "0120", 0), (1, "0300", 0), (2, "0120", 0), (2, "0450", 0), (3, "0450", 0), (4, "0450", 1), (5, "0762", 0), (6, "0450", 0), (6, "0456", 0), (7, "0300", 0),
    )
    got = reconcile.claim_class(lines, ["claim"], "c", F.col("adm"))
    assert rows(got, "claim", "measure") == [(1, reconcile.INPATIENT), (3, reconcile.ED), (5, reconcile.INPATIENT)]


def test_source_class(frame):
    df = frame("a int, b int, c int, d int", (1, 0, 0, 0), (0, 1, 1, 1), (0, 0, 1, 0), (0, 1, 1, 0), (1, 1, 1, 1))
    cls = reconcile.source_class(*[F.col(c) for c in "abcd"])
    assert sorted(str(r[0]) for r in df.select(cls).collect()) == ["1", "2", "3", "4", "None"]


def test_unmatched_is_null_safe(frame):
    claims = frame("id int, k int, code string", (1, 10, "x"), (2, 10, None), (3, 20, "x"), (4, 30, None))
    mapped = frame("id int", (3,))
    reported = frame("k int, code string", (10, None), (30, "x"))
    assert rows(reconcile.unmatched(claims, mapped, ["id"], reported, ["k", "code"]), "id") == [(1,), (4,)]


def test_lowest_source_number_wins(frame):
    a = frame("k int, source double, skey string", (1, 2.1, "c.1"), (2, 3.0, "X.9"))
    b = frame("k int, source double, skey string", (1, 2.0, "X.1"), (2, 4.0, "X.8"))
    assert rows(reconcile.merge_priority([a, b], ["k"], "source", [F.col("skey")]), "skey") == [("X.1",), ("X.9",)]


def test_network_recount_differs_from_site_sums(frame):
    pop = frame("month date, site string, m int", *[("2024-01-01", s, m) for s, m in (("a", 1), ("a", 2), ("b", 2), ("c", 3))])
    ev = frame("month date, site string, e int", ("2024-01-01", "a", 7), ("2024-01-01", "b", 7))
    args = (pop, ev, "m", "e", ["a", "b"], "net")
    cols = ("site", "numerator", "denominator", "aggregation")
    assert rows(measures.site_and_network_rates(*args), *cols) == [
        ("a", 1.0, 2.0, "Practice"), ("b", 1.0, 1.0, "Practice"), ("c", 0.0, 1.0, "Practice"), ("net", 1.0, 2.0, "Network"),
    ]
    assert rows(measures.site_and_network_rates(*args, recount=False), *cols)[-1] == ("net", 2.0, 3.0, "Network")
    assert len(rows(measures.site_and_network_rates(*args, zero_fill=False))) == 3


def test_events_strictly_after_the_first_score(frame):
    ev = frame("k int, f int, d date", (1, None, "2024-01-05"), (1, None, "2024-01-06"), (1, 1, "2024-02-01"))
    sc = frame("k int, f int, sd date", (1, None, "2024-01-05"), (1, None, "2024-01-09"))
    assert rows(measures.events_after_first(ev, sc, ["k"], ["k", "f"], "d", "sd"), "d") == [("2024-01-06",)]


def test_only_the_first_score_s_flag_can_match(frame):
    ev = frame("k int, f string, d date", (1, "B", "2024-01-20"), (1, "A", "2024-01-20"))
    sc = frame("k int, f string, sd date", (1, "A", "2024-01-05"), (1, "B", "2024-01-10"))
    assert rows(measures.events_after_first(ev, sc, ["k"], ["k", "f"], "d", "sd"), "f") == [("A",)]


def test_valid_members_need_every_start_and_some_length(frame):
    df = frame("m int, s date, e date, t date", (1, None, None, "2024-01-01"), (2, "2024-01-01", "2024-01-01", "2024-01-01"),
               (3, "2024-01-01", "2024-02-01", "2024-01-01"))
    got = population.valid_members(df, ["s", "t"], ["e"], *bounds(), some_length=[("s", "e")])
    assert {m for m, in rows(got, "m")} == {3}


def test_active_members_carry_the_latest_event(frame):
    df = frame("m int, d date, site string", (1, "2024-01-10", "a"), (1, "2024-01-20", "b"), (1, "2024-01-20", "c"))
    got = population.active_members(df, ["m"], "d", *bounds(), carry=["site"])
    assert {s for s, in rows(got.filter("month = '2024-01-01'"), "site")} == {"b", "c"}


def test_code_classes_of_unmapped_claims(frame):
    lines = frame("claim int, c string", *enumerate(["0451", "045", "04512", "0456", "01", "012", "018", None]))
    got = reconcile.line_flags(lines, "c", reconcile.UNMAPPED_REVENUE_CLASS)
    assert [r.claim for r in got.filter("emergency = 1").collect()] == [0]
    assert [r.claim for r in got.filter("inpatient = 1").collect()] == [5]
