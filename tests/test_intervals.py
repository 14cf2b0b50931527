"""Interval operators against plain loops, on random small frames with odd rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.operators import groups, intervals
from tallyloom.plans import episodes, measures, population

ZERO = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else ZERO + dt.timedelta(days=n)


def some_spans(rng, n):
    out = []
    for i in range(n):
        lo = rng.choice([None, *[rng.randint(-400, 400)] * 9])
        length = rng.choice([0, 1, 3, 30, 800, -5, None])
        hi = None if length is None or lo is None else lo + length
        out.append((i, rng.choice([0, 0, 0, 1, 2, None]), day(lo), day(hi)))
    return out


def holds(d, lo, hi):
    return d is not None and lo is not None and lo <= d and (hi is None or d <= hi)


@pytest.mark.parametrize("seed, widths", [(1, None), (2, [1]), (3, [5, 90]), (4, [100_000])])
def test_point_in_interval(spark, seed, widths):
    rng = random.Random(seed)
    spans = some_spans(rng, 60)
    points = [(i, rng.choice([0, 0, 1, 2, 3, None]), day(rng.choice([None, *[rng.randint(-500, 700)] * 9]))) for i in range(150)]
    left = spark.createDataFrame(points, "p int, k int, d date")
    right = spark.createDataFrame(spans, "s int, k int, lo date, hi date")
    got = intervals.join_in_interval(left, right, ["k"], "d", "lo", "hi", widths)
    assert got.columns == ["p", "k", "d", "s", "lo", "hi"]
    want = [(p, s) for p, k, d in points for s, j, lo, hi in spans if k is not None and k == j and holds(d, lo, hi)]
    assert sorted((r.p, r.s) for r in got.collect()) == sorted(want) and want


@pytest.mark.parametrize("seed, width", [(5, None), (6, 1), (7, 40)])
def test_overlaps(spark, seed, width):
    rng = random.Random(seed)
    a, b = some_spans(rng, 50), some_spans(rng, 50)
    left, right = spark.createDataFrame(a, "a int, k int, lo date, hi date"), spark.createDataFrame(b, "b int, k int, lo2 date, hi2 date")
    got = intervals.join_overlapping(left, right, ["k"], ("lo", "hi"), ("lo2", "hi2"), width)
    far = dt.date(9999, 12, 31)
    real = lambda x: x[2] is not None and x[2] <= (x[3] or far)
    want = [
        (x[0], y[0]) for x in filter(real, a) for y in filter(real, b)
        if x[1] is not None and x[1] == y[1] and x[2] <= (y[3] or far) and y[2] <= (x[3] or far)
    ]
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(want) and want


def test_no_rows_no_pairs(spark):
    none = spark.createDataFrame([], "k int, d date")
    spans = spark.createDataFrame([(1, day(0), None)], "k int, lo date, hi date")
    assert intervals.join_in_interval(none, spans, ["k"], "d", "lo", "hi").count() == 0
    points = spark.createDataFrame([(1, day(0))], "k int, d date")
    assert intervals.join_in_interval(points, spans.limit(0), ["k"], "d", "lo", "hi").count() == 0
    assert intervals.join_overlapping(spans.limit(0), spans.toDF("k", "a", "b"), ["k"], ("lo", "hi"), ("a", "b")).count() == 0


def test_long_intervals_take_few_bins(spark):
    spans = spark.createDataFrame([(i, 1, day(0), day(0 if i < 500 else 3000)) for i in range(1000)], "s int, k int, lo date, hi date")
    widths = intervals.bin_widths(spans, "lo", "hi")
    assert widths[0] == 1 and widths[-1] == 3001
    assert intervals._binned(spans, "lo", "hi", widths).count() <= 2 * 1000


def test_merged_spans(spark):
    rng = random.Random(8)
    spans = [(k if k is not None else 9, lo, hi) for _, k, lo, hi in some_spans(rng, 80)]
    got = intervals.merge_spans(spark.createDataFrame(spans, "k int, lo date, hi date"), ["k"], "lo", "hi").collect()
    for k in {s[0] for s in spans}:
        mine = sorted((r.lo, r.hi or dt.date.max) for r in got if r.k == k)
        assert all(a[1] < dt.date.max and b[0] > a[1] + dt.timedelta(days=1) for a, b in zip(mine, mine[1:]))
        for n in range(-450, 1400):
            assert any(lo <= day(n) <= hi for lo, hi in mine) == any(holds(day(n), lo, hi) for j, lo, hi in spans if j == k)


def test_counts_by_month(frame):
    spans = frame(
        "site string, a date, b date",
        ("x", "2020-01-01", "2020-03-01"), ("x", "2020-03-01", None), ("x", "2019-01-01", "2019-12-01"), ("x", "2020-02-01", "2020-01-01"),
        ("x", "2019-06-01", "2020-01-01"), ("y", "2020-04-01", "2021-01-01"), ("z", None, None), ("w", "2020-01-01", "2020-01-01"), ("w", "2020-03-01", "2020-03-01"),
    )
    first, last = F.lit("2020-01-01").cast("date"), F.lit("2020-04-15").cast("date")
    got = rows(intervals.count_by_month(spans.dropna(subset=["a"]), ["site"], "a", "b", first, last), "site", "month", "n")
    assert got == [
        ("w", "2020-01-01", 1), ("w", "2020-03-01", 1), ("x", "2020-01-01", 2), ("x", "2020-02-01", 1), ("x", "2020-03-01", 2), ("x", "2020-04-01", 1),
        ("y", "2020-04-01", 1),
    ]


def test_covered_points(spark):
    rng = random.Random(9)
    spans = some_spans(rng, 40)
    points = [(i, rng.choice([0, 1, 2, 5]), day(rng.choice([None, rng.randint(-500, 900)]))) for i in range(120)]
    points += points[:4]
    got = intervals.covered(
        spark.createDataFrame(points, "p int, k int, d date"), spark.createDataFrame(spans, "s int, k int, lo date, hi date"),
        ["k"], "d", "lo", "hi",
    )
    want = [(p, any(j == k and holds(d, lo, hi) for _, j, lo, hi in spans)) for p, k, d in points]
    assert got.columns == ["p", "k", "d", "covered"] and sorted((r.p, r.covered) for r in got.collect()) == sorted(want)


def test_union_of_populations(frame):
    spans = frame(
        "m int, s date, e date, t date, u date",
        (1, "2020-01-15", "2020-03-01", "2020-02-10", "2020-06-30"), (2, None, "2020-05-01", "2020-01-01", "2020-01-01"), (3, "2020-01-01", None, "2020-01-01", None),
    )
    frames = [population.valid_spans(spans, ["m"], ["s"], ["e"]), population.valid_spans(spans, ["m"], ["t"], ["u"], some_length=[("t", "u")])]
    got = rows(population.any_population_spans(frames, ["m"]), "m", "from_month", "until_month")
    assert got == [(1, "2020-02-01", "2020-06-01"), (3, "2020-01-01", None)]


def test_sets_merge(spark):
    rng = random.Random(10)
    data = [(rng.choice("abc"), rng.choice("xy"), rng.choice([0, 1, 32767, 32768, 32769, 10**9, rng.randint(0, 70_000), None, -4])) for _ in range(800)]
    df = spark.createDataFrame(data, "site string, month string, member long")
    sets = groups.distinct_sets(df, ["site", "month"], "member")
    fine = {(r.site, r.month): r.n for r in groups.merged_count(sets, ["site", "month"]).collect()}
    coarse = {r.month: r.n for r in groups.merged_count(sets, ["month"]).collect()}
    known = [(s, m, v) for s, m, v in data if v is not None and v >= 0]
    assert fine == {k: len({v for s, m, v in known if (s, m) == k}) for k in {(s, m) for s, m, _ in known}}
    assert coarse == {k: len({v for _, m, v in known if m == k}) for k in {m for _, m, _ in known}}


def test_network_counts_members_once(spark):
    pop = spark.createDataFrame([("m", "A", 1), ("m", "B", 1), ("m", "B", 2), ("m", "C", 3), ("m", "A", 1)], "month string, site string, member long")
    ev = spark.createDataFrame([("m", "A", 7), ("m", "B", 7)], "month string, site string, event long")
    outs = [
        sorted(tuple(r) for r in measures.site_and_network_rates(pop, ev, "member", "event", ["A", "B"], "N", dense_members=dense)
               .select("site", "denominator", "numerator").collect())
        for dense in (True, False)
    ]
    assert outs[0] == outs[1] == [("A", 1.0, 1.0), ("B", 2.0, 1.0), ("C", 1.0, 0.0), ("N", 2.0, 1.0)]


def test_episode_stats_against_a_plain_loop(spark):
    """Overlapping, equal, open and empty episodes over days with and without visits and scores."""
    rng = random.Random(11)
    days = [
        (s, day(n), rng.choice([None, "", "V", "V"]), rng.choice([None, float(rng.randint(0, 9))]))
        for s in (1, 2, 3, None) for n in rng.sample(range(60), 25)
    ]
    eps = []
    for i in range(60):
        lo = rng.randint(-5, 60)
        hi = rng.choice([None, lo + rng.randint(-3, 40), lo])
        eps.append((rng.choice([1, 2, 3, 4]), day(lo), day(hi), f"o{i}", None, 1.0, None if hi is None else 1.0))
    eps += eps[:3]
    schema = "s int, start_date date, end_date date, start_owner string, end_owner string, start_flag double, end_flag double"
    got = episodes.episode_stats(
        spark.createDataFrame(eps, schema), spark.createDataFrame(days, "s int, day date, code string, score double"), ["s"]
    )
    want = []
    for e in {tuple(x) for x in eps}:
        s, lo, hi = e[:3]
        inside = sorted(((d, c, sc) for j, d, c, sc in days if j == s and holds(d, lo, hi)), key=lambda x: x[0])
        visits = [x for x in inside if x[1]]
        if visits:
            scored = [x for x in inside if x[2] is not None]
            want.append((
                s, lo, hi, e[3], len(visits), visits[-1][0], visits[-1][2], next((x[2] for x in inside if x[0] == hi), None),
                scored[0][0] if scored else None, scored[0][2] if scored else None,
            ))
    cols = ["s", "start_date", "end_date", "start_owner", "visits", "last_seen", "seen_score", "end_score", "first_score_day", "first_score"]
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in got.select(cols).collect()), key=key) == sorted(want, key=key) and len(want) > 20
