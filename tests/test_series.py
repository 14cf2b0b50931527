import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.functions import dates
from tallyloom.plans import report, series
from tallyloom.schema import MEASURE_ROW

RULES = series.ChartRules()


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


@pytest.fixture()
def make(spark):
    def build(values, site="s", measure="Initial Intake", skip=(), network="n"):
        """One point per month; ``values`` are (numerator, denominator)."""
        out = [
            (site, measure, month(i), float(n), float(d), network, "Practice")
            for i, (n, d) in enumerate(values) if i not in skip
        ]
        return spark.createDataFrame(out, MEASURE_ROW)

    return build


def chart(df):
    return series.chart(df, RULES.scaled, RULES)


def test_limits_use_the_first_points_only(make):
    got = chart(make([(5, 10)] * 24 + [(9, 10)] * 3)).filter("rn = 27").collect()[0]
    assert got.centerline == 0.5 and got.rate == 0.9
    assert got.ucl == pytest.approx(0.5 + 3 * (0.5 / 10) ** 0.5)
    assert got.lcl == 0.0  # floored


def test_scaled_and_capped_measures(make):
    ed = chart(make([(5, 1000)] * 3, measure="ED Visits (Discharged)")).collect()
    assert {r.season for r in ed} == {"Break", "School"} and ed[0].rate == 50.0
    assert ed[0].ucl == pytest.approx(50 + 3 * (10000 * 50 / 1000) ** 0.5)
    assert chart(make([(9, 10)] * 3, measure="PRO BOS")).collect()[0].ucl == 1.0
    assert chart(make([(9, 10)] * 3)).collect()[0].ucl > 1.0


def test_a_season_without_baseline_points_has_no_limits(make):
    rules = series.ChartRules(baseline=1)
    got = series.control_limits(series.with_season(make([(5, 10)] * 3, measure="ED Visits (Discharged)"), rules.scaled, rules), rules)
    assert rows(got, "rn", "centerline") == [(1, 5000.0), (2, None), (3, None)]


@pytest.mark.parametrize("run, found", [(8, True), (7, False)])
def test_shift_needs_eight_points(make, run, found):
    values = [(5, 10)] * 24 + [(6, 10)] * run + [(4, 10), (6, 10)] * 5
    got = chart(make(values)).collect()
    assert {r.shift_start for r in got} == ({month(24)} if found else {None})


def test_shift_needs_a_long_series(make):
    assert chart(make([(5, 10)] * 23 + [(6, 10)] * 8)).filter("shift_start is not null").isEmpty()


def test_a_rate_on_the_centre_counts_as_not_above(make):
    values = [(5, 10)] * 24 + [(6, 10)] * 4 + [(5, 10)] * 8
    assert {r.shift_start for r in chart(make(values)).collect()} == {month(28)}


def test_rebaseline_overlays_the_shifted_part(make):
    values = [(5, 10)] * 24 + [(6, 10)] * 30
    got = {r.rn: r for r in chart(make(values)).collect()}
    assert got[24].centerline == 0.5 and got[24].shift_period is None
    assert got[25].centerline == pytest.approx(0.6) and got[32].shift_period == 0.6
    assert got[33].shift_period is None
    assert got[48].centerline == pytest.approx(0.6) and got[49].centerline == 0.5  # 24 points after the shift
    assert all(r.lcl <= r.centerline <= r.ucl for r in got.values())


def test_series_do_not_merge_runs(make):
    a = make([(5, 10)] * 24 + [(6, 10)] * 4 + [(4, 10), (6, 10)] * 3, site="a")
    b = make([(5, 10)] * 24 + [(6, 10)] * 4 + [(4, 10), (6, 10)] * 3, site="ab")
    assert chart(a.unionByName(b)).filter("shift_start is not null").isEmpty()


def test_gap_fill_uses_one_pair_of_neighbours(make):
    df = make([(1, d) for d in (10, 20, 30, 40, 50, 60, 70)], skip=(2, 4))
    got = rows(series.gap_fill(df, ["Initial Intake"]), "month", "numerator", "denominator", "network")
    assert got == [("2020-03-01", 0.0, 40.0, "n"), ("2020-05-01", 0.0, 40.0, "n")]


def test_gap_fill_other_measures_and_no_gaps(make):
    assert series.gap_fill(make([(1, 1)] * 4, measure="x", skip=(1,)), ["Initial Intake"]).isEmpty()
    assert series.gap_fill(make([(1, 1)] * 4), ["Initial Intake"]).isEmpty()


def test_gap_fill_needs_its_neighbours(make):
    df = make([(1, 10)] * 6, skip=(1, 2, 3))
    cut = series.gap_fill(df, ["Initial Intake"], first=dates.day("2020-03-01"))
    assert cut.isEmpty()  # the month before the first missing one is missing too
    assert series.gap_fill(df, ["Initial Intake"]).count() == 3


def test_label(frame):
    df = frame("m date, d double", ("2024-03-01", 1234.5), ("2024-03-01", None))
    assert rows(df.select(series.label(F.col("m"), F.col("d")))) == [("24-March (n = 1,234)",), (None,)]


def test_partition_count_does_not_matter(make, spark):
    df = make([(i % 7, 10) for i in range(50)]).unionByName(make([(i % 5, 10) for i in range(40)], site="t"))
    want = rows(chart(df.coalesce(1)), "site", "month", "centerline", "ucl", "lcl", "shift_period")
    assert rows(chart(df.repartition(7)), "site", "month", "centerline", "ucl", "lcl", "shift_period") == want


def test_report_end_to_end(make, tmp_path):
    hist = make([(1, 10)] * 30, site="a", skip=(20,)).unionByName(make([(2, 10)] * 30, site="b")).unionByName(make([(5, 0)] * 3, site="zero"))
    new = make([(9, 10)] * 30, site="b", skip=tuple(range(28)))
    rules = report.ReportRules(as_of="2022-06-20", network="n", network_site="net", first_month="2020-01-01")
    got = report.build_report(hist, [(new, True)], rules)
    assert got.columns == list(report.OUTPUT)
    by_site = {r.site: r.n for r in got.groupBy("site").agg(F.count("*").alias("n")).collect()}
    assert by_site == {"a": 29, "b": 29, "net": 29}  # June is open, the gap of a is filled
    net = {r.month: r for r in got.filter("site = 'net'").collect()}
    assert net[month(0)].numerator == 3.0 and net[month(28)].numerator == 10.0
    assert net[month(20)].denominator == 10.0  # rolled up before the gap fill
    filled = got.filter((F.col("site") == "a") & (F.col("month") == F.lit(month(20)))).collect()[0]
    assert filled.numerator == 0.0 and filled.denominator == 10.0 and filled.aggregation == "Practice"
