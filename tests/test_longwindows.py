"""Windows by ranges and joins with missing keys against Spark's own, on keys of very different sizes."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import joins, longwindows


def some(spark, seed, n=400):
    rng = random.Random(seed)
    rows = [
        (rng.choice([0, 0, 0, 0, 1, 2, None]), rng.choice([None, *range(30)]), i, rng.choice([None, None, *range(5)]), rng.choice("xxy") if i % 7 else None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "k int, day int, id int, v long, flag string").repartition(5)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_equal_to_the_window(spark, ranges):
    df = some(spark, ranges)
    got = longwindows.over(df, ["k"], ["day", "id"], ranges).add("rn", {"before": "v", "f": "flag"}, {"after": "v"}, {"so_far": "v"}).result()
    w = Window.partitionBy("k").orderBy("day", "id")
    want = df.select(
        "*", F.row_number().over(w).cast("long").alias("rn"), F.lag("v").over(w).alias("before"), F.lag("flag").over(w).alias("f"),
        F.lead("v").over(w).alias("after"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
    )
    assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_ties_are_broken_once(spark):
    df = spark.createDataFrame([(1, 5, i) for i in range(200)], "k int, day int, id int").repartition(4)
    rows = longwindows.over(df, ["k"], ["day"], 7).add("rn", {"before": "id"}, {"after": "id"}).result().collect()
    by = {r.rn: r for r in rows}
    assert sorted(by) == list(range(1, 201)) and by[1].before is None and by[200].after is None
    assert all(by[i].before == by[i - 1].id and by[i - 1].after == by[i].id for i in range(2, 201))


def test_runs(spark):
    df = some(spark, 9)
    got = {r.id: (r.row_no, r.run_no) for r in longwindows.runs(df, ["k"], ["day", "id"], "flag", 13).collect()}
    rows = sorted(df.collect(), key=lambda r: (str(r.k), -1 if r.day is None else r.day, r.id))
    want, last = {}, None
    for r in rows:
        if last is None or last.k != r.k:
            no, run = 1, 1
        else:
            no, run = no + 1, run + (last.flag != r.flag)
        want[r.id], last = (no, run), r
    assert got == want


def test_no_rows_and_one(spark):
    df = some(spark, 1)
    assert longwindows.over(df.limit(0), ["k"], ["id"]).add("rn", {"b": "v"}, {"a": "v"}, {"s": "v"}).result().count() == 0
    one = longwindows.over(df.filter("id = 3"), ["k"], ["id"], 4).add("rn", {"b": "v"}).result().first()
    assert (one.rn, one.b) == (1, None)


def test_large_key_is_dealt_out(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    made = longwindows.over(df, ["k"], ["id"], 12).add("rn")
    sizes = [r["count"] for r in made.rows.groupBy("__range").count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 2 * sorted(sizes)[6]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("with_none", [True, False])
def test_missing_keys_join_as_before(spark, how, with_none):
    rng = random.Random(3)
    left = spark.createDataFrame([(rng.choice([None, None, 1, 2]), rng.choice([None, 7]), i) for i in range(80)], "a int, b int, i int").repartition(4)
    right = [(1, 7, "x"), (1, None, "y"), (None, 7, "z"), (3, 7, "w"), (1, 7, "again")] + [(None, None, "none"), (None, None, "more")] * with_none
    right = spark.createDataFrame(right, "a int, b int, name string")
    got, want = (f(left, right, ["a", "b"], how) for f in (joins.null_split_join, joins.null_safe_join))
    assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    with pytest.raises(ValueError):
        joins.null_split_join(left, right, ["a"], "right")


def test_missing_keys_of_odd_frames(spark):
    left = spark.createDataFrame([(None, {"x": 1}), (1, None), (None, None)], "a int, m map<string,int>")
    right = spark.createDataFrame([(None,), (2,)], "a int")
    assert joins.null_split_join(left, right, ["a"], "left_semi").count() == 2
    assert joins.null_split_join(left.select("a"), right, ["a"], "left_anti").collect() == [(1,)]
    plan = joins.anti(left.select("a", F.lit("v").alias("b")), right, ["a"]).filter("a > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically" not in plan
