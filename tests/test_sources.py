import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tallyloom.schema import MEASURE_ROW, measure_rows
from tallyloom.sources import folders, forms, publish, tables


def test_sheet_types_are_forced(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("a,b,c\nx,1.5,2024-01-31\ny,bad,2024-02-29\n")
    schema = T.StructType(
        [T.StructField("site", T.StringType()), T.StructField("n", T.DoubleType()), T.StructField("d", T.DateType())]
    )
    df = tables.read_sheet(spark, str(tmp_path / "sheet.csv"), schema, ["site", "n"])
    assert rows(df) == [("x", 1.5), ("y", None)]


def test_folder_and_file_names(spark, frame, tmp_path):
    for name in ("North Clinic 202511", "North Clinic 202512", "Southside 202512"):
        frame("v int", (len(name),)).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = tables.with_file_meta(tables.read_folder(spark, f"{tmp_path}/*.parquet").withColumn(
        "file", F.regexp_replace("file", "%20", " ")))
    assert rows(df, "site", "month", "v") == [
        ("North Clinic", "2025-11-01", 19), ("North Clinic", "2025-12-01", 19), ("Southside", "2025-12-01", 16),
    ]
    assert rows(tables.files_from(df, ["North"], "2025-12-01"), "site", "month") == [("North Clinic", "2025-12-01")]


def test_file_without_month(frame):
    df = tables.with_file_meta(frame("file string", ("readme.txt",)))
    assert rows(df, "month") == [(None,)]


CELLS = "file string, kind string, sheet string, row int, col int, value string"
LAYOUT = "kind string, sheet string, row int, col int, name string"


def test_cells_follow_the_layout_of_their_kind(spark, frame):
    cells = frame(
        CELLS,
        ("a", "wide", "pt", 8, 2, "3"), ("a", "wide", "pt", 8, 3, "10"), ("a", "wide", "pt", 5, 3, "99"),
        ("b", "tall", "pt", 3, 3, "n/a"), ("b", "tall", "pt", 5, 3, "7"),
    )
    layout = tables.params(
        spark,
        [("wide", "pt", 8, 2, "leavers"), ("wide", "pt", 8, 3, "open"), ("tall", "pt", 3, 3, "leavers"), ("tall", "pt", 5, 3, "open")],
        LAYOUT,
    )
    assert rows(forms.extract_cells(cells, layout, names=["leavers", "open"])) == [("a", 3.0, 10.0), ("b", None, 7.0)]


def test_block_drops_outside_and_empty_rows(frame):
    cells = frame(
        "file string, row int, col int, value string",
        ("a", 4, 1, "pat_id"), ("a", 5, 1, "p1"), ("a", 5, 2, "9"), ("a", 6, 1, None), ("a", 7, 2, "x"), ("a", 1001, 1, "late"),
    )
    block = forms.extract_block(cells, 5, 1000, {1: ("pat_id", "string"), 2: ("score", "double")})
    assert rows(block) == [("a", 5, "p1", 9.0), ("a", 7, None, None)]


def test_placeholder_for_an_empty_file(frame):
    files = frame("site string", ("a",), ("b",), ("b",))
    got = forms.or_placeholder(files, frame("site string, numerator double", ("a", 2.0)), ["site"])
    assert rows(got) == [("a", 2.0), ("b", None)]


def test_params_broadcast_only_small_lists(spark):
    few = tables.params(spark, [(1,)], "x int")
    many = tables.params(spark, [(i,) for i in range(20)], "x int", broadcast_rows=10)
    assert "hint" in few._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in many._jdf.queryExecution().logical().toString().lower()


def test_csv_round_trip(spark, frame, tmp_path):
    df = measure_rows(
        frame(
            "measure string, site string, month date, numerator double, denominator double, network string, aggregation string",
            ("m", "s", "2024-02-01", None, 4.0, "n", "Practice"), ("m", "t", "2024-03-01", 2.0, 4.0, None, "Practice"),
        )
    )
    path = str(tmp_path / "out")
    tables.write_csv(df.coalesce(1), path)
    lines = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert lines[0] == "site,measure,month,numerator,denominator,network,aggregation"
    assert "s,m,2024-02-01,NA,4.0,n,Practice" in lines
    assert rows(tables.read_csv(spark, path, MEASURE_ROW)) == rows(df)


def test_measure_rows_needs_every_column(frame):
    with pytest.raises(ValueError, match="numerator"):
        measure_rows(frame("site string, measure string, month date", ("a", "b", "2024-01-01")))


def test_empty_like_keeps_the_schema(frame):
    df = frame("a int, b date", (1, "2024-01-01"))
    none = tables.empty_like(df)
    assert none.schema == df.schema and none.isEmpty()


def test_shared_frames_are_stored_in_the_shared_folder(spark, frame):
    from tallyloom.session import materialise, scratch_dir

    df = frame("a int, b date", (1, "2024-01-01"), (2, None))
    stored = materialise(df)
    assert rows(stored) == rows(df) and stored.schema == df.schema
    assert stored.inputFiles()[0].removeprefix("file://").startswith(scratch_dir(spark).removeprefix("file:"))


def test_published_file_is_replaced_whole(spark, frame, tmp_path):
    path = tmp_path / "report.csv"
    df = frame("k int, t string, d date", (2, "b", None), (3, None, "2024-01-01"), (1, "a,x", "2024-02-01"))
    publish.publish_csv(df.repartition(3), str(path), ["k"])
    assert path.read_text().splitlines() == ["k,t,d", '1,"a,x",2024-02-01', "2,b,NA", "3,NA,2024-01-01"]
    broken = df.withColumn("k", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        publish.publish_csv(broken, str(path), ["t"])
    assert path.read_text().count("\n") == 4  # the old file stays
    publish.publish_csv(df.filter("k = 2"), str(path), ["k"])
    assert path.read_text().splitlines() == ["k,t,d", "2,b,NA"]
    publish.publish_csv(df.filter("k = 9"), str(path), ["k"])
    assert path.read_text().splitlines() in (["k,t,d"], [])
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["report.csv"]


def test_months_are_replaced_alone(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    df = frame("site string, month date, n int", ("a", "2024-01-01", 1), ("a", "2024-02-01", 2), ("b", "2024-02-01", 3), ("a", "2024-03-01", 4))
    publish.write_months(df, path)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").glob("month=*/*.parquet")}
    new = frame("site string, month date, n int", ("a", "2024-02-01", 20), ("c", "2024-04-01", 5))
    for _ in range(2):  # a repeated delivery changes nothing
        publish.redeliver(path, new, ["site", "month"])
        got = rows(publish.read_months(spark, path, df))
        assert got == [("a", "2024-01-01", 1), ("a", "2024-02-01", 20), ("a", "2024-03-01", 4), ("b", "2024-02-01", 3), ("c", "2024-04-01", 5)]
    kept = {p for p, t in files.items() if p.exists() and p.stat().st_mtime_ns == t}
    assert {p.parent.name for p in kept} == {"month=2024-01-01", "month=2024-03-01"}
    publish.redeliver(path, new.limit(0), ["site", "month"])
    for wrong, keys in ((new, ["site"]), (new.withColumn("month", F.lit(None).cast("date")), ["site", "month"])):
        with pytest.raises(ValueError):
            publish.redeliver(path, wrong, keys)


def test_files_of_a_folder(spark, tmp_path):
    (tmp_path / "Hill Top 202512.csv").write_text("k,t,d\n1,a,2020-01-01\n2,NA,2020-13-01\n")
    (tmp_path / "Hill Side 202601.csv").write_text("d,k\n2020-02-02,3\n")
    (tmp_path / "Mill 202601.csv").write_text("k,d,k,new\nx,2020-01-01,7,1\n6,2020-03-01\n7,2020-03-02,9,9,9\n8,,9,9\n")
    (tmp_path / "Mill 202613.csv").write_text("")
    (tmp_path / "_note.csv").write_text("k\n1\n")
    (tmp_path / "other.txt").write_text("k\n1\n")
    files = folders.list_files(spark, str(tmp_path))
    assert [(f.name, f.site, str(f.month)) for f in files] == [
        ("Hill Side 202601.csv", "Hill Side", "2026-01-01"), ("Hill Top 202512.csv", "Hill Top", "2025-12-01"),
        ("Mill 202601.csv", "Mill", "2026-01-01"), ("Mill 202613.csv", "Mill", "None"),
    ]
    assert [f.name for f in folders.choose(files, ["Hill"])] == ["Hill Side 202601.csv", "Hill Top 202512.csv"]
    assert [f.name for f in folders.choose(files, first_month=dt.date(2026, 1, 1))] == ["Hill Side 202601.csv", "Mill 202601.csv"]
    schema = T._parse_datatype_string("k int, t string, d date")
    got = folders.read_files(spark, files, schema)
    assert rows(got, "file", "site", "month", "k", "t", "d", "bad") == [
        ("Hill Side 202601.csv", "Hill Side", "2026-01-01", 3, None, "2020-02-02", None),
        ("Hill Top 202512.csv", "Hill Top", "2025-12-01", 1, "a", "2020-01-01", None),
        ("Hill Top 202512.csv", "Hill Top", "2025-12-01", 2, None, None, "d"),
        ("Mill 202601.csv", "Mill", "2026-01-01", 6, None, "2020-03-01", "number of fields"),
        ("Mill 202601.csv", "Mill", "2026-01-01", 7, None, "2020-03-02", "number of fields"),
        ("Mill 202601.csv", "Mill", "2026-01-01", 8, None, None, None),
        ("Mill 202601.csv", "Mill", "2026-01-01", None, None, "2020-01-01", "k"),
    ]
    assert sorted(r.line for r in got.filter("bad IS NOT NULL").collect()) == ["2,,2020-13-01", "6,2020-03-01", "7,2020-03-02,9,9,9", "x,2020-01-01,7,1"]
    none = folders.read_files(spark, [], schema)
    assert none.count() == 0 and none.columns == got.columns


def test_own_disk_is_no_shared_folder():
    from tallyloom.session import check_shared

    for master, scheme in (("local", "file"), ("local[8]", "file"), ("yarn", "hdfs"), ("spark://x:7077", "s3a")):
        check_shared(master, scheme)
    for master in ("yarn", "spark://x:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            check_shared(master, "file")
