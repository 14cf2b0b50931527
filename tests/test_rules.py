"""Codes by rules, and which parts of a copy may be missing."""

import os
import shutil
import subprocess
import sys

import pytest

from tallyloom.operators import rules

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLE = [(5, "a", False, "A"), (2, "ab", False, "AB"), (3, "ab", True, "=AB"), (1, "b", True, "=B"), (4, "ab", False, "late"), (9, "", False, "any")]


@pytest.mark.parametrize("longest", [True, False])
def test_rules_against_a_loop(spark, longest):
    codes = [None, "", "a", "ab", "abc", "b", "bc", "xyz", "aab", "ab", "ABC"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")
    got = {r.i: r.name for r in rules.by_prefix(df, "code", spark.createDataFrame(TABLE, f"{rules.RULE}, name string"), ["name"], longest).collect()}
    for i, c in enumerate(codes):
        met = [r for r in TABLE if c is not None and (c == r[1] if r[2] else c.startswith(r[1]))]
        order = (lambda r: (-len(r[1]), not r[2], r[0])) if longest else (lambda r: r[0])
        assert got[i] == (min(met, key=order)[3] if met else None), c


def test_no_rules(spark):
    df = spark.createDataFrame([("a",), (None,)], "code string")
    out = rules.by_prefix(df, "code", spark.createDataFrame([], f"{rules.RULE}, name string"), ["name"])
    assert sorted(map(str, (r.name for r in out.collect()))) == ["None", "None"] and out.columns == ["code", "name"]


def copy_of(folder, *without):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "tallyloom"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, folder / name, ignore=shutil.ignore_patterns("__pycache__", *without))
        elif os.path.exists(source) and name not in without:
            shutil.copy(source, folder / name)
    return folder


def names(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), sum(k.startswith('op') and k[2].isdigit() for k in e.queries()), 'pipeline' in e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)})
    return run.stdout.split() if run.returncode == 0 else run.stderr


def test_entry_without_the_optional_parts(tmp_path):
    whole = len(__import__("tallyloom.catalog.registry", fromlist=["x"]).QUERIES)
    assert names(copy_of(tmp_path, "llm", "corpus_pipeline.py")) == [str(whole), "0", "False"]


@pytest.mark.skipif(not os.path.exists(os.path.join(ROOT, "tallyloom", "llm")), reason="left out of this copy")
def test_entry_with_a_package_missing(tmp_path):
    folder = copy_of(tmp_path)
    (folder / "xxhash.py").write_text("raise ModuleNotFoundError('no', name='xxhash')\n")
    assert "xxhash" in "".join(names(folder))
