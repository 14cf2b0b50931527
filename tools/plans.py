"""Shape of the physical plan of each query: plans.py [folder] [query ...]."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tallyloom.catalog  # noqa: E402,F401
from tallyloom.catalog.registry import QUERIES  # noqa: E402
from tallyloom.session import local_session  # noqa: E402

NODES = (
    "Scan parquet", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
    "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin",
    "BroadcastNestedLoopJoin", "CartesianProduct", "Window ", "WindowGroupLimit", "Generate", "Expand",
    "PythonUDF", "EvalPython",
)


def shape(df) -> dict[str, int]:
    text = df._jdf.queryExecution().executedPlan().toString()
    counts = {n: len(re.findall(re.escape(n), text)) for n in NODES}
    return {n: c for n, c in counts.items() if c}


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in sys.argv[2:] or list(QUERIES):
        print(name, shape(QUERIES[name](spark, folder)), flush=True)


if __name__ == "__main__":
    main()
