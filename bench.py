"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver_queries import families, operators  # noqa: E402,F401
from driver_queries.registry import QUERIES  # noqa: E402
from tallyloom.session import local_session  # noqa: E402

HEADLINE = [
    # the published steps: five families, the mixed table, the evaluation
    "bureau_family",
    "previous_family",
    "pos_family",
    "installment_family",
    "card_family",
    "assembled_features",
    "gbt_kfold",
    # further families and representative operators
    "application_family",
    "ten_features",
    "missed_payment",
    "previous_history_family",
    "agg_multi",
    "agg_median",
    "merge_back",
    "gap_desc",
    "score_sum",
    "auc_rank",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("tallyloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # start-up cost of the session is not a query's
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
