"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the test folder, BENCH_CPUS the local cores.
Warehouse tables are written once before the clock starts, as a warehouse would hold them; every query
then computes all of its own intermediates and its whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES, project  # noqa: E402
from checks.roles import WAREHOUSE, TestTables, forget  # noqa: E402
from hammerline.session import session  # noqa: E402

HEADLINE = (
    "zip_sell_through", "seller_portfolio_quality", "high_bid_history", "bidder_budget", "registrant_score",
    "price_tercile_by_state", "feature_row", "feature_row_scoring", "feature_row_trustee", "hierarchical_fill",
    "bpo_blend", "predictions_nontrustee", "predictions_trustee", "centred_faults", "valuation_fit",
    "ridge_logistic_per_state", "elastic_net_price",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = session(f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                    spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    start = time.time()
    wh = TestTables(spark, sf_dir)
    for name in WAREHOUSE:
        wh[name]
    load = time.time() - start
    took = {}
    for name in names:
        forget(sf_dir, keep=WAREHOUSE)
        query = QUERIES[name]
        start = time.time()
        project(query.build(TestTables(spark, sf_dir)), query.spec).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "warehouse_load_sec": round(load, 3),
    }))


if __name__ == "__main__":
    main()
