"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
Results are computed in full and discarded by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import time

from quern.plans.queries import all_queries
from quern.plans.session import local_session

HEADLINES = (
    "shipdate_count",
    "orders_by_shipdate",
    "part_supplier_by_shipdate",
    "nation_shipments",
    "nation_monthly_shipments",
    "pricing_summary",
    "unshipped_revenue_topk",
    "word_count",
    "bigram_count",
    "bigram_relfreq_pairs",
    "bigram_relfreq_stripes",
    "cooccurrence_window",
    "pmi_pairs",
    "pmi_stripes",
    "inverted_index",
    "boolean_retrieval",
    "fetch_snippets",
    "personalized_pagerank",
    "ppr_topk",
    "train_sgd",
    "train_batch",
    "score_documents",
    "ensemble_average",
    "one_minus_roca",
    "event_count_tumbling",
    "region_event_count",
    "window_state_history",
    "trending_alerts",
    "event_count_tumbling_stream",
    "trending_alerts_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="quern-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["line_count"](spark, folder).collect()  # start the workers and read the footers
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
