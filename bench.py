"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads, ``BENCH_QUERIES`` a comma
separated selection (default: the headline queries; ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfsight.registry.queries import all_queries  # noqa: E402
from shelfsight.session import build_session  # noqa: E402

HEADLINE = (
    "enrich_products", "product_kpis", "price_tier_counts", "top_n_products", "discover_by_keyword",
    "reviews_for_top_products", "cap_per_group", "sentiment_distribution", "review_kpis", "top_issues",
    "top_themes", "first_issues", "review_recency", "negative_rate_7d", "summaries_by_sentiment",
    "describe_products", "describe_reviews", "gate_analysed_reviews", "assemble_batches", "match_responses",
    "upsert_reviews", "price_latest", "price_weekly", "snapshot_json", "negative_rate_stream", "daily_run",
    "row_numbers", "enrich_batches", "scan_table",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compiler, code generation and the Parquet reader outside the measurement.
    queries["enrich_products"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    queries["review_kpis"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
