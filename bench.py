"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``build_*`` is the ingest work from the test tables: joining them into raw records, cleaning
into the curated layer, packing messages. The queries after it read those stored layers, as
they do in production. Every query runs in full: its result is written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.queries import build_queries  # noqa: E402
from mercato.session import local_session  # noqa: E402
from mercato.workspace import Workspace  # noqa: E402

HEADLINE = [
    "parse_orders", "parse_payments", "parse_events", "reject_summary_orders",
    "daily_sales", "customer_metrics", "rfm_scores", "churn_candidates", "payment_analysis",
    "nightly_manifest",
    "revenue_by_region", "sales_trend", "peak_hours", "peak_hours_heatmap", "value_segments",
    "payment_methods", "rfm_distribution", "device_breakdown", "top_cities",
    "sheet_orders_sample", "sheet_event_funnel", "sheet_customer_rfm", "sheet_payments_sample",
    "warehouse_region_revenue", "warehouse_device_share", "warehouse_event_funnel",
    "warehouse_weekend_split", "warehouse_rfm_segments",
    "quality_line_totals", "quality_payment_reconciliation_counts", "quality_catalogue",
    "quality_deduplicated", "export_orders", "report_manifest",
    "stream_compacted_events", "stream_topic_counts",
    "revenue_by_region_range", "catalog_event_funnel", "quality_item_lines",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="bench-")  # one machine: its own folder is shared
    spark = local_session(cpus, "12g", spark__checkpoint__dir=shared)
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executor threads
    workspace = Workspace(spark, sf_dir)
    timings: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)

    for table in ("orders", "payments", "user_events"):
        timed(f"build_raw_{table}", lambda: workspace.raw(table))
        timed(f"build_curated_{table}", lambda: workspace.tables[table])
        timed(f"build_messages_{table}", lambda: workspace.envelope_folder(table))
    timed("build_order_lines", workspace.order_lines)
    timed("build_streamed_layers", workspace.ingested)
    timed("build_compacted_layers", workspace.compacted)
    timed("build_warehouse", workspace.warehouse)
    queries = build_queries()
    for name in HEADLINE:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    workspace.release()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "commerce_headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
