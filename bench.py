"""Times the headline queries over $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deskflow.plans import QUERIES  # noqa: E402
from deskflow.session import build_session  # noqa: E402

HEADLINE = [
    "client_risk_features", "hash_sort_join_count", "enrich_trades", "enrich_positions", "join_lateral_latest_price",
    "kpi_cards", "kpi_cards_filtered", "daily_flow", "cumulative_flow", "client_asset_heatmap", "sector_treemap",
    "notional_by_asset_class", "top_traders", "trades_by_hour", "trade_scatter", "top_clients", "notional_by_rating",
    "exposure_sunburst", "hero_exposure", "long_short", "pnl_by_desk", "sector_concentration", "gross_by_client",
    "limit_breaches", "limit_utilisation", "daily_returns", "returns_histogram", "largest_movers", "latest_mark",
    "feature_lookup", "entity_resolve", "risk_lookup_json", "append_surrogate_key", "gen_positions", "gen_trades",
    "gen_trades_profile", "gen_price_walk", "change_capture", "reconcile", "scd1_batch", "scd2_batch", "book_as_of",
    "scd1_stream", "scd1_out_of_order", "scd2_stream", "stream_resume", "sync_triggered", "publish_online",
    "online_lookup", "check_pk_composite", "check_fk", "chunk_documents", "embed_documents", "semantic_search",
    "vector_search_batch", "vector_search_approx", "page_text_extract", "word_wrap", "thread_state", "thread_pages",
    "features_as_of", "trade_marks_as_of", "names_in_text", "memory_phrase_search", "document_files", "distinct_clients_by_range",
    "append_in_batches", "version_lookup",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = {name: QUERIES[name] for name in sys.argv[1:] or HEADLINE}
    spark = build_session(
        "deskflow-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # small jobs first, so that starting the engine and its Python workers is not charged to a name
    QUERIES["table_counts"](spark, base).write.format("noop").mode("overwrite").save()
    spark.range(0, 1000, 1, int(cpus)).mapInPandas(lambda frames: frames, "id long").write.format("noop").mode(
        "overwrite"
    ).save()
    first, seconds = {}, {}
    for name, run in runs.items():
        for times in (first, seconds):
            start = time.perf_counter()
            run(spark, base).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(first.values()), 3),
                "unit": "sec",
                "queries": first,
                "note": "first of two runs per query; second_run holds the second",
                "second_run": seconds,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
