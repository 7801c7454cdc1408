"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to a ``noop`` sink, so all of its columns and rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sparkdraft import build_session  # noqa: E402
from sparkdraft.queries import all_queries  # noqa: E402

HEADLINE = (
    "row_counts", "det_keys", "arena_map", "clean_numbers", "id_list_explode", "cell_multiset",
    "three_kind_counts", "first_wins", "draft_index",
    "draft_pick_cards", "game_card_stats", "deck_build_cards", "turns", "events",
    "turn_zone_cards", "candidate_hands",
    "null_fill_merge", "insert_or_validate", "metadata_conflicts", "group_schema_drift",
    "coverage_metrics", "manifest", "assoc_pmi", "assoc_pmi_by_customer", "svd_sigma",
    "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
