"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from larkspan.registry import load_all
from larkspan.session import local_session

HEADLINE = [
    "sem_query", "join_inner_using", "join_left_chain", "join_star_relationships", "agg_group_basic", "agg_count_distinct", "agg_percentiles",
    "win_topn_per_group", "win_cumulative", "win_last_k_messages", "win_rank", "topk_global", "rpt_weekly_kpis", "rpt_customer_360", "rpt_product_insights",
    "src_html_pages", "token_count", "ai_classify_single", "ai_sentiment_overall", "ai_redact_mask", "ai_agg_instruction", "ai_summarize_row",
    "near_duplicate_text", "chunk_fixed_overlap", "chunk_recursive", "embed_hashing", "search_vector_topk", "search_lexical_bm25", "search_hybrid_rrf",
    "search_lexical_filtered", "search_hybrid_filtered", "claim_check", "ent_relations", "kg_merge_edges", "graph_khop", "graph_components", "community_detect", "drift_hybrid", "job_graph_rag", "st_windowed_counts", "job_customer_intelligence",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.time()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench")
    registry = load_all()
    run(registry["audit_row_counts"], spark, sf_dir)  # start-up is not measured
    times = {}
    for name in names:
        times[name] = round(run(registry[name], spark, sf_dir), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
