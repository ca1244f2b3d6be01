"""Benchmark: run the headline queries once each and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from trajtable.plans import catalog
from trajtable.session import local_session

HEADLINE = (
    "adv_grpo", "adv_grpo_passk", "adv_gdpo", "adv_rloo", "adv_gae", "adv_otb", "adv_multi_output",
    "corr_is_token", "corr_reject_mask", "corr_rs_metrics", "corr_offpolicy_metrics", "audit_ppo", "audit_kl_cov",
    "data_metrics", "bench_summary", "val_majority", "val_metrics", "metric_window", "async_batch_stats",
    "distill_fkl_topk", "relay_objective", "handoff_triggers", "handoff_budget", "trace_rows",
    "sft_truncate_pad", "multiturn_loss_mask", "split_placeholders", "filter_offline",
    "grade_answer_line", "grade_boxed", "grade_phrase", "answer_votes", "tool_call_table",
    "dedup_first_by_key", "pf_resample", "pack_balanced", "pack_by_group", "batch_repeat", "union_cols",
    "st_metric_window",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    queries = catalog.queries()
    chosen = list(queries) if names == "all" else names.split(",") if names else HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times = {}
    for name in chosen:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
