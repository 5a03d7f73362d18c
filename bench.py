"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2:
one warm-up, one measured; the best run counts), BENCH_ONLY (comma list of name prefixes).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskengine.catalog import load_all  # noqa: E402
from riskengine.session import build_session  # noqa: E402

HEADLINE = [
    "a9_daily_performance",
    "j1_transaction_results",
    "q1_feedback_upsert",
    "v4_constraint_violations",
    "v6_duplicates",
    "v11_outliers",
    "v13_constant_features",
    "a13_descriptive_statistics",
    "a14_label_correlation",
    "a18_amount_histogram",
    "p2_standard_scaling",
    "p18_chronological_split",
    "w1_trailing_window",
    "w1_trailing_window_ties",
    "w2_global_velocity",
    "w4_decile_bucket",
    "w5_segment_velocity",
    "w6_recency",
    "w7_percentile_rank",
    "x6_card_windows",
    "x6_point_in_time_join",
    "x2_slice_evaluation",
    "x3_feature_stability",
    "p14_baseline_feature_set",
    "a3_pr_auc_trapezoid",
    "a6_threshold_sweep",
    "a20_missed_vs_caught",
    "m11_isolation_forest",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def batch_scoring(spark, sf_dir) -> dict[str, float]:
    """Scoring rate of a stored model over the whole log: the figure the baseline gives."""
    from riskengine.catalog.models import INPUTS, training_rows
    from riskengine.operators import models as L
    from riskengine.plans.runs import materialise

    train, test = training_rows(spark, sf_dir)
    rows = materialise(train.unionByName(test), "bench")
    # the sample files hold one partition each; a real table has many
    cached = rows.repartition(spark.sparkContext.defaultParallelism).persist()
    n = cached.count()
    out = {"rows": n}
    for name in ("logistic_regression", "decision_tree", "naive_bayes", "random_forest"):
        model = L.fit(name, cached, INPUTS, effort=0.05)
        L.timed_scoring(model, cached, name)
        out[name] = round(min(L.timed_scoring(model, cached, name)[0] for _ in range(2)), 4)
    cached.unpersist()
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _sql = load_all()
    took = {}
    for name in HEADLINE:
        if only and not any(name.startswith(o) for o in only):
            continue
        best = None
        for _ in range(runs):
            began = time.perf_counter()
            consume(queries[name](spark, sf_dir))
            seconds = time.perf_counter() - began
            best = seconds if best is None else min(best, seconds)
        took[name] = round(best, 3)
        print(f"{name} {best:.3f}", file=sys.stderr, flush=True)
    scoring = batch_scoring(spark, sf_dir) if not only else {}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "batch_scoring_seconds": scoring,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
