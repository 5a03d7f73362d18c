"""Binary classification metrics over a long score table (model, label, p).

Everything that needs an order (PR and ROC areas, threshold tables, top-k) works on
distinct scores: rows are counted per score with map-side combine and the counts are
accumulated slot by slot, so no step sorts all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine import schema as S
from riskengine.functions.columns import count_if, decision, ratio
from riskengine.operators.quantiles import quantiles
from riskengine.operators.ranking import rows_at_ranks, running_totals
from riskengine.session import scratch_path

RATES = ["precision", "recall", "f1_score", "specificity", "false_positive_rate", "false_negative_rate"]


def confusion(flagged: Column, label: Column) -> dict[str, Column]:
    return {
        "tn": count_if(~flagged & (label == 0)),
        "fp": count_if(flagged & (label == 0)),
        "fn": count_if(~flagged & (label == 1)),
        "tp": count_if(flagged & (label == 1)),
    }


def confusion_matrix(
    scored: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model_name",), label="label", score="p"
) -> DataFrame:
    cells = confusion(decision(score, threshold), F.col(label))
    return scored.groupBy(*by).agg(*[c.alias(k) for k, c in cells.items()])


def rates(counts: DataFrame, digits: int | None = 4) -> DataFrame:
    """Rates from tn, fp, fn, tp; an empty denominator gives 0. Rounded half-even."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    made = {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        # from the counts: the quotient of the rounded rates would miss exact halves
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": ratio(tn, tn + fp),
        "false_positive_rate": ratio(fp, fp + tn),
        "false_negative_rate": ratio(fn, fn + tp),
    }
    return counts.withColumns({k: F.bround(c, digits) if digits is not None else c for k, c in made.items()})


def score_curve(
    scored: DataFrame, by: Sequence[str] = ("model_name",), label="label", score="p", one_task_rows=1_000_000
) -> DataFrame:
    """One row per distinct score, best first: n, pos at the score and before_n,
    before_pos at better scores."""
    table = scored.groupBy(*by, score).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )
    return running_totals(table, score, ["n", "pos"], by=by, descending=True, one_task_rows=one_task_rows)


def ranking_metrics(
    scored: DataFrame,
    by: Sequence[str] = ("model_name",),
    label="label",
    score="p",
    digits: int | None = 4,
    one_task_rows: int = 1_000_000,
) -> DataFrame:
    """Trapezoid PR area (starting at recall 0, precision 1), average precision (step
    sum) and ROC area. With one class only, all are 0."""
    return curve_areas(score_curve(scored, by, label, score, one_task_rows), by, digits)


def curve_areas(curve: DataFrame, by: Sequence[str], digits: int | None = 4, **more: Column) -> DataFrame:
    """Areas of the curves that ``score_curve`` gives; ``more``: further aggregates of a curve's rows by name."""
    n, pos, bn, bp = (F.col(x) for x in ("n", "pos", "before_n", "before_pos"))
    precision = (bp + pos) / (bn + n)
    before = F.when(bn > 0, bp / bn).otherwise(1.0)
    neg = n - pos
    totals = curve.groupBy(*by).agg(
        *[c.alias(name) for name, c in more.items()],
        F.sum(n).alias("samples"),
        F.sum(pos).alias("positives"),
        F.sum(pos * (precision + before) / 2).alias("_trapezoid"),
        F.sum(pos * precision).alias("_step"),
        # negatives at this score are beaten by every better positive, half by equal ones
        F.sum(neg.cast("double") * (bp + pos / F.lit(2))).alias("_pairs"),
    )
    both = (F.col("positives") > 0) & (F.col("positives") < F.col("samples"))
    p, q = F.col("positives"), (F.col("samples") - F.col("positives"))

    def done(x):
        value = F.when(both, x).otherwise(0.0)
        return F.bround(value, digits) if digits is not None else value

    return totals.select(
        *by,
        "samples",
        "positives",
        done(F.col("_trapezoid") / p).alias("pr_auc"),
        done(F.col("_step") / p).alias("average_precision"),
        done(F.col("_pairs") / (p.cast("double") * q)).alias("roc_auc"),
        *more,
    )


def evaluate(
    scored: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model_name",), digits: int | None = 4
) -> DataFrame:
    """The full metric document, one row per model."""
    cells = rates(confusion_matrix(scored, threshold, by), digits)
    areas = ranking_metrics(scored, by, digits=digits)
    return areas.join(cells, list(by)).select(
        *by,
        "pr_auc",
        "roc_auc",
        "average_precision",
        *RATES,
        F.struct(
            F.col("tn").alias("true_negatives"),
            F.col("fp").alias("false_positives"),
            F.col("fn").alias("false_negatives"),
            F.col("tp").alias("true_positives"),
        ).alias("confusion_matrix"),
        F.col("samples").alias("test_samples"),
        F.col("tp").alias("fraud_caught"),
        F.col("fn").alias("fraud_missed"),
        F.col("fp").alias("legitimate_declined"),
    )


def business_cost(fn: Column, fp: Column) -> Column:
    return fn * F.lit(S.MISSED_FRAUD_LOSS) + fp * F.lit(S.FALSE_DECLINE_LOSS)


def threshold_sweep(
    scored: DataFrame,
    thresholds: Sequence[float] = tuple(S.THRESHOLDS),
    by: Sequence[str] = ("model_name",),
    label="label",
    score="p",
) -> DataFrame:
    """Metrics and cost at every threshold from one pass: each row adds to a few
    conditional counts per model, nothing is multiplied by the number of thresholds."""
    y = F.col(label)
    per = [
        F.struct(F.lit(float(t)).alias("threshold"), *[c.alias(k) for k, c in confusion(decision(score, t), y).items()])
        for t in thresholds
    ]
    grid = scored.groupBy(*by).agg(F.array(*per).alias("r")).select(*by, F.inline("r"))
    return rates(grid).select(
        *by,
        "threshold",
        "recall",
        "precision",
        F.col("false_positive_rate").alias("fpr"),
        "f1_score",
        F.col("tp").alias("fraud_caught"),
        F.col("fn").alias("fraud_missed"),
        F.col("fp").alias("false_alarms"),
        F.col("tn").alias("true_negatives"),
        F.round(business_cost(F.col("fn"), F.col("fp")), 2).alias("business_cost"),
    )


def best_points(sweep: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Threshold of the best F1 and of the lowest cost; the lower threshold wins a tie."""
    return sweep.groupBy(*by).agg(
        F.min_by("threshold", F.struct(F.negative("f1_score"), "threshold")).alias("best_f1_threshold"),
        F.min_by("threshold", F.struct("business_cost", "threshold")).alias("best_cost_threshold"),
    )


def key_threshold_table(sweep: DataFrame, key_thresholds: Sequence[float] = tuple(S.KEY_THRESHOLDS)) -> DataFrame:
    near = reduce(Column.__or__, [F.abs(F.col("threshold") - t) < 0.01 for t in key_thresholds])
    return sweep.where(near)


def outcome_profile(
    scored: DataFrame,
    features: DataFrame,
    cols: Sequence[str],
    key: str = "txn_id",
    threshold: float = 0.5,
) -> DataFrame:
    """Missed against caught positives, feature by feature: mean, median, deviation, and
    the same for the probability. Scores meet features by key."""
    fraud = scored.where(F.col("label") == 1).select(
        key, F.col("p").alias("probability"), F.when(decision("p", threshold), "caught").otherwise("missed").alias("outcome")
    )
    # joined once, read for the row count, the medians and the figures
    joined = fraud.join(features.select(key, *cols), key)
    path = scratch_path(scored.sparkSession, "outcomes")
    joined.write.parquet(path)
    rows = scored.sparkSession.read.schema(joined.schema).parquet(path)
    names = ["probability", *cols]
    med = quantiles(rows, names, [0.5], by="outcome")
    entries = []
    for c in names:
        measures = []
        for side in ("missed", "caught"):
            v = F.when(F.col("outcome") == side, F.col(c).cast("double"))
            middle = med.get((side, c), [None])[0]
            measures += [
                F.avg(v).alias(f"{side}_mean"),
                F.lit(middle).cast("double").alias(f"{side}_median"),
                F.stddev_samp(v).alias(f"{side}_std"),
                F.min(v).alias(f"{side}_min"),
                F.max(v).alias(f"{side}_max"),
            ]
        entries.append(F.struct(F.lit(c).alias("feature"), *measures))
    table = rows.agg(F.array(*entries).alias("r")).select(F.inline("r"))
    return table.select(
        "feature",
        *[F.bround(c, 4).alias(c) for c in table.columns if c != "feature"],
        (F.col("missed_mean") < F.col("caught_mean")).alias("missed_is_lower"),
    )


def compare_models(documents: DataFrame) -> DataFrame:
    """Models by PR area, with marks for the best area, precision and recall."""
    best = documents.agg(
        *[F.max_by("model_name", F.struct(m, "model_name")).alias(f"_b_{m}") for m in ("pr_auc", "precision", "recall")]
    )
    return (
        documents.crossJoin(F.broadcast(best))  # one row
        .select(
            "model_name",
            "pr_auc",
            "precision",
            "recall",
            "false_positive_rate",
            *[(F.col("model_name") == F.col(f"_b_{m}")).alias(f"best_{m}") for m in ("pr_auc", "precision", "recall")],
        )
        .orderBy(F.col("pr_auc").desc(), "model_name")
    )


def business_table(documents: DataFrame) -> DataFrame:
    return documents.select(
        "model_name",
        "pr_auc",
        "precision",
        "recall",
        "fraud_caught",
        (F.col("fraud_caught") + F.col("fraud_missed")).alias("total_fraud"),
        F.col("legitimate_declined").alias("false_alarms"),
        "false_positive_rate",
        business_cost(F.col("fraud_missed"), F.col("legitimate_declined")).alias("business_cost"),
    )


def top_k_hits(scored: DataFrame, key: str = "txn_id", label="label", score="p") -> tuple[int, int]:
    """(k, positives among the k best scores) with k = number of positives. Equal scores
    at the cut are taken by descending key; only the cut itself is looked up."""
    k = scored.agg(F.sum(F.col(label).cast("long"))).first()[0] or 0
    if not k:
        return 0, 0
    ranked = scored.select((-F.col(score)).alias("_s"), (-F.col(key)).alias("_k"), F.col(label).alias("_y"))
    cut = rows_at_ranks(ranked, ["_s", "_k"], [k])[0]
    # rows at or before the cut; a one-part cut already stands for the last row of its score
    inside = F.col("_s") < F.lit(cut[0])
    at = F.col("_s") == F.lit(cut[0])
    inside = inside | (at & (F.col("_k") <= F.lit(cut[1])) if len(cut) == 2 else at)
    return int(k), int(ranked.where(inside).agg(F.coalesce(F.sum("_y"), F.lit(0))).first()[0])


def anomaly_evaluation(scored: DataFrame, key: str = "txn_id", label="label", score="p") -> DataFrame:
    k, hits = top_k_hits(scored, key, label, score)
    areas = ranking_metrics(scored.withColumn("_one", F.lit(1)), ["_one"], label, score)
    means = scored.agg(
        F.avg(F.when(F.col(label) == 0, F.col(score))).alias("m0"),
        F.avg(F.when(F.col(label) == 1, F.col(score))).alias("m1"),
    )
    return areas.crossJoin(F.broadcast(means)).select(
        "roc_auc",
        "pr_auc",
        "average_precision",
        F.round("m0", 6).alias("normal_mean_error"),
        F.round("m1", 6).alias("fraud_mean_error"),
        F.round(F.col("m1") / F.col("m0"), 2).alias("error_ratio"),
        F.lit(round(hits / k * 100, 1) if k else 0.0).alias("fraud_in_top_k_pct"),
    )


def drift(
    baseline: DataFrame,
    current: DataFrame,
    fpr_limit: float = S.FPR_DRIFT_LIMIT,
    pr_auc_limit: float = S.PR_AUC_DRIFT_LIMIT,
) -> DataFrame:
    """Relative change of FPR and PR area against the baseline, joined on model name.
    Both frames carry model_name, pr_auc, false_positive_rate; like is compared with like."""
    base = baseline.select(
        "model_name", F.col("pr_auc").alias("baseline_pr_auc"), F.col("false_positive_rate").alias("baseline_fpr")
    )
    cur = current.select(
        "model_name", F.col("pr_auc").alias("current_pr_auc"), F.col("false_positive_rate").alias("current_fpr")
    )
    bf, cf, bp, cp = (F.col(c) for c in ("baseline_fpr", "current_fpr", "baseline_pr_auc", "current_pr_auc"))
    fpr_change = F.when(bf > 0, cf / bf - 1.0).otherwise(F.when(cf > 0, 1.0).otherwise(0.0))
    pr_change = F.when((bp > 0) & (cp > 0), 1.0 - cp / bp).otherwise(0.0)
    return (
        base.join(cur, "model_name")
        .withColumns({"_f": fpr_change, "_p": pr_change})
        .select(
            "model_name",
            "baseline_pr_auc",
            "current_pr_auc",
            "baseline_fpr",
            "current_fpr",
            F.round("_f", 6).alias("fpr_relative_change"),
            F.round("_p", 6).alias("pr_auc_relative_change"),
            (F.col("_f") > fpr_limit).alias("fpr_warning"),
            (F.col("_p") > pr_auc_limit).alias("pr_auc_warning"),
            ((F.col("_f") > fpr_limit) | (F.col("_p") > pr_auc_limit)).alias("any_warning"),
            F.lit(fpr_limit).alias("fpr_limit"),
            F.lit(pr_auc_limit).alias("pr_auc_limit"),
        )
    )


def fold_summary(folds: DataFrame, digits: int = 4) -> DataFrame:
    """Mean, population deviation and ordered list of the fold scores (one row per
    model, metric and fold; the list has as many entries as folds)."""
    return folds.groupBy("model_name", "metric").agg(
        F.bround(F.avg("value"), digits).alias("mean"),
        F.bround(F.stddev_pop("value"), digits).alias("std"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("fold", "value"))), lambda x: F.bround(x["value"], digits)
        ).alias("folds"),
    )


# --- fixed values: name parts that mark an engineered feature ---
ENGINEERED_MARKS = [
    "fraud_direction", "fraud_feature", "hour_sin", "time_since", "txn_count", "amount_",
    "V17_V", "V14_V", "V12_V", "V16_V", "V3_V", "std_amount", "velocity_spike",
]


def normalised_importance(importance: DataFrame, top: int = 10) -> DataFrame:
    """The ten most important features relative to the first, marked engineered or not."""
    best = importance.orderBy(F.col("importance").desc(), "feature").limit(top)
    peak = best.agg(F.max("importance").alias("_max"))
    engineered = reduce(Column.__or__, [F.contains(F.col("feature"), F.lit(m)) for m in ENGINEERED_MARKS])
    return best.crossJoin(F.broadcast(peak)).select(
        "feature",
        "importance",
        F.when(F.col("_max") > 0, F.col("importance") / F.col("_max")).otherwise(0.0).alias("relative"),
        engineered.alias("is_engineered"),
    )


def class_weights(df: DataFrame, label: str = "Class") -> DataFrame:
    """Balanced weights n / (2 n_class) and the negative to positive ratio."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(
        F.sum("n").alias("_all"),
        F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("_neg"),
        F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("_pos"),
    )
    return counts.crossJoin(F.broadcast(total)).select(
        label,
        "n",
        (F.col("_all") / (2 * F.col("n"))).alias("balanced_weight"),
        (F.col("_neg") / F.col("_pos")).alias("neg_pos_ratio"),
    )


def operating_points(scored: DataFrame, by: Sequence[str] = ("model_name",), recall=0.80, fpr=0.01) -> DataFrame:
    """Highest threshold that reaches the wanted recall; lowest that keeps the FPR."""
    c = score_curve(scored, by)
    totals = c.groupBy(*by).agg(F.sum("n").alias("_n"), F.sum("pos").alias("_p"))
    tp = F.col("before_pos") + F.col("pos")
    fp = F.col("before_n") + F.col("n") - tp
    # one row per model
    return (
        c.join(F.broadcast(totals), list(by))
        .groupBy(*by)
        .agg(
            F.max(F.when(tp >= recall * F.col("_p"), F.col("p"))).alias("threshold_at_recall"),
            F.min(F.when(fp <= fpr * (F.col("_n") - F.col("_p")), F.col("p"))).alias("threshold_at_fpr"),
        )
    )
