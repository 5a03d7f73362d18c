"""Whole runs: profiling, evaluation, monitoring, anomaly model and end to end."""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine import schema as S
from riskengine.operators import anomaly
from riskengine.operators import metrics as M
from riskengine.operators import models as L
from riskengine.operators import prep
from riskengine.operators import profiling as D
from riskengine.operators import quality as V
from riskengine.operators import views as W
from riskengine.operators.ranking import decile_bounds
from riskengine.plans import features as P
from riskengine.session import scratch_path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: later passes do not repeat
    the work, and a lost executor costs no lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def profile(df: DataFrame, numeric: Sequence[str], label: str = "Class") -> dict[str, DataFrame]:
    """All validation and descriptive tables by name."""
    everything = [*numeric, label]
    return {
        "missing": V.null_counts(df, everything),
        "duplicates": V.duplicates(df.select(*everything)),
        "types": V.type_profile(df.select(*everything)),
        "outliers": V.outliers(df, numeric),
        "cardinality": V.cardinality(df, everything),
        "constant": V.constant_features(df, everything),
        "correlated": D.correlation_pairs(df, numeric).where(F.abs("correlation") > S.HIGH_CORRELATION),
        "classes": V.class_distribution(df, label),
        "moments": V.moments(df, numeric),
        "statistics": D.descriptive(df, numeric),
        "label_correlation": D.ranked_correlation(df, numeric, label),
        "variance_share": D.variance_share(df, numeric),
        "amount_by_class": D.amount_by_class(df, label=label),
        "amount_histogram": D.histogram(df, F.col("Amount"), {0: 100, 1: 50}, label),
        "box_plot": D.box_plot(df, label=label),
        "issues": V.issues(df, numeric, label),
    }


def evaluation(
    scored: DataFrame,
    features: DataFrame | None = None,
    profile_cols: Sequence[str] = (),
    threshold: float = 0.5,
    profile_model: str | None = None,
) -> dict[str, DataFrame]:
    """Metric documents, monitoring rows, comparison, sweep and missed-case profile of a
    long score table with any number of models."""
    docs = M.evaluate(scored, threshold)
    sweep = M.threshold_sweep(scored)
    out = {
        "documents": docs,
        "monitoring_rows": W.evaluation_rows(docs),
        "comparison": M.compare_models(docs),
        "business": M.business_table(docs),
        "sweep": sweep,
        "best_points": M.best_points(sweep),
        "key_thresholds": M.key_threshold_table(sweep),
    }
    if features is not None and profile_cols:
        chosen = scored if profile_model is None else scored.where(F.col("model_name") == profile_model)
        out["missed_profile"] = M.outcome_profile(chosen, features, profile_cols, threshold=threshold)
    return out


def monitoring(
    labelled: DataFrame,
    baseline: DataFrame,
    threshold: float | None = None,
    fpr_limit: float = S.FPR_DRIFT_LIMIT,
    pr_auc_limit: float = S.PR_AUC_DRIFT_LIMIT,
) -> DataFrame:
    """Drift verdict per model on recent labelled scores (model_name, txn_id, label, p).

    ``baseline`` is parsed metric documents; their area is an average precision in one
    of the two forms, so the current one is measured as average precision too. The
    decision threshold is the given one or the baseline's own, model by model."""
    V.check_limits(threshold or 0.0, fpr_limit, pr_auc_limit, 1.0)
    # one row per model: a join on the model name
    limits = baseline.select("model_name", (F.lit(threshold) if threshold else F.col("threshold")).alias("_t"))
    judged = labelled.join(F.broadcast(limits), "model_name")
    cells = M.confusion(F.col("p") >= F.col("_t"), F.col("label"))
    counts = M.rates(judged.groupBy("model_name").agg(*[c.alias(k) for k, c in cells.items()]), None)
    areas = M.ranking_metrics(labelled, digits=None)
    current = areas.join(counts, "model_name").select(
        "model_name", F.col("average_precision").alias("pr_auc"), "false_positive_rate"
    )
    return M.drift(baseline, current, fpr_limit, pr_auc_limit)


def anomaly_run(df: DataFrame, ratio: float = 0.80, k: int = 16, label: str = "Class") -> dict[str, DataFrame]:
    """Fit the reconstruction on the training period, score both periods, evaluate."""
    train, test, _at = prep.chronological_split(df, ratio)
    model = anomaly.fit_reconstruction(train, k=k)
    out = {}
    for name, side in (("train", train), ("test", test)):
        scored = materialise(
            anomaly.reconstruction_error(side, model, "p", keep_embedding=True).select(
                "txn_id", F.col(label).alias("label"), "p", "embedding"
            ),
            f"reconstruction-{name}",
        )
        out[f"{name}_scores"] = scored
        out[f"{name}_metrics"] = M.anomaly_evaluation(scored.drop("embedding"))
    return out


def prepare(
    df: DataFrame,
    tier: str = "baseline",
    ratio: float = 0.80,
    fit_scope: str = "train",
    features: str = "independent",
    dry_run: bool = False,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Clean, split by time, scale and build features; both sides stored.

    ``fit_scope``: "train" fits the scaler on the training side only, "all" on
    everything. ``features``: "independent" lets each side find its own deciles and
    anomaly model, "train" applies those of the training side to the test side."""
    if fit_scope not in ("train", "all") or features not in ("independent", "train") or tier not in L.TIERS:
        raise ValueError(f"bad setting: {fit_scope}, {features}, {tier}")
    if dry_run:
        df = prep.hash_sample(df, 5000)
    V.require_no_nulls(df.select("Amount", "time_s", "Class", *[c for c in S.V_COLS if c in df.columns]))
    # keys are unique here, so a duplicate is a row equal in everything but its key
    clean = V.repair_negative_amounts(
        prep.first_per_key(df, [c for c in df.columns if c != "txn_id"], ["txn_id"])
        if set(df.columns) <= {"txn_id", "time_s", "Amount", "Class", *S.V_COLS}
        else prep.drop_duplicate_rows(df)
    )
    base = materialise(clean.withColumn("Time", F.col("time_s").cast("double")), "clean")
    train, test, _at = prep.chronological_split(base, ratio)
    scaler = prep.fit_scaler(train if fit_scope == "train" else base, ["Amount", "Time"])
    train, test = (prep.log_amount(prep.apply_scaler(side, scaler)) for side in (train, test))
    build = P.baseline if tier == "baseline" else P.advanced
    shared = {}
    if features == "train":
        shared["bounds"] = decile_bounds(P.whole_seconds(train), ["Amount_raw", "time_s", "txn_id"])
        if tier == "advanced":
            shared["forest"] = anomaly.fit_isolation_forest(train)
    # models need a number where the scaled amount has no logarithm
    train, test = (side.fillna(0.0, ["amount_log_scaled"]) for side in (train, test))
    stored = [materialise(build(side, **shared), f"features-{n}") for n, side in (("train", train), ("test", test))]
    V.same_features(*stored)
    return stored[0], stored[1], P.feature_names(stored[0])


def end_to_end(
    df: DataFrame,
    mode: str = "baseline",
    effort: float = 1.0,
    model_folder: str | None = None,
    dry_run: bool = False,
    models: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Validated table to evaluated models; ``mode`` is baseline, advanced or full."""
    tiers = ["baseline", "advanced"] if mode == "full" else [mode]
    spark = df.sparkSession

    def one(name: str, tier: str, train: DataFrame, test: DataFrame, cols: list[str]):
        def work():
            began = time.perf_counter()
            model = L.fit(name, train, cols, effort=effort, rows_per_task=L.ROWS_PER_TASK_TOGETHER)
            if model_folder:
                L.save_model(model, model_folder, name, tier)
            full_name = f"{name}_{tier}"
            return L.score(model, test, full_name), (full_name, time.perf_counter() - began)

        return work

    work = []
    for tier in tiers:
        prepared = prepare(df, tier, dry_run=dry_run)
        work += [one(name, tier, *prepared) for name in L.TIERS[tier] if models is None or name in models]
    done = L.side_by_side(work, spark)
    timing = [t for _scored, t in done]
    scores = reduce(DataFrame.unionByName, [scored for scored, _t in done])
    stored = materialise(scores, "scores")
    out = evaluation(stored)
    out["scores"] = stored
    out["timing"] = spark.createDataFrame(timing, "model_name string, fit_seconds double")
    return out
