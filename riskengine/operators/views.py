"""Audit tables: joined views, daily performance, leaderboard, alerts, feedback."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.functions.columns import count_if, outcome, ratio
from riskengine.operators.prep import latest_per_key

# --- fixed values: outcome vocabularies ---
CATEGORY = ("true_positive", "false_positive", "false_negative", "true_negative", "unlabeled")
STATUS = ("✅ Caught", "❌ False Alarm", "⚠️ Missed Fraud", "✅ OK", "⏳ Pending")


HOT_KEY_ROWS = 1_000_000


def transaction_results(
    transactions: DataFrame,
    predictions: DataFrame,
    ground_truth: DataFrame,
    split_hot: str | bool = "auto",
) -> DataFrame:
    """Transactions with their predictions and label, if any. Both joins use the same
    key, so the rows are partitioned once.

    The optional side of an outer join cannot be split, so one transaction with a huge
    number of predictions would end up in one task. "auto" measures the fullest key; past
    the limit the matches come from an inner join (which adaptive execution does split)
    and the transactions without prediction are added."""
    label = ground_truth.select(
        "transaction_id",
        F.col("true_label").alias("actual_fraud"),
        "feedback_source",
        F.col("reported_at").alias("feedback_reported_at"),
    )
    guess = predictions.select(
        "transaction_id",
        "fraud_probability",
        F.col("is_fraud").alias("predicted_fraud"),
        "model_name",
        "model_version",
        "inference_time_ms",
    )
    if split_hot == "auto":
        fullest = predictions.groupBy("transaction_id").count().agg(F.max("count")).first()[0] or 0
        split_hot = fullest > HOT_KEY_ROWS
    if split_hot:
        labelled = transactions.join(label, "transaction_id", "left")
        rest = labelled.join(guess.select("transaction_id"), "transaction_id", "left_anti")
        joined = guess.join(labelled, "transaction_id").unionByName(rest, allowMissingColumns=True)
    else:
        joined = transactions.join(guess, "transaction_id", "left").join(label, "transaction_id", "left")
    flag, actual = F.col("predicted_fraud"), F.col("actual_fraud")
    return joined.select(
        "transaction_id",
        "timestamp_received",
        "time_seconds",
        "amount",
        "card_id",
        "merchant_id",
        "fraud_probability",
        "predicted_fraud",
        "model_name",
        "model_version",
        "inference_time_ms",
        "actual_fraud",
        "feedback_source",
        "feedback_reported_at",
        outcome(flag, actual, CATEGORY).alias("result_category"),
        outcome(flag, actual, STATUS).alias("result_status"),
    )


def performance_measures(flag: Column, actual: Column) -> list[Column]:
    """Aggregates of the daily table. A prediction without a label still counts as
    flagged, as the published view defines it."""
    flagged = count_if(flag)
    fraud, legit = count_if(actual == 1), count_if(actual == 0)
    tp, fp = count_if(flag & (actual == 1)), count_if(flag & (actual == 0))
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        flagged.alias("flagged_as_fraud"),
        fraud.alias("actual_fraud_count"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        count_if(~flag & (actual == 1)).alias("false_negatives"),
        count_if(~flag & (actual == 0)).alias("true_negatives"),
        ratio(tp, fraud).alias("recall"),
        ratio(tp, flagged).alias("precision"),
        ratio(fp, legit).alias("false_positive_rate"),
        F.avg("fraud_probability").alias("avg_fraud_score"),
        F.avg("inference_time_ms").alias("avg_latency_ms"),
        F.avg("amount").alias("avg_transaction_amount"),
    ]


def daily_performance(transactions: DataFrame, predictions: DataFrame, ground_truth: DataFrame) -> DataFrame:
    t = transactions.select("transaction_id", "timestamp_received", "amount")
    p = predictions.select("transaction_id", "model_name", "is_fraud", "fraud_probability", "inference_time_ms")
    g = ground_truth.select("transaction_id", "true_label")
    joined = t.join(p, "transaction_id").join(g, "transaction_id", "left")
    return joined.groupBy(F.to_date("timestamp_received").alias("transaction_date"), "model_name").agg(
        *performance_measures(F.col("is_fraud"), F.col("true_label"))
    )


def model_performance(
    transactions: DataFrame,
    predictions: DataFrame,
    ground_truth: DataFrame,
    model_name: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    today: dt.date | None = None,
) -> DataFrame:
    """Daily figures of one model between two dates (inclusive), newest first. Model and
    dates are filters on the base tables, so they prune the scans before the join."""
    today = today or dt.date.today()
    start, end = start or today - dt.timedelta(days=7), end or today
    day = F.to_date("timestamp_received")
    daily = daily_performance(
        transactions.where(day.between(F.lit(start), F.lit(end))),
        predictions.where(F.col("model_name") == model_name),
        ground_truth,
    )
    return daily.select(
        F.col("transaction_date").alias("metric_date"),
        F.col("total_transactions").alias("total_txns"),
        F.col("true_positives").alias("fraud_caught"),
        F.col("false_positives").alias("false_alarms"),
        F.col("false_negatives").alias("missed_fraud"),
        F.col("recall").alias("recall_rate"),
        F.col("precision").alias("precision_rate"),
    ).orderBy(F.col("metric_date").desc())


def leaderboard(registry: DataFrame) -> DataFrame:
    def metric(name):
        return F.get_json_object("metrics", f"$.{name}")

    return (
        registry.where("is_active")
        .select(
            "model_name",
            "model_version",
            metric("pr_auc").alias("pr_auc"),
            metric("recall").alias("recall"),
            metric("precision").alias("precision"),
            metric("fpr").alias("false_positive_rate"),
            metric("f1").alias("f1_score"),
            "is_active",
            "deployed_at",
        )
        .orderBy(F.col("pr_auc").cast("double").desc_nulls_first())
    )


def recent_alerts(monitoring: DataFrame, as_of: Column | None = None, days: int = 7) -> DataFrame:
    as_of = F.current_timestamp() if as_of is None else as_of
    return (
        monitoring.where(F.col("is_warning") | F.col("is_critical"))
        .where(F.col("check_timestamp") >= as_of - F.make_dt_interval(F.lit(days)))
        .select(
            "model_name",
            "check_timestamp",
            "metric_type",
            "metric_value",
            "baseline_value",
            "deviation_percent",
            "is_warning",
            "is_critical",
            "action_taken",
        )
        .orderBy(F.col("check_timestamp").desc())
    )


def newest(df: DataFrame, time: str, k: int = 5, tie: str | None = None) -> DataFrame:
    """A top-k report: the limit is the operator."""
    return df.orderBy(F.col(time).desc(), *([tie] if tie else [])).limit(k)


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row counts of several tables side by side."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.crossJoin(one)  # one row each
    return out


def orphans(child: DataFrame, parent: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Child rows whose parent does not exist."""
    return child.join(parent.select(key), key, "left_anti")


def keep_with_parent(child: DataFrame, parent: DataFrame, key: str = "transaction_id") -> DataFrame:
    """What is left after a cascading delete."""
    return child.join(parent.select(key), key, "left_semi")


def repeated_keys(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def upsert_feedback(ground_truth: DataFrame, feedback: DataFrame) -> DataFrame:
    """Latest report per transaction over the stored labels and the new ones."""
    return latest_per_key(
        ground_truth.unionByName(feedback), ["transaction_id"], ["reported_at", "feedback_id"]
    )


def insert_if_absent(target: DataFrame, new: DataFrame, keys=("model_name", "model_version")) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, ready to be appended."""
    return new.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)


def evaluation_rows(documents: DataFrame, dataset_type: str | None = None) -> DataFrame:
    """Metric documents as monitoring rows: one per known metric, missing ones left out."""
    name = F.col("model_name") if dataset_type is None else F.concat_ws("_", "model_name", F.lit(dataset_type))
    details = F.to_json(
        F.struct(
            F.lit("test_set").alias("evaluation_type"),
            F.col("test_samples"),
            (F.col("fraud_caught") + F.col("fraud_missed")).alias("fraud_count"),
        )
    )
    sources = {
        "pr_auc": "pr_auc",
        "roc_auc": "roc_auc",
        "f1_score": "f1_score",
        "recall": "recall",
        "precision": "precision",
        "fpr": "false_positive_rate",
        "fnr": "false_negative_rate",
    }
    long = F.array(
        *[F.struct(F.lit(k).alias("metric_type"), F.col(c).alias("metric_value")) for k, c in sources.items()]
    )
    return (
        documents.select(name.alias("model_name"), details.alias("details"), F.inline(long))
        .where(F.col("metric_value").isNotNull())
        .select(
            "model_name",
            "metric_type",
            "metric_value",
            F.lit(None).cast("double").alias("baseline_value"),
            F.lit(0.0).alias("deviation_percent"),
            F.lit(False).alias("is_warning"),
            F.lit(False).alias("is_critical"),
            "details",
        )
    )


def drift_rows(drifted: DataFrame) -> DataFrame:
    """Two monitoring rows per model, each with its own flag and the common one."""
    def entry(kind, value, base, change, flag):
        return F.struct(
            F.lit(kind).alias("metric_type"),
            F.col(value).alias("metric_value"),
            F.col(base).alias("baseline_value"),
            (F.col(change) * 100).alias("deviation_percent"),
            F.col(flag).alias("metric_warning"),
        )

    return drifted.select(
        "model_name",
        F.col("any_warning").alias("is_warning"),
        F.lit(False).alias("is_critical"),
        F.lit("{}").alias("details"),
        F.inline(
            F.array(
                entry("pr_auc", "current_pr_auc", "baseline_pr_auc", "pr_auc_relative_change", "pr_auc_warning"),
                entry("fpr", "current_fpr", "baseline_fpr", "fpr_relative_change", "fpr_warning"),
            )
        ),
    )


# --- fixed values: artifact naming ---
METRIC_SUFFIXES = ["_evaluation", "_metrics", "_eval"]


def pair_artifacts(models: DataFrame, documents: DataFrame) -> DataFrame:
    """Model files with their metric file by common stem. ``models`` has (path, stem),
    ``documents`` has (path, stem). The suffix order decides; no metric file, no row;
    scalers are not models; the tier comes from the name."""
    suffix = F.lit(None).cast("int")
    base = F.lit(None).cast("string")
    for rank, s in enumerate(METRIC_SUFFIXES):
        ends = F.col("doc_stem").endswith(s)
        suffix = F.coalesce(suffix, F.when(ends, rank))
        base = F.coalesce(base, F.when(ends, F.expr(f"left(doc_stem, length(doc_stem) - {len(s)})")))
    docs = documents.select(F.col("path").alias("metrics_path"), F.col("stem").alias("doc_stem")).select(
        "metrics_path", suffix.alias("_rank"), base.alias("stem")
    )
    wanted = models.where(~F.contains(F.lower("stem"), F.lit("scaler")))
    tier = (
        F.when(F.col("stem").endswith("_baseline"), "baseline")
        .when(F.col("stem").endswith("_advanced"), "advanced")
        .otherwise("unknown")
    )
    return (
        wanted.join(docs, "stem")
        .groupBy("stem", "path")
        .agg(F.min_by("metrics_path", F.struct("_rank", "metrics_path")).alias("metrics_path"))
        .select(F.col("stem").alias("model_name"), "path", "metrics_path", tier.alias("tier"))
    )


def merge_metrics(cross_validation: DataFrame, test: DataFrame) -> DataFrame:
    """Outer merge of two metric tables by model; models with test figures only stay."""
    cv = cross_validation.select("model_name", F.col("pr_auc").alias("cv_pr_auc"))
    tt = test.select("model_name", F.col("pr_auc").alias("test_pr_auc"))
    return cv.join(tt, "model_name", "full_outer").select(
        "model_name",
        "cv_pr_auc",
        "test_pr_auc",
        F.when(F.col("cv_pr_auc").isNotNull(), "cv").otherwise("test").alias("source"),
    )
