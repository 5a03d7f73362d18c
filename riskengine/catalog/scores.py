"""Score evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskengine.catalog import sql as Q
from riskengine.catalog.registry import query
from riskengine.functions import features as X
from riskengine.operators import metrics as M
from riskengine.schema import THRESHOLDS
from riskengine.sources import adapter as A


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


_CELLS = """count(*) FILTER (p < {t} AND label = 0) AS tn, count(*) FILTER (p >= {t} AND label = 0) AS fp,
 count(*) FILTER (p < {t} AND label = 1) AS fn, count(*) FILTER (p >= {t} AND label = 1) AS tp"""
_C05 = f"c AS (SELECT model_name, {_CELLS.format(t=0.5)} FROM scored GROUP BY model_name)"


@query("a1_confusion_matrix", f"WITH {Q.SCORED}, {_C05} SELECT * FROM c")
def _(spark, sf):
    return M.confusion_matrix(A.scored(spark, sf))


@query(
    "p17_threshold_decision",
    f"WITH {Q.SCORED} SELECT model_name, txn_id, p >= 0.5 AS is_fraud FROM scored",
)
def _(spark, sf):
    from riskengine.functions.columns import decision

    return A.scored(spark, sf).select("model_name", "txn_id", decision("p", 0.5).alias("is_fraud"))


@query(
    "a2_binary_metrics",
    f"""WITH {Q.SCORED}, {_C05} SELECT *, round_even(tp / (tp + fp), 4) AS precision, round_even(tp / (tp + fn), 4) AS recall,
 round_even(2 * tp / (2 * tp + fp + fn), 4) AS f1_score, round_even(tn / (tn + fp), 4) AS specificity,
 round_even(fp / (tn + fp), 4) AS false_positive_rate, round_even(fn / (tp + fn), 4) AS false_negative_rate FROM c""",
)
def _(spark, sf):
    return M.rates(M.confusion_matrix(A.scored(spark, sf)))


CURVE = """d AS (SELECT model_name, p, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM scored GROUP BY ALL),
 k AS (SELECT *, CAST(sum(n) OVER w - n AS BIGINT) AS before_n, CAST(sum(pos) OVER w - pos AS BIGINT) AS before_pos FROM d
  WINDOW w AS (PARTITION BY model_name ORDER BY p DESC ROWS UNBOUNDED PRECEDING))"""


@query("w11_cumulative_curve", f"WITH {Q.SCORED}, {CURVE} SELECT * FROM k")
def _(spark, sf):
    return M.score_curve(A.scored(spark, sf))


_AREAS = f"""WITH {Q.SCORED}, {CURVE} SELECT model_name, CAST(sum(n) AS BIGINT) AS samples, CAST(sum(pos) AS BIGINT) AS positives,
 round(sum(pos * ((before_pos + pos) / (before_n + n) + CASE WHEN before_n > 0 THEN before_pos / before_n ELSE 1 END) / 2) / sum(pos), 6) AS pr_auc,
 round(sum(pos * ((before_pos + pos) / (before_n + n))) / sum(pos), 6) AS average_precision,
 round(sum((n - pos) * (before_pos + pos / 2)) / sum(pos) / sum(n - pos), 6) AS roc_auc FROM k GROUP BY model_name"""


@query("a3_pr_auc_trapezoid", _AREAS)
def _(spark, sf):
    return rounded(M.ranking_metrics(A.scored(spark, sf), digits=None), ["pr_auc", "average_precision", "roc_auc"])


@query(
    "a4_average_precision",
    f"SELECT model_name, average_precision FROM ({_AREAS})",
)
def _(spark, sf):
    return rounded(M.ranking_metrics(A.scored(spark, sf), digits=None), ["average_precision"]).select(
        "model_name", "average_precision"
    )


@query(
    "a5_roc_auc",
    f"""WITH {Q.SCORED}, r AS (SELECT model_name, label, rank() OVER w + (count(*) OVER (PARTITION BY model_name, p) - 1) / 2 AS r
  FROM scored WINDOW w AS (PARTITION BY model_name ORDER BY p))
 SELECT model_name, round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
  / count(*) FILTER (label = 1) / count(*) FILTER (label = 0), 6) AS roc_auc FROM r GROUP BY model_name""",
)
def _(spark, sf):
    return rounded(M.ranking_metrics(A.scored(spark, sf), digits=None), ["roc_auc"]).select("model_name", "roc_auc")


@query(
    "a27_single_class_guard",
    f"""WITH {Q.SCORED} SELECT model_name, count(*) AS samples, 0::BIGINT AS positives, 0.0::DOUBLE AS pr_auc, 0.0::DOUBLE AS average_precision,
 0.0::DOUBLE AS roc_auc FROM scored WHERE label = 0 GROUP BY 1""",
)
def _(spark, sf):
    return M.ranking_metrics(A.scored(spark, sf).where("label = 0"))


SWEEP = f"""th AS (SELECT unnest({THRESHOLDS}::DOUBLE[]) AS t),
 g AS (SELECT model_name, t, count(*) FILTER (p < t AND label = 0) AS tn, count(*) FILTER (p >= t AND label = 0) AS fp,
  count(*) FILTER (p < t AND label = 1) AS fn, count(*) FILTER (p >= t AND label = 1) AS tp FROM scored, th GROUP BY ALL),
 sweep AS (SELECT model_name, t AS threshold, round_even(tp / (tp + fn), 4) AS recall,
  CASE WHEN tp + fp > 0 THEN round_even(tp / (tp + fp), 4) ELSE 0.0 END AS precision, round_even(fp / (fp + tn), 4) AS fpr,
  round_even(2 * tp / (2 * tp + fp + fn), 4) AS f1_score, tp AS fraud_caught, fn AS fraud_missed, fp AS false_alarms, tn AS true_negatives,
  fn * 500.0::DOUBLE + fp * 300.0::DOUBLE AS business_cost FROM g)"""


@query("a6_threshold_sweep", f"WITH {Q.SCORED}, {SWEEP} SELECT * FROM sweep")
def _(spark, sf):
    return M.threshold_sweep(A.scored(spark, sf))


@query(
    "j4_scores_by_thresholds",
    f"WITH {Q.SCORED}, {SWEEP} SELECT model_name, threshold, fraud_caught, false_alarms FROM sweep",
)
def _(spark, sf):
    return M.threshold_sweep(A.scored(spark, sf)).select("model_name", "threshold", "fraud_caught", "false_alarms")


@query(
    "a7_best_operating_point",
    f"""WITH {Q.SCORED}, {SWEEP} SELECT model_name, arg_min(threshold, (-f1_score, threshold)) AS best_f1_threshold,
 arg_min(threshold, (business_cost, threshold)) AS best_cost_threshold FROM sweep GROUP BY model_name""",
)
def _(spark, sf):
    return M.best_points(M.threshold_sweep(A.scored(spark, sf)))


@query(
    "a8_key_thresholds",
    f"WITH {Q.SCORED}, {SWEEP} SELECT * FROM sweep WHERE threshold IN (0.3, 0.5, 0.7)",
)
def _(spark, sf):
    return M.key_threshold_table(M.threshold_sweep(A.scored(spark, sf)))


_PROFILE = [
    "Amount_raw", "fraud_direction_score", "fraud_feature_magnitude", "V14", "V17", "V4", "V14_V10", "V16_V17",
    "time_since_last_txn", "hour", "txn_count_10min", "V8",
]
_J3 = f"""WITH {Q.SCORED}, tx AS (SELECT l.*, {Q._V_DEFS} FROM log l JOIN embeddings e ON e.vec_id = l.txn_id % (SELECT count(*) FROM embeddings)),
 {Q.trailing('log', 600, 'w10m')}, rec AS (SELECT txn_id, coalesce(time_s - lag(time_s) OVER (ORDER BY time_s, txn_id), 0) AS time_since_last_txn FROM log),
 feats AS (SELECT txn_id, Amount AS Amount_raw, {" + ".join(f"CASE WHEN {c} < 0 THEN 1 ELSE 0 END" for c in X.SIGNAL_COLUMNS)} AS fraud_direction_score,
  {" + ".join(f"abs({c})" for c in X.SIGNAL_COLUMNS)} AS fraud_feature_magnitude, V14, V17, V4, V14 * V10 AS V14_V10, V16 * V17 AS V16_V17,
  time_since_last_txn, CAST(time_s // 3600 % 24 AS INTEGER) AS hour, count_w10m AS txn_count_10min, V8 FROM tx JOIN w10m USING (txn_id) JOIN rec USING (txn_id)),
 x AS (SELECT s.p AS probability, s.p >= 0.5 AS caught, f.* FROM scored s JOIN feats f USING (txn_id) WHERE model_name = 'model_a' AND label = 1)"""


def features_for_profile(spark, sf):
    from riskengine.plans.features import velocity

    rows = A.log(spark, sf).select("txn_id", "time_s", "Amount")
    made = velocity(rows, {"10min": 600}, "time_since_last_txn").select("txn_id", "txn_count_10min", "time_since_last_txn")
    wide = A.txn(spark, sf).transform(X.calendar).transform(X.interactions).transform(X.signal_score)
    return wide.withColumnRenamed("Amount", "Amount_raw").join(made, "txn_id")


@query(
    "a20_missed_vs_caught",
    _J3
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, "
        + ", ".join(
            f"round_even({fn}(CAST({c} AS DOUBLE)) FILTER ({cond}), 4) AS {side}_{name}"
            for side, cond in (("missed", "NOT caught"), ("caught", "caught"))
            for name, fn in (("mean", "avg"), ("median", "median"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
        )
        + ", missed_mean < caught_mean AS missed_is_lower FROM x"
        for c in ["probability", *_PROFILE]
    ),
)
def _(spark, sf):
    scored = A.scored(spark, sf).where("model_name = 'model_a'")
    return M.outcome_profile(scored, features_for_profile(spark, sf), _PROFILE)


@query(
    "j3_score_feature_alignment",
    f"{_J3} SELECT txn_id, probability, caught, V14, hour FROM x",
)
def _(spark, sf):
    scored = A.scored(spark, sf).where("model_name = 'model_a' AND label = 1")
    return scored.select("txn_id", F.col("p").alias("probability"), (F.col("p") >= 0.5).alias("caught")).join(
        features_for_profile(spark, sf).select("txn_id", "V14", "hour"), "txn_id"
    )


# one "model" per card gives a comparison table that grows with the data
_DOCS = f"""WITH {Q.SCORED}, d AS (SELECT 'card_' || (txn_id % 150) AS model_name, {_CELLS.format(t=0.5)} FROM scored GROUP BY 1),
 m AS (SELECT model_name, CASE WHEN tp + fp > 0 THEN round_even(tp / (tp + fp), 4) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN round_even(tp / (tp + fn), 4) ELSE 0.0 END AS recall,
  CASE WHEN fp + tn > 0 THEN round_even(fp / (fp + tn), 4) ELSE 0.0 END AS false_positive_rate, * EXCLUDE (model_name) FROM d)"""


def documents(spark, sf):
    s = A.scored(spark, sf).withColumn("model_name", F.concat(F.lit("card_"), F.col("txn_id") % 150))
    return M.rates(M.confusion_matrix(s)).select(
        "model_name",
        F.col("precision").alias("pr_auc"),
        "precision",
        "recall",
        "false_positive_rate",
        F.col("tp").alias("fraud_caught"),
        F.col("fn").alias("fraud_missed"),
        F.col("fp").alias("legitimate_declined"),
    )


@query(
    "a21_model_comparison",
    f"""{_DOCS}, b AS (SELECT max_by(model_name, (precision, model_name)) AS bp, max_by(model_name, (recall, model_name)) AS br FROM m)
 SELECT model_name, precision AS pr_auc, precision, recall, false_positive_rate, model_name = bp AS best_pr_auc, model_name = bp AS best_precision,
 model_name = br AS best_recall FROM m, b""",
)
def _(spark, sf):
    return M.compare_models(documents(spark, sf))


@query(
    "a22_business_table",
    f"""{_DOCS} SELECT model_name, precision AS pr_auc, precision, recall, tp AS fraud_caught, tp + fn AS total_fraud, fp AS false_alarms,
 false_positive_rate, fn * 500.0::DOUBLE + fp * 300.0::DOUBLE AS business_cost FROM m""",
)
def _(spark, sf):
    return M.business_table(documents(spark, sf))


@query(
    "a25_anomaly_evaluation",
    f"""WITH {Q.SCORED}, {CURVE}, s AS (SELECT * FROM scored WHERE model_name = 'model_a'),
 o AS (SELECT label, row_number() OVER (ORDER BY p DESC, txn_id DESC) AS r, (SELECT sum(label) FROM s) AS k FROM s)
 SELECT round_even((SELECT sum((n - pos) * (before_pos + pos / 2)) / sum(pos) / sum(n - pos) FROM k WHERE model_name = 'model_a'), 4) AS roc_auc,
 round_even((SELECT sum(pos * ((before_pos + pos) / (before_n + n) + CASE WHEN before_n > 0 THEN before_pos / before_n ELSE 1 END) / 2) / sum(pos) FROM k WHERE model_name = 'model_a'), 4) AS pr_auc,
 round_even((SELECT sum(pos * ((before_pos + pos) / (before_n + n))) / sum(pos) FROM k WHERE model_name = 'model_a'), 4) AS average_precision,
 round(avg(p) FILTER (label = 0), 6) AS normal_mean_error, round(avg(p) FILTER (label = 1), 6) AS fraud_mean_error,
 round(avg(p) FILTER (label = 1) / avg(p) FILTER (label = 0), 2) AS error_ratio,
 (SELECT round(sum(label) / any_value(k) * 100, 1) FROM o WHERE r <= k) AS fraud_in_top_k_pct FROM s""",
)
def _(spark, sf):
    return M.anomaly_evaluation(A.scored(spark, sf).where("model_name = 'model_a'"))


@query(
    "t7_top_k_by_score",
    f"""WITH {Q.SCORED}, s AS (SELECT * FROM scored WHERE model_name = 'model_b'),
 o AS (SELECT label, row_number() OVER (ORDER BY p DESC, txn_id DESC) AS r, (SELECT sum(label) FROM s) AS k FROM s)
 SELECT CAST(any_value(k) AS BIGINT) AS k, CAST(sum(label) AS BIGINT) AS hits FROM o WHERE r <= k""",
)
def _(spark, sf):
    k, hits = M.top_k_hits(A.scored(spark, sf).where("model_name = 'model_b'"))
    return spark.createDataFrame([(k, hits)], "k long, hits long")


@query(
    "m9_class_weights",
    f"""WITH {Q.LOG} SELECT Class, count(*) AS n, (SELECT count(*) FROM log) / (2 * count(*)) AS balanced_weight,
 (SELECT count(*) FILTER (Class = 0) / count(*) FILTER (Class = 1) FROM log) AS neg_pos_ratio FROM log GROUP BY Class""",
)
def _(spark, sf):
    return M.class_weights(A.log(spark, sf))


@query(
    "x1_operating_points",
    f"""WITH {Q.SCORED}, {CURVE}, t AS (SELECT model_name, sum(n) AS tn, sum(pos) AS tp FROM k GROUP BY 1)
 SELECT model_name, max(p) FILTER (before_pos + pos >= 0.8::DOUBLE * tp) AS threshold_at_recall,
 min(p) FILTER (before_n + n - before_pos - pos <= 0.01::DOUBLE * (tn - tp)) AS threshold_at_fpr FROM k JOIN t USING (model_name) GROUP BY 1""",
)
def _(spark, sf):
    return M.operating_points(A.scored(spark, sf))


@query(
    "a24_fold_aggregation",
    f"""WITH {Q.LOG}, f AS (SELECT 'card_' || (card_id % 20) AS model_name, CASE WHEN Class = 1 THEN 'fraud_amount' ELSE 'amount' END AS metric,
 CAST(txn_id % 3 AS INTEGER) AS fold, round(avg(Amount), 3) AS value FROM log GROUP BY ALL)
 SELECT model_name, metric, round(avg(value), 2) AS mean, round(stddev_pop(value), 2) AS std, array_to_string(list(CAST(round(value, 0) AS BIGINT) ORDER BY fold), ',') AS folds FROM f GROUP BY 1, 2""",
)
def _(spark, sf):
    """Mean, deviation and ordered values per model and metric, on figures of the log."""
    folds = (
        A.log(spark, sf)
        .groupBy(
            F.concat(F.lit("card_"), F.col("card_id") % 20).alias("model_name"),
            F.when(F.col("Class") == 1, "fraud_amount").otherwise("amount").alias("metric"),
            (F.col("txn_id") % 3).cast("int").alias("fold"),
        )
        .agg(F.round(F.avg("Amount"), 3).alias("value"))
    )
    out = M.fold_summary(folds, digits=6)
    whole = F.transform("folds", lambda x: F.round(x, 0).cast("long").cast("string"))
    return rounded(out, ["mean", "std"], 2).withColumn("folds", F.array_join(whole, ","))


_IMPORTANCE = ["V1", "V3", "V4", "V7", "V10", "V12", "V14", "V17", "Amount", "amount_log", "hour_sin"]


@query(
    "a23_importance_table",
    f"""WITH {Q.TXN}, x AS (SELECT *, ln(1 + Amount) AS amount_log, sin(2 * pi() * (time_s // 3600 % 24) / 24) AS hour_sin FROM txn), i AS ("""
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, Class)) AS importance FROM x" for c in _IMPORTANCE)
    + """), t AS (SELECT * FROM i ORDER BY importance DESC, feature LIMIT 10)
 SELECT feature, round(importance, 6) AS importance, round(importance / (SELECT max(importance) FROM t), 6) AS relative,
 feature LIKE 'amount_%' OR feature = 'hour_sin' AS is_engineered FROM t""",
)
def _(spark, sf):
    """The importance table, with the absolute label correlation as importance."""
    from riskengine.functions import features as X
    from riskengine.operators.profiling import label_correlation

    rows = A.txn(spark, sf).transform(X.calendar).transform(X.amount_log)
    found = label_correlation(rows, _IMPORTANCE).select(
        F.col("column").alias("feature"), F.abs("correlation").alias("importance")
    )
    return rounded(M.normalised_importance(found), ["importance", "relative"])


@query(
    "m18_evaluation_documents",
    f"""WITH {Q.SCORED}, {CURVE}, {_C05}, a AS (SELECT model_name, CAST(sum(n) AS BIGINT) AS test_samples,
 sum(pos * ((before_pos + pos) / (before_n + n) + CASE WHEN before_n > 0 THEN before_pos / before_n ELSE 1 END) / 2) / sum(pos) AS pr_auc,
 sum(pos * ((before_pos + pos) / (before_n + n))) / sum(pos) AS average_precision,
 sum((n - pos) * (before_pos + pos / 2)) / sum(pos) / sum(n - pos) AS roc_auc FROM k GROUP BY model_name)
 SELECT model_name, round_even(pr_auc, 4) AS pr_auc, round_even(roc_auc, 4) AS roc_auc, round_even(average_precision, 4) AS average_precision,
 round_even(tp / (tp + fp), 4) AS precision, round_even(tp / (tp + fn), 4) AS recall, round_even(2 * tp / (2 * tp + fp + fn), 4) AS f1_score,
 round_even(tn / (tn + fp), 4) AS specificity, round_even(fp / (tn + fp), 4) AS false_positive_rate, round_even(fn / (tp + fn), 4) AS false_negative_rate,
 tn, fp, fn, tp, test_samples FROM a JOIN c USING (model_name)""",
)
def _(spark, sf):
    docs = M.evaluate(A.scored(spark, sf))
    cells = {"tn": "true_negatives", "fp": "false_positives", "fn": "false_negatives", "tp": "true_positives"}
    return docs.select(
        "model_name", "pr_auc", "roc_auc", "average_precision", *M.RATES,
        *[F.col(f"confusion_matrix.{long}").alias(short) for short, long in cells.items()], "test_samples",
    )


_HALF = """{0}d AS (SELECT model_name, p, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos FROM scored WHERE ts {1} TIMESTAMP '2024-01-16' GROUP BY ALL),
 {0}k AS (SELECT *, sum(n) OVER w - n AS before_n, sum(pos) OVER w - pos AS before_pos FROM {0}d WINDOW w AS (PARTITION BY model_name ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
 {0} AS (SELECT model_name, sum(pos * ((before_pos + pos) / (before_n + n))) / sum(pos) AS ap, sum(n - pos) FILTER (p >= 0.5) / sum(n - pos) AS fpr FROM {0}k GROUP BY 1)"""


@query(
    "a29_monitoring_verdict",
    f"""WITH {Q.SCORED}, {_HALF.format('b', '<')}, {_HALF.format('c', '>=')} SELECT model_name, round(b.ap, 6) AS baseline_pr_auc, round(c.ap, 6) AS current_pr_auc,
 round(b.fpr, 6) AS baseline_fpr, round(c.fpr, 6) AS current_fpr, round(c.fpr / b.fpr - 1, 5) AS fpr_relative_change, round(1 - c.ap / b.ap, 5) AS pr_auc_relative_change,
 c.fpr / b.fpr - 1 > 0.2 AS fpr_warning, 1 - c.ap / b.ap > 0.1 AS pr_auc_warning, c.fpr / b.fpr - 1 > 0.2 OR 1 - c.ap / b.ap > 0.1 AS any_warning FROM b JOIN c USING (model_name)""",
)
def _(spark, sf):
    from riskengine.plans import runs

    s = A.scored(spark, sf)
    edge = F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    baseline = M.evaluate(s.where(F.col("ts") < edge), digits=None).select(
        "model_name", F.col("average_precision").alias("pr_auc"), "false_positive_rate", F.lit(0.5).alias("threshold")
    )
    out = runs.monitoring(s.where(F.col("ts") >= edge), baseline).drop("fpr_limit", "pr_auc_limit")
    out = rounded(out, ["baseline_pr_auc", "current_pr_auc", "baseline_fpr", "current_fpr"])
    return rounded(out, ["fpr_relative_change", "pr_auc_relative_change"], 5)
