"""Audit views, joins, feedback, registry and monitoring tables (J, P20-P22, A9, A10, T3-T5, Q, S5, S6, S10, S11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskengine import schema as S
from riskengine.catalog import sql as Q
from riskengine.catalog.registry import query
from riskengine.catalog.scores import CURVE
from riskengine.operators import metrics as M
from riskengine.operators import views as V
from riskengine.session import scratch_path
from riskengine.sources import adapter as A
from riskengine.sources import readers, sinks

AS_OF = "2024-01-31 00:00:00"


def as_of():
    return F.expr(f"TIMESTAMP_NTZ'{AS_OF}'")


def audit(spark, sf):
    return A.transactions(spark, sf), A.predictions(spark, sf), A.ground_truth(spark, sf)


_CASES = """CASE WHEN p.is_fraud AND g.true_label = 1 THEN '{0}' WHEN p.is_fraud AND g.true_label = 0 THEN '{1}'
 WHEN NOT p.is_fraud AND g.true_label = 1 THEN '{2}' WHEN NOT p.is_fraud AND g.true_label = 0 THEN '{3}' ELSE '{4}' END"""

RESULTS = f"""results AS (SELECT t.transaction_id, t.timestamp_received, t.time_seconds, t.amount, t.card_id, t.merchant_id,
 p.fraud_probability, p.is_fraud AS predicted_fraud, p.model_name, p.model_version, p.inference_time_ms,
 g.true_label AS actual_fraud, g.feedback_source, g.reported_at AS feedback_reported_at,
 {_CASES.format(*V.CATEGORY)} AS result_category, {_CASES.format(*V.STATUS)} AS result_status
 FROM transactions t LEFT JOIN predictions p USING (transaction_id) LEFT JOIN ground_truth g USING (transaction_id))"""


@query("j1_transaction_results", f"WITH {Q.AUDIT}, {RESULTS} SELECT * FROM results")
def _(spark, sf):
    return V.transaction_results(*audit(spark, sf))


@query("j1_transaction_results_split", f"WITH {Q.AUDIT}, {RESULTS} SELECT * FROM results")
def _(spark, sf):
    """The same view on the plan for a transaction with very many predictions."""
    return V.transaction_results(*audit(spark, sf), split_hot=True)


@query(
    "p20_outcome_category",
    f"""WITH {Q.AUDIT}, {RESULTS} SELECT result_category, result_status, count(*) AS rows, round(avg(amount), 6) AS avg_amount
 FROM results GROUP BY ALL""",
)
def _(spark, sf):
    return (
        V.transaction_results(*audit(spark, sf))
        .groupBy("result_category", "result_status")
        .agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("amount"), 6).alias("avg_amount"))
    )


DAILY = """daily AS (SELECT CAST(t.timestamp_received AS DATE) AS transaction_date, p.model_name, count(*) AS total_transactions,
 count(*) FILTER (p.is_fraud) AS flagged_as_fraud, count(*) FILTER (g.true_label = 1) AS actual_fraud_count,
 count(*) FILTER (p.is_fraud AND g.true_label = 1) AS true_positives,
 count(*) FILTER (p.is_fraud AND g.true_label = 0) AS false_positives,
 count(*) FILTER (NOT p.is_fraud AND g.true_label = 1) AS false_negatives,
 count(*) FILTER (NOT p.is_fraud AND g.true_label = 0) AS true_negatives,
 CASE WHEN actual_fraud_count > 0 THEN true_positives / actual_fraud_count ELSE 0.0 END AS recall,
 CASE WHEN flagged_as_fraud > 0 THEN true_positives / flagged_as_fraud ELSE 0.0 END AS precision,
 CASE WHEN count(*) FILTER (g.true_label = 0) > 0 THEN false_positives / count(*) FILTER (g.true_label = 0) ELSE 0.0 END AS false_positive_rate,
 avg(p.fraud_probability) AS avg_fraud_score, avg(p.inference_time_ms) AS avg_latency_ms, avg(t.amount) AS avg_transaction_amount
 FROM transactions t JOIN predictions p USING (transaction_id) LEFT JOIN ground_truth g USING (transaction_id) GROUP BY 1, 2)"""
_DAILY_ROUNDED = """SELECT * REPLACE (round(recall, 6) AS recall, round(precision, 6) AS precision,
 round(false_positive_rate, 6) AS false_positive_rate, round(avg_fraud_score, 6) AS avg_fraud_score,
 round(avg_latency_ms, 6) AS avg_latency_ms, round(avg_transaction_amount, 6) AS avg_transaction_amount) FROM daily"""


def rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("a9_daily_performance", f"WITH {Q.AUDIT}, {DAILY} {_DAILY_ROUNDED}")
def _(spark, sf):
    return rounded(
        V.daily_performance(*audit(spark, sf)),
        ["recall", "precision", "false_positive_rate", "avg_fraud_score", "avg_latency_ms", "avg_transaction_amount"],
    )


@query(
    "j2_inner_left_aggregate",
    f"""WITH {Q.AUDIT} SELECT p.model_name, g.feedback_source, count(*) AS rows, count(g.true_label) AS labelled,
 round(avg(t.amount), 6) AS avg_amount FROM transactions t JOIN predictions p USING (transaction_id)
 LEFT JOIN ground_truth g USING (transaction_id) GROUP BY ALL""",
)
def _(spark, sf):
    t, p, g = audit(spark, sf)
    return (
        t.join(p, "transaction_id")
        .join(g.select("transaction_id", "true_label", "feedback_source"), "transaction_id", "left")
        .groupBy("model_name", "feedback_source")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("true_label").alias("labelled"),
            F.round(F.avg("amount"), 6).alias("avg_amount"),
        )
    )


@query(
    "a10_model_performance",
    f"""WITH {Q.AUDIT}, {DAILY} SELECT transaction_date AS metric_date, total_transactions AS total_txns,
 true_positives AS fraud_caught, false_positives AS false_alarms, false_negatives AS missed_fraud,
 round(recall, 6) AS recall_rate, round(precision, 6) AS precision_rate FROM daily
 WHERE model_name = 'model_a' AND transaction_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
def _(spark, sf):
    out = V.model_performance(*audit(spark, sf), "model_a", dt.date(2024, 1, 10), dt.date(2024, 1, 20))
    return rounded(out, ["recall_rate", "precision_rate"])


@query(
    "p22_date_predicates",
    f"""WITH {Q.LOG} SELECT CAST(ts AS DATE) AS day, count(*) AS rows, round(sum(Amount), 4) AS amount FROM log
 WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS AND CAST(ts AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-01-29' GROUP BY 1""",
)
def _(spark, sf):
    day = F.to_date("ts")
    return (
        A.log(spark, sf)
        .where(F.col("ts") >= as_of() - F.expr("INTERVAL 7 DAYS"))
        .where(day.between(F.lit(dt.date(2024, 1, 25)), F.lit(dt.date(2024, 1, 29))))
        .groupBy(day.alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("Amount"), 4).alias("amount"))
    )


# ---- model registry: one entry per order, metrics kept as JSON text ----


def registry(spark, sf):
    def part(k):
        return F.concat(F.lit("0."), F.lpad(((F.col("o_orderkey") * k) % 10000).cast("string"), 4, "0"))

    metrics = F.concat(
        *[x for n, k in (("pr_auc", 7), ("recall", 11), ("precision", 13), ("fpr", 17)) for x in
          (F.lit(("{" if n == "pr_auc" else ", ") + f'"{n}": '), part(k))],
        F.lit(', "f1": '),
        part(19),
        F.lit("}"),
    )
    return A.table(spark, sf, "orders").select(
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("model_id"),
        F.concat(F.lit("model_"), "o_custkey").alias("model_name"),
        F.col("o_orderkey").cast("string").alias("model_version"),
        F.lit(None).cast("string").alias("model_filepath"),
        metrics.alias("metrics"),
        (F.col("o_orderstatus") == "F").alias("is_active"),
        F.col("o_orderdate").alias("deployed_at"),
        F.lit(None).cast("timestamp_ntz").alias("decommissioned_at"),
    )


def _num(k):
    return f"'0.' || lpad(CAST((o_orderkey * {k}) % 10000 AS VARCHAR), 4, '0')"


REGISTRY = f"""registry AS (SELECT 'model_' || o_custkey AS model_name, CAST(o_orderkey AS VARCHAR) AS model_version,
 {_num(7)} AS pr_auc, {_num(11)} AS recall, {_num(13)} AS precision, {_num(17)} AS false_positive_rate, {_num(19)} AS f1_score,
 o_orderstatus = 'F' AS is_active, o_orderdate AS deployed_at FROM orders)"""


def _canonical(df):
    """JSON numbers print without trailing zeros in some readers: compare as numbers."""
    cols = ["pr_auc", "recall", "precision", "false_positive_rate", "f1_score"]
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


_LEAD = """SELECT model_name, model_version, CAST(pr_auc AS DOUBLE) AS pr_auc, CAST(recall AS DOUBLE) AS recall,
 CAST(precision AS DOUBLE) AS precision, CAST(false_positive_rate AS DOUBLE) AS false_positive_rate,
 CAST(f1_score AS DOUBLE) AS f1_score, is_active, deployed_at FROM registry WHERE is_active"""


@query("t3_leaderboard", f"WITH {REGISTRY} {_LEAD}")
def _(spark, sf):
    return _canonical(V.leaderboard(registry(spark, sf)))


@query(
    "p21_json_fields",
    f"""WITH {REGISTRY} SELECT CAST(floor(CAST(pr_auc AS DOUBLE) * 10) AS BIGINT) AS band, count(*) AS models,
 round(avg(CAST(recall AS DOUBLE)), 6) AS avg_recall, round(max(CAST(precision AS DOUBLE)), 6) AS best_precision FROM registry GROUP BY 1""",
)
def _(spark, sf):
    m = F.from_json("metrics", "pr_auc double, recall double, precision double")
    return (
        registry(spark, sf)
        .select(m.alias("m"))
        .groupBy(F.floor(F.col("m.pr_auc") * 10).alias("band"))
        .agg(
            F.count(F.lit(1)).alias("models"),
            F.round(F.avg("m.recall"), 6).alias("avg_recall"),
            F.round(F.max("m.precision"), 6).alias("best_precision"),
        )
    )


@query(
    "q2_insert_if_absent",
    f"""WITH {REGISTRY} SELECT model_name, model_version, is_active FROM registry
 WHERE CAST(model_version AS BIGINT) % 3 = 0""",
)
def _(spark, sf):
    every = registry(spark, sf)
    stored = every.where(F.col("model_version").cast("long") % 3 != 0)
    return V.insert_if_absent(stored, every).select("model_name", "model_version", "is_active")


@query(
    "m15_best_model",
    f"""WITH {REGISTRY} SELECT max_by(model_name, (CAST(pr_auc AS DOUBLE), model_version)) AS model_name,
 max(CAST(pr_auc AS DOUBLE)) AS pr_auc FROM registry WHERE is_active""",
)
def _(spark, sf):
    lead = _canonical(V.leaderboard(registry(spark, sf)))
    return lead.agg(
        F.max_by("model_name", F.struct("pr_auc", "model_version")).alias("model_name"), F.max("pr_auc").alias("pr_auc")
    )


# ---- monitoring log: one check per event ----


def monitoring(spark, sf):
    return A.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("check_id"),
        F.concat(F.lit("model_"), F.col("user_id") % 5).alias("model_name"),
        F.col("ts").alias("check_timestamp"),
        F.col("event_type").alias("metric_type"),
        F.col("value").alias("metric_value"),
        F.lit(50.0).alias("baseline_value"),
        (F.col("value") - 50).alias("deviation_percent"),
        (F.col("event_id") % 7 == 0).alias("is_warning"),
        (F.col("event_id") % 13 == 0).alias("is_critical"),
        F.lit("none").alias("action_taken"),
    )


MONITORING = """monitoring AS (SELECT 'model_' || (user_id % 5) AS model_name, ts AS check_timestamp, event_type AS metric_type,
 value AS metric_value, 50.0::DOUBLE AS baseline_value, value - 50 AS deviation_percent, event_id % 7 = 0 AS is_warning,
 event_id % 13 = 0 AS is_critical, 'none' AS action_taken FROM events)"""


@query(
    "t4_recent_alerts",
    f"""WITH {MONITORING} SELECT * FROM monitoring WHERE (is_warning OR is_critical)
 AND check_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS""",
)
def _(spark, sf):
    return V.recent_alerts(monitoring(spark, sf), as_of())


@query("t5_newest_rows", f"WITH {Q.LOG} SELECT txn_id, ts, Amount FROM log ORDER BY ts DESC, txn_id LIMIT 5")
def _(spark, sf):
    return V.newest(A.log(spark, sf).select("txn_id", "ts", "Amount"), "ts", 5, "txn_id")


@query(
    "t1_order_by_time",
    f"WITH {Q.LOG} SELECT txn_id, time_s, Amount, row_number() OVER (ORDER BY time_s, txn_id) - 1 AS pos FROM log",
)
def _(spark, sf):
    from riskengine.operators.windows import trailing_stats

    return trailing_stats(A.log(spark, sf).select("txn_id", "time_s", "Amount"), {}, position="pos")


@query(
    "a28_table_counts",
    f"""WITH {Q.AUDIT} SELECT (SELECT count(*) FROM transactions) AS transactions, (SELECT count(*) FROM predictions) AS predictions,
 (SELECT count(*) FROM ground_truth) AS ground_truth""",
)
def _(spark, sf):
    t, p, g = audit(spark, sf)
    return V.table_counts(transactions=t, predictions=p, ground_truth=g)


@query(
    "s6_labelled_predictions",
    f"""WITH {Q.AUDIT}, {RESULTS} SELECT transaction_id, timestamp_received, model_name, fraud_probability, actual_fraud
 FROM results WHERE actual_fraud IS NOT NULL AND timestamp_received >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS""",
)
def _(spark, sf):
    return readers.labelled_predictions(*audit(spark, sf), as_of=as_of())


# ---- integrity, feedback ----

_WITH_ORPHANS = f"""WITH {Q.AUDIT}, mixed AS (SELECT prediction_id, transaction_id FROM predictions UNION ALL
 SELECT prediction_id || '-o', CAST(CAST(transaction_id AS BIGINT) + 10000000 AS VARCHAR) FROM predictions
 WHERE CAST(transaction_id AS BIGINT) % 100 = 0)"""


def with_orphans(spark, sf):
    p = A.predictions(spark, sf).select("prediction_id", "transaction_id")
    tid = F.col("transaction_id").cast("long")
    lost = p.where(tid % 100 == 0).select(
        F.concat("prediction_id", F.lit("-o")).alias("prediction_id"),
        (tid + 10_000_000).cast("string").alias("transaction_id"),
    )
    return p.unionByName(lost)


@query(
    "j5_orphans",
    f"{_WITH_ORPHANS} SELECT * FROM mixed m WHERE NOT EXISTS (SELECT 1 FROM transactions t WHERE t.transaction_id = m.transaction_id)",
)
def _(spark, sf):
    return V.orphans(with_orphans(spark, sf), A.transactions(spark, sf))


@query(
    "j5_cascade_keep",
    f"{_WITH_ORPHANS} SELECT * FROM mixed m WHERE EXISTS (SELECT 1 FROM transactions t WHERE t.transaction_id = m.transaction_id)",
)
def _(spark, sf):
    return V.keep_with_parent(with_orphans(spark, sf), A.transactions(spark, sf))


@query(
    "j5_repeated_keys",
    f"WITH {Q.AUDIT} SELECT transaction_id, count(*) AS rows FROM feedback_log GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, sf):
    return V.repeated_keys(A.feedback_log(spark, sf))


_LATEST = """SELECT feedback_id, transaction_id, true_label, feedback_source, reported_at, notes FROM
 (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY reported_at DESC, feedback_id DESC) AS rn FROM {0}) WHERE rn = 1"""


@query("q1_feedback_upsert", f"WITH {Q.AUDIT} {_LATEST.format('feedback_log')}")
def _(spark, sf):
    log = A.feedback_log(spark, sf)
    stored, new = log.where(F.col("notes").isNull()), log.where(F.col("notes").isNotNull())
    return V.upsert_feedback(stored, new)


@query("q1_stored_upsert", f"WITH {Q.AUDIT} SELECT * FROM ({_LATEST.format('feedback_log')})")
def _(spark, sf):
    """The corrections merged into a stored table of first reports, twice: the second time changes nothing."""
    log = A.feedback_log(spark, sf)
    path = scratch_path(spark, "ground-truth")
    sinks.create_upsert_table(log.where(F.col("notes").isNull()), path, ["transaction_id"])
    for _turn in range(2):
        sinks.upsert(log.where(F.col("notes").isNotNull()), path, ["transaction_id"], ["reported_at", "feedback_id"])
    return sinks.read_upsert_table(spark, path)


@query(
    "w10_latest_per_key",
    f"""WITH {Q.LOG} SELECT card_id, max_by(txn_id, (ts, txn_id)) AS txn_id, max_by(Amount, (ts, txn_id)) AS Amount,
 max(ts) AS ts FROM log GROUP BY card_id""",
)
def _(spark, sf):
    from riskengine.operators.prep import latest_per_key

    return latest_per_key(A.log(spark, sf).select("card_id", "txn_id", "Amount", "ts"), ["card_id"], ["ts", "txn_id"])


# ---- metric documents ----

_EVAL_SQL = f"""WITH {Q.SCORED}"""


@query(
    "s10_evaluation_rows",
    f"""WITH {Q.SCORED}, {CURVE}, a AS (SELECT model_name, sum(pos * ((before_pos + pos) / (before_n + n) + CASE WHEN before_n > 0 THEN before_pos / before_n ELSE 1 END) / 2) / sum(pos) AS pr,
  sum((n - pos) * (before_pos + pos / 2)) / sum(pos) / sum(n - pos) AS roc FROM k GROUP BY model_name),
 cells AS (SELECT model_name,
  count(*) FILTER (p >= 0.5 AND label = 1) AS tp, count(*) FILTER (p >= 0.5 AND label = 0) AS fp,
  count(*) FILTER (p < 0.5 AND label = 1) AS fn, count(*) FILTER (p < 0.5 AND label = 0) AS tn FROM scored GROUP BY 1),
 m AS (SELECT model_name || '_baseline' AS model_name, unnest(['pr_auc', 'roc_auc', 'f1_score', 'recall', 'precision', 'fpr', 'fnr']) AS metric_type,
  unnest([round_even(pr, 4), round_even(roc, 4), round_even(2 * tp / (2 * tp + fp + fn), 4), round_even(tp / (tp + fn), 4), round_even(tp / (tp + fp), 4),
   round_even(fp / (fp + tn), 4), round_even(fn / (fn + tp), 4)]) AS metric_value,
  tp + fn AS fraud, tp + fp + fn + tn AS n FROM cells JOIN a USING (model_name))
 SELECT model_name, metric_type, metric_value, CAST(NULL AS DOUBLE) AS baseline_value, 0.0::DOUBLE AS deviation_percent,
  false AS is_warning, false AS is_critical,
  '{{"evaluation_type":"test_set","test_samples":' || n || ',"fraud_count":' || fraud || '}}' AS details FROM m""",
)
def _(spark, sf):
    return V.evaluation_rows(M.evaluate(A.scored(spark, sf)), "baseline")


_DOC_KEYS = {
    0: '{"pr_auc": 0.%s, "roc_auc": 0.9, "false_positive_rate": 0.02, "recall": 0.7, "precision": 0.6, "test_samples": 200, "fraud_caught": 20}',
    1: '{"average_precision": 0.%s, "fpr": 0.03, "threshold": 0.4, "fraud_rate": 0.25}',
    2: '{"cv_metrics": {"average_precision": {"mean": 0.%s}, "specificity": {"mean": 0.75}}, "train_samples": 300}',
}


def documents(spark, sf):
    digits = F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0")
    text = F.when(F.col("event_id") % 3 == 0, F.replace(F.lit(_DOC_KEYS[0]), F.lit("%s"), digits))
    text = text.when(F.col("event_id") % 3 == 1, F.replace(F.lit(_DOC_KEYS[1]), F.lit("%s"), digits))
    text = text.otherwise(F.replace(F.lit(_DOC_KEYS[2]), F.lit("%s"), digits))
    parsed = F.from_json(text, S.EVALUATION_DOC)
    return A.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("model_name"), parsed.alias("d")
    ).select("model_name", "d.*")


@query(
    "s5_metric_documents",
    """SELECT CAST(event_id AS VARCHAR) AS model_name, (event_id % 10000) / 10000 AS pr_auc,
 CASE event_id % 3 WHEN 0 THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS roc_auc,
 CASE event_id % 3 WHEN 0 THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END AS recall,
 CASE event_id % 3 WHEN 0 THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END AS precision,
 CASE event_id % 3 WHEN 0 THEN 0.02::DOUBLE WHEN 1 THEN 0.03::DOUBLE ELSE 0.25::DOUBLE END AS false_positive_rate,
 CASE event_id % 3 WHEN 1 THEN 0.4::DOUBLE ELSE 0.5::DOUBLE END AS threshold,
 CASE event_id % 3 WHEN 0 THEN 200 WHEN 1 THEN 0 ELSE 300 END::BIGINT AS test_samples,
 CASE event_id % 3 WHEN 0 THEN 0.1::DOUBLE WHEN 1 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS fraud_ratio,
 0.0::DOUBLE AS inference_ms FROM events""",
)
def _(spark, sf):
    return readers.parse_metrics(documents(spark, sf))


def _artifacts(spark, sf):
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    k = F.col("o_orderkey")
    tier = F.when(k % 2 == 0, "_baseline").otherwise("_advanced")
    stem = F.concat(F.when(k % 50 == 0, "Scaler").otherwise("model"), k, tier)
    models = o.select(F.concat(F.lit("models/"), stem, F.lit(".pkl")).alias("path"), stem.alias("stem"))

    def doc(suffix, cond):
        s = F.concat(stem, F.lit(suffix))
        return o.where(cond).select(F.concat(F.lit("models/"), s, F.lit(".json")).alias("path"), s.alias("stem"))

    docs = doc("_eval", k % 3 == 0).unionByName(doc("_metrics", k % 4 == 0)).unionByName(doc("_evaluation", k % 5 == 0))
    return models, docs


@query(
    "j6_artifact_pairing",
    """WITH m AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'Scaler' ELSE 'model' END || o_orderkey ||
  CASE WHEN o_orderkey % 2 = 0 THEN '_baseline' ELSE '_advanced' END AS s, o_orderkey AS k FROM orders)
 SELECT s AS model_name, 'models/' || s || '.pkl' AS path, 'models/' || s || CASE WHEN k % 5 = 0 THEN '_evaluation' WHEN k % 4 = 0
  THEN '_metrics' ELSE '_eval' END || '.json' AS metrics_path, CASE WHEN k % 2 = 0 THEN 'baseline' ELSE 'advanced' END AS tier
 FROM m WHERE k % 50 <> 0 AND (k % 3 = 0 OR k % 4 = 0 OR k % 5 = 0)""",
)
def _(spark, sf):
    return V.pair_artifacts(*_artifacts(spark, sf))


@query(
    "j7_metrics_outer_merge",
    """SELECT CAST(o_orderkey AS VARCHAR) AS model_name, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS cv_pr_auc,
 CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS test_pr_auc, CASE WHEN o_orderkey % 3 <> 0 THEN 'cv' ELSE 'test' END AS source
 FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
)
def _(spark, sf):
    o = A.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderkey").cast("string").alias("model_name"),
        F.col("o_totalprice").alias("pr_auc"),
    )
    return V.merge_metrics(o.where("k % 3 <> 0"), o.where("k % 2 = 0"))


# ---- baseline against current ----

_HALVES = f"""WITH {Q.SCORED}, part AS (SELECT model_name, p, label, ts >= TIMESTAMP '2024-01-16' AS late FROM scored), {Q.areas('part', 'model_name, late', 'c')},
 r AS (SELECT b.model_name, b.pr_auc AS baseline_pr_auc, n.pr_auc AS current_pr_auc, b.fp / (b.fp + b.tn) AS baseline_fpr, n.fp / (n.fp + n.tn) AS current_fpr,
  n.fp / (n.fp + n.tn) / (b.fp / (b.fp + b.tn)) - 1 AS f, 1 - n.pr_auc / b.pr_auc AS p FROM c b JOIN c n USING (model_name) WHERE NOT b.late AND n.late)"""


def halves(spark, sf):
    """PR area and false positive rate of two periods of the score log."""
    s = A.scored(spark, sf)
    split = F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")

    def figures(rows):
        return M.evaluate(rows, digits=None).select("model_name", "pr_auc", "false_positive_rate")

    return figures(s.where(F.col("ts") < split)), figures(s.where(F.col("ts") >= split))


_DRIFT_COLS = ["baseline_pr_auc", "current_pr_auc", "baseline_fpr", "current_fpr"]


@query(
    "a26_drift_decision",
    f"""{_HALVES} SELECT model_name, round(baseline_pr_auc, 6) AS baseline_pr_auc, round(current_pr_auc, 6) AS current_pr_auc,
 round(baseline_fpr, 6) AS baseline_fpr, round(current_fpr, 6) AS current_fpr, round(f, 6) AS fpr_relative_change,
 round(p, 6) AS pr_auc_relative_change, f > 0.01 AS fpr_warning, p > 0.001 AS pr_auc_warning, f > 0.01 OR p > 0.001 AS any_warning,
 0.01::DOUBLE AS fpr_limit, 0.001::DOUBLE AS pr_auc_limit FROM r""",
)
def _(spark, sf):
    return rounded(M.drift(*halves(spark, sf), fpr_limit=0.01, pr_auc_limit=0.001), _DRIFT_COLS)


@query(
    "j8_baseline_current",
    f"""{_HALVES} SELECT model_name, round(baseline_fpr, 6) AS baseline_fpr, round(current_fpr, 6) AS current_fpr FROM r""",
)
def _(spark, sf):
    out = M.drift(*halves(spark, sf)).select("model_name", "baseline_fpr", "current_fpr")
    return rounded(out, ["baseline_fpr", "current_fpr"])


@query(
    "s11_drift_rows",
    f"""{_HALVES}, x AS (SELECT model_name, f > 0.2 AS fw, p > 0.1 AS pw, * EXCLUDE (model_name) FROM r)
 SELECT model_name, fw OR pw AS is_warning, false AS is_critical, '{{}}' AS details, 'pr_auc' AS metric_type, round(current_pr_auc, 6) AS metric_value,
  round(baseline_pr_auc, 6) AS baseline_value, round(round(p, 6) * 100, 4) AS deviation_percent, pw AS metric_warning FROM x UNION ALL
 SELECT model_name, fw OR pw, false, '{{}}', 'fpr', round(current_fpr, 6), round(baseline_fpr, 6), round(round(f, 6) * 100, 4), fw FROM x""",
)
def _(spark, sf):
    rows = V.drift_rows(M.drift(*halves(spark, sf)))
    return rounded(rows, ["metric_value", "baseline_value"]).withColumn("deviation_percent", F.round("deviation_percent", 4))


@query(
    "u3_union_of_rows",
    f"""WITH {Q.LOG} SELECT issue, count(*) AS rows FROM (SELECT 'zero' AS issue FROM log WHERE Amount < 1 UNION ALL
 SELECT 'fraud' FROM log WHERE Class = 1 UNION ALL SELECT 'large' FROM log WHERE Amount > 100) GROUP BY 1""",
)
def _(spark, sf):
    rows = A.log(spark, sf)
    parts = [("zero", F.col("Amount") < 1), ("fraud", F.col("Class") == 1), ("large", F.col("Amount") > 100)]
    found = [rows.where(c).select(F.lit(n).alias("issue")) for n, c in parts]
    return found[0].unionByName(found[1]).unionByName(found[2]).groupBy("issue").agg(F.count(F.lit(1)).alias("rows"))
