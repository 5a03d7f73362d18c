"""Queries on what happens after deployment: keyed stream state, point-in-time features, stability, slices, time folds, alarms, promotion."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskengine.catalog import sql as Q
from riskengine.catalog.models import INPUTS, training_rows
from riskengine.catalog.registry import query
from riskengine.catalog.streams import event_stream
from riskengine.catalog.tables import DAILY, audit, rounded
from riskengine.functions import features as X
from riskengine.operators import alarms, anomaly, asof, prep, profiling, slices, stability, timefolds
from riskengine.operators import metrics as M
from riskengine.operators import models as L
from riskengine.operators import views as W
from riskengine.plans import runs
from riskengine.schema import V_COLS
from riskengine.sources import adapter as A
from riskengine.streaming import events as E
from riskengine.streaming import velocity as T
from riskengine.streaming.keyed import keyed_velocity

DAY = 86400
WIDTHS = {"w10m": 600, "w1h": 3600, "w24h": DAY}

# ---- keyed stream state ----

FILES = 3
#: seconds by which an event may arrive late, below the watermark's delay of ten minutes
LATE = 540


def replay_out_of_order(spark, sf, cuts=(8, 15, 23), stop_after=2):
    """The log in parts by a jittered time of arrival, one part per micro-batch; the query is stopped after some parts and
    started again on its checkpoint."""
    source, out, ckpt = T.scratch_paths(spark, "source", "out", "ckpt")
    rows = A.log(spark, sf).select("txn_id", "card_id", F.col("ts").cast("timestamp").alias("ts"), "Amount", "time_s")
    arrival = F.col("time_s") + F.pmod(F.xxhash64("txn_id"), F.lit(LATE))
    edges = [-1, *[c * DAY for c in cuts], 1 << 40]
    for part, (low, high) in enumerate(zip(edges, edges[1:], strict=False), 1):
        some = rows.where((arrival >= low) & (arrival < high)).drop("time_s")
        some.repartition(FILES).write.mode("append").parquet(source)
        if part in (stop_after, len(edges) - 1):
            stream = E.file_events(spark, source, some.schema, files_per_batch=FILES)
            E.run_available(keyed_velocity(stream, WIDTHS), ckpt, path=out)
    return spark.read.parquet(out)


_KEYED = ", ".join(Q.trailing("log", width, tag, by="card_id") for tag, width in WIDTHS.items())
_KEYED_COLS = ", ".join(
    f"CAST(count_{t} AS BIGINT) AS count_{t}, round(round(avg_{t}, 9), 6) AS avg_{t}, round(round(std_{t}, 9), 6) AS std_{t}" for t in WIDTHS
)


@query(
    "r5_keyed_velocity",
    f"""WITH {Q.LOG}, {_KEYED}, closed AS (SELECT (epoch_ms(max(ts)) - 1704067200000 - 600000) // 1000 AS s FROM log),
 p AS (SELECT txn_id, time_s, coalesce(time_s - lag(time_s) OVER (PARTITION BY card_id ORDER BY time_s, txn_id), 0) AS time_since_last_txn FROM log)
 SELECT txn_id, time_since_last_txn, {_KEYED_COLS} FROM p JOIN w10m USING (txn_id) JOIN w1h USING (txn_id) JOIN w24h USING (txn_id) WHERE time_s < (SELECT s FROM closed)""",
)
def _(spark, sf):
    out = replay_out_of_order(spark, sf)
    shares = [f"{m}_{t}" for t in WIDTHS for m in ("avg", "std")]
    return out.select("txn_id", "time_since_last_txn", *[f"count_{t}" for t in WIDTHS], *[F.round(F.round(c, 9), 6).alias(c) for c in shares])


# ---- point-in-time features ----

_SNAPSHOTS = """f AS (SELECT card_id, (time_s // 86400 + 1) * 86400 AS known_s, count(*) AS txn_count_day, round(avg(Amount), 6) AS avg_amount_day FROM log GROUP BY 1, 2)"""


def card_snapshots(rows):
    """Per card and day what is known when the day is over."""
    return rows.groupBy("card_id", ((F.floor(F.col("time_s") / DAY) + 1) * DAY).cast("long").alias("known_s")).agg(
        F.count(F.lit(1)).alias("txn_count_day"), F.round(F.avg("Amount"), 6).alias("avg_amount_day")
    )


@query(
    "x6_point_in_time_join",
    f"""WITH {Q.LOG}, {_SNAPSHOTS} SELECT e.txn_id, f.known_s, f.txn_count_day, f.avg_amount_day FROM log e
 ASOF LEFT JOIN f ON e.card_id = f.card_id AND e.time_s >= f.known_s""",
)
def _(spark, sf):
    rows = A.log(spark, sf).select("txn_id", "card_id", "time_s", "Amount")
    found = asof.asof_join(rows, card_snapshots(rows), ["card_id"], "time_s", "known_s", ["txn_count_day", "avg_amount_day"])
    return found.drop("card_id", "time_s", "Amount")


# ---- stability ----

STABLE_COLS = ["Time", *V_COLS, "Amount"]
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, ref, {'CAST(time_s AS DOUBLE)' if c == 'Time' else c} AS value FROM sided" for c in STABLE_COLS)


@query(
    "x3_feature_stability",
    f"""WITH {Q.TXN}, edge AS (SELECT min(time_s) + 0.8 * (max(time_s) - min(time_s)) AS edge_s FROM txn), sided AS MATERIALIZED (SELECT *, time_s <= edge_s AS ref FROM txn, edge),
 u AS ({_LONG}), e AS (SELECT feature, quantile_cont(value, [{', '.join(f'{k / 10}' for k in range(1, 10))}]) FILTER (ref) AS edges, count(*) FILTER (ref) AS n_reference,
  count(*) FILTER (NOT ref) AS n_current FROM u GROUP BY feature),
 b AS (SELECT feature, len(list_filter(edges, lambda x: round(x, 9) < round(value, 9))) AS bin, count(*) FILTER (ref) / any_value(n_reference) AS r, count(*) FILTER (NOT ref) / any_value(n_current) AS c
  FROM u JOIN e USING (feature) GROUP BY 1, 2),
 i AS (SELECT feature, sum((greatest(c, 1e-4) - greatest(r, 1e-4)) * ln(greatest(c, 1e-4) / greatest(r, 1e-4))) AS psi FROM b GROUP BY feature),
 v AS (SELECT feature, value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM u GROUP BY ALL),
 d AS (SELECT feature, abs(sum(r) OVER w / n_reference - sum(c) OVER w / n_current) AS gap FROM v JOIN e USING (feature) WINDOW w AS (PARTITION BY feature ORDER BY value)),
 k AS (SELECT feature, max(gap) AS ks FROM d GROUP BY feature)
 SELECT feature, n_reference, n_current, round(psi, 6) AS psi, round(ks, 6) AS ks, psi > 0.2 AS moved FROM e JOIN i USING (feature) JOIN k USING (feature)""",
)
def _(spark, sf):
    rows = A.txn(spark, sf).withColumn("Time", F.col("time_s").cast("double"))
    reference, current, _at = prep.chronological_split(rows)
    return rounded(stability.stability(reference, current, STABLE_COLS), ["psi", "ks"])


# ---- time folds ----

_FEEDBACK_S = """r AS (SELECT CAST(transaction_id AS BIGINT) AS txn_id, (epoch_us(reported_at) - 1704067200000000) // 1000000 AS reported_s, feedback_id, true_label FROM feedback_log)"""
_FOLDS = f"""{Q.AUDIT}, {_FEEDBACK_S}, t AS (SELECT min(time_s) AS lo, max(time_s) AS hi FROM log), g AS (SELECT hi, lo + CAST(floor((hi - lo) * 0.5) AS BIGINT) AS b FROM t),
 p AS (SELECT fold, b + (hi - b) * fold // 3 - 3600 AS train_end, b + (hi - b) * fold // 3 AS test_start, CASE WHEN fold = 2 THEN hi + 1 ELSE b + (hi - b) * (fold + 1) // 3 END AS test_end
  FROM g, (SELECT unnest([0, 1, 2]) AS fold)),
 k AS (SELECT fold, txn_id, max_by(true_label, (reported_s, feedback_id)) AS y FROM r JOIN p ON reported_s <= test_start GROUP BY fold, txn_id),
 z AS (SELECT txn_id, max_by(true_label, (reported_s, feedback_id)) AS y FROM r GROUP BY txn_id),
 a AS (SELECT p.fold, count(*) AS train_rows, count(*) FILTER (y = 1) AS train_positives FROM log JOIN p ON time_s < train_end JOIN k ON k.fold = p.fold AND k.txn_id = log.txn_id GROUP BY p.fold),
 s AS (SELECT p.fold, count(*) AS test_rows, count(*) FILTER (y = 1) AS test_positives FROM log JOIN p ON time_s >= test_start AND time_s < test_end JOIN z ON z.txn_id = log.txn_id GROUP BY p.fold)"""


def time_folds(spark, sf, rows):
    reports = A.feedback_log(spark, sf).select(
        F.col("transaction_id").cast("long").alias("txn_id"),
        (F.unix_seconds(F.col("reported_at").cast("timestamp")) - F.lit(A.EPOCH_US // 1_000_000)).alias("reported_s"),
        F.col("feedback_id").alias("report_id"),
        F.col("true_label").alias("label"),
    )
    plan = timefolds.plan_folds(rows)
    return plan, timefolds.assign_folds(rows, plan, reports)


@query(
    "x5_time_folds",
    f"""WITH {_FOLDS} SELECT CAST(p.fold AS INTEGER) AS fold, train_end, test_start, test_end, train_rows, train_positives, test_rows, test_positives FROM p JOIN a USING (fold) JOIN s USING (fold)""",
)
def _(spark, sf):
    plan, assigned = time_folds(spark, sf, A.log(spark, sf).select("txn_id", "time_s"))
    return timefolds.fold_table(plan, assigned)


BACKTESTED = ["logistic_regression", "decision_tree"]


@query(
    "x5_time_fold_metrics",
    f"""WITH {_FOLDS} SELECT CAST(p.fold AS INTEGER) AS fold, model_name, test_rows AS samples, test_positives AS positives, true AS are_shares FROM p JOIN s USING (fold), (SELECT unnest({BACKTESTED}) AS model_name)""",
)
def _(spark, sf):
    rows = A.txn(spark, sf).transform(X.stateless).select("txn_id", "time_s", *INPUTS)
    plan, assigned = time_folds(spark, sf, rows)
    assigned = runs.materialise(assigned, "time-folds")

    def evaluate(_fold, train, test):
        out = None
        for name in BACKTESTED:
            # the areas read the scores several times
            scored = runs.materialise(L.score(L.fit(name, train, INPUTS, label="label"), test, name, label="label"), "fold-scores")
            found = M.ranking_metrics(scored, digits=None)
            out = found if out is None else out.unionByName(found)
        return out

    areas = [F.col(c).between(0, 1) for c in ("pr_auc", "average_precision", "roc_auc")]
    out = timefolds.backtest(assigned, plan, evaluate)
    return out.select("fold", "model_name", "samples", "positives", (areas[0] & areas[1] & areas[2]).alias("are_shares"))


# ---- slices ----

_BAND = "CASE WHEN Amount >= 500 THEN '500+' WHEN Amount >= 100 THEN '100-500' WHEN Amount >= 22 THEN '22-100' WHEN Amount >= 0 THEN '0-22' END"
_SLICED = f"""{Q.SCORED}, sliced AS (SELECT model_name, p, label, 'all' AS slice_set, 'all' AS slice FROM scored UNION ALL SELECT model_name, p, label, 'amount_band', {_BAND} FROM scored
 UNION ALL SELECT model_name, p, label, 'hour', strftime(ts, '%H') FROM scored UNION ALL SELECT model_name, p, label, 'day', strftime(ts, '%Y-%m-%d') FROM scored)"""
_RATE = {
    "precision": ("tp", "tp + fp"),
    "recall": ("tp", "tp + fn"),
    "f1_score": ("2 * tp", "2 * tp + fp + fn"),
    "specificity": ("tn", "tn + fp"),
    "false_positive_rate": ("fp", "fp + tn"),
    "false_negative_rate": ("fn", "fn + tp"),
}
_RATES = ", ".join(f"round(CASE WHEN {d} > 0 THEN ({n}) / ({d}) ELSE 0 END, 6) AS {c}" for c, (n, d) in _RATE.items())


@query(
    "x2_slice_evaluation",
    f"""WITH {_SLICED}, {Q.areas('sliced', 'model_name, slice_set, slice', 'f')} SELECT model_name, slice_set, slice, samples, positives, round(pr_auc, 6) AS pr_auc, round(average_precision, 6) AS average_precision,
 round(roc_auc, 6) AS roc_auc, tn, fp, fn, tp, {_RATES} FROM f""",
)
def _(spark, sf):
    out = slices.evaluate_slices(slices.with_slices(A.scored(spark, sf)))
    return rounded(out, ["pr_auc", "average_precision", "roc_auc", *_RATE])


# ---- alarms ----

FPR_LIMIT = 0.28


@query(
    "x7_limit_runs",
    f"""WITH {Q.AUDIT}, {DAILY}, o AS (SELECT model_name, transaction_date AS d, false_positive_rate AS v, transaction_date - CAST(row_number() OVER (PARTITION BY model_name ORDER BY transaction_date) AS INTEGER) AS run
  FROM daily WHERE false_positive_rate > {FPR_LIMIT})
 SELECT model_name, min(d) AS first_day, max(d) AS last_day, count(*) AS days, round(max(v), 6) AS worst, count(*) >= 3 AS alarm FROM o GROUP BY model_name, run""",
)
def _(spark, sf):
    return rounded(alarms.limit_runs(W.daily_performance(*audit(spark, sf)), FPR_LIMIT), ["worst"])


_PROBS = (0.50, 0.95, 0.99)
_RANGES = {"all": ("2000-01-01", "2100-01-01"), "mid_january": ("2024-01-10", "2024-01-20")}


@query(
    "x8_latency_percentiles",
    f"""WITH {Q.AUDIT}, g AS ({' UNION ALL '.join(f"SELECT '{n}' AS range, DATE '{a}' AS a, DATE '{b}' AS b" for n, (a, b) in _RANGES.items())})
 SELECT range, model_name, count(*) AS n, {', '.join(f'true AS p{round(100 * p)}_in_bound' for p in _PROBS)} FROM predictions JOIN g ON CAST(created_at AS DATE) BETWEEN a AND b GROUP BY 1, 2""",
)
def _(spark, sf):
    """Sketches are stored per day and merged for each range; the true ranks of the estimates are counted on all rows."""
    rows = A.predictions(spark, sf).select("model_name", "inference_time_ms", "created_at")
    stored = runs.materialise(alarms.daily_sketches(rows, "inference_time_ms", "created_at"), "latency")
    out = None
    for name, (first, last) in _RANGES.items():
        found = alarms.merged_percentiles(stored.where(F.col("day").between(first, last)))
        # one row per model
        judged = rows.where(F.to_date("created_at").between(first, last)).join(F.broadcast(found), "model_name")
        marks = []
        for p in _PROBS:
            c = f"p{round(100 * p)}"
            below, upto = (F.avg((op).cast("int")) for op in (F.col("inference_time_ms") < F.col(c), F.col("inference_time_ms") <= F.col(c)))
            marks.append(((below <= p + alarms.RANK_ERROR) & (upto >= p - alarms.RANK_ERROR)).alias(f"{c}_in_bound"))
        one = judged.groupBy("model_name").agg(F.max("n").alias("n"), *marks).withColumn("range", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


# ---- promotion ----

_GATED = f"""{Q.SCORED}, part AS (SELECT model_name, p, label, ts >= TIMESTAMP '2024-01-16' AS late FROM scored), {Q.areas('part', 'model_name, late', 'f')}"""


@query(
    "x4_promotion_gate",
    f"""WITH {_GATED}, c AS (SELECT n.model_name, o.pr_auc AS champion_pr_auc, n.pr_auc AS challenger_pr_auc, n.fp / (n.fp + n.tn) AS challenger_fpr, n.pr_auc / o.pr_auc - 1 AS gain
  FROM f o JOIN f n USING (model_name) WHERE NOT o.late AND n.late),
 w AS (SELECT *, CASE WHEN challenger_fpr > 0.4 THEN 'false_positive_rate' WHEN gain < -0.05 THEN 'pr_auc_loss' WHEN gain >= 0.02 THEN 'pr_auc_gain' ELSE 'small_gain' END AS reason FROM c)
 SELECT model_name, round(champion_pr_auc, 6) AS champion_pr_auc, round(challenger_pr_auc, 6) AS challenger_pr_auc, round(challenger_fpr, 6) AS challenger_fpr, round(gain, 6) AS gain, reason,
  CASE WHEN reason IN ('false_positive_rate', 'pr_auc_loss') THEN 'blocked' WHEN reason = 'pr_auc_gain' THEN 'promoted' ELSE 'held' END AS verdict FROM w""",
)
def _(spark, sf):
    """The first half of the log plays the champion's period, the second the challenger's. The rate limit suits the synthetic scores."""
    rows = A.scored(spark, sf)
    split = F.expr("TIMESTAMP_NTZ'2024-01-16 00:00:00'")
    sides = [M.evaluate(rows.where(c), digits=None) for c in (F.col("ts") < split, F.col("ts") >= split)]
    return rounded(alarms.promotion_gate(*sides, most_fpr=0.4), ["champion_pr_auc", "challenger_pr_auc", "challenger_fpr", "gain"])


# ---- what holds of any engine's result, for operators whose values no SQL gives ----


@query("p19_sample_facts", f"WITH {Q.LOG} SELECT least(5000, count(*)) AS rows, least(5000, count(*)) AS keys, least(5000, count(*)) AS rows_of_the_log, true AS same_again FROM log")
def _(spark, sf):
    rows = A.log(spark, sf).select("txn_id", "Amount", "time_s")
    first, again = prep.hash_sample(rows, 5000), prep.hash_sample(rows.repartition(7), 5000)
    known = first.join(rows, ["txn_id", "Amount", "time_s"], "left_semi").agg(F.count(F.lit(1)).alias("rows_of_the_log"))
    same = first.join(again, "txn_id", "left_anti").agg((F.count(F.lit(1)) == 0).alias("same_again"))
    # one row each
    return first.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("txn_id").alias("keys")).crossJoin(known).crossJoin(same)


_N = f"WITH {Q.LOG} SELECT count(*) AS rows, count(DISTINCT txn_id) AS keys"


@query("a17_component_facts", f"{_N}, true AS are_centred, true AS first_is_wider, true AS are_uncorrelated, true AS share_agrees FROM log")
def _(spark, sf):
    """Two components are centred, ordered by variance and uncorrelated, and their variances are the share they are said to explain."""
    projected, ratios = profiling.two_components(A.txn(spark, sf), V_COLS, ["txn_id", "Class"])
    xy = vector_to_array("pc")
    x, y = xy[0], xy[1]
    rows = projected.select("txn_id", x.alias("x"), y.alias("y"))
    wide = (F.var_samp("x") + F.var_samp("y")) / len(V_COLS)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("txn_id").alias("keys"),
        ((F.abs(F.avg("x")) < 1e-6) & (F.abs(F.avg("y")) < 1e-6)).alias("are_centred"),
        (F.var_samp("x") >= F.var_samp("y")).alias("first_is_wider"),
        (F.abs(F.corr("x", "y")) < 1e-6).alias("are_uncorrelated"),
        (F.abs(wide - sum(ratios)) < 1e-6).alias("share_agrees"),
    )


@query("m16_reconstruction_facts", f"{_N}, true AS is_no_length, true AS more_components_err_less, true AS all_components_err_nothing FROM log")
def _(spark, sf):
    """Errors are not negative, fall row by row with more components, and vanish with all of them."""
    rows = A.txn(spark, sf).select("txn_id", *V_COLS)
    out = rows
    for k in (4, 16, len(V_COLS)):
        out = anomaly.reconstruction_error(out, anomaly.fit_reconstruction(rows, k=k), f"error_{k}")
    return out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("txn_id").alias("keys"),
        (F.min("error_16") >= 0).alias("is_no_length"),
        F.min(F.col("error_16") <= F.col("error_4") + 1e-9).alias("more_components_err_less"),
        (F.max(f"error_{len(V_COLS)}") < 1e-9).alias("all_components_err_nothing"),
    )


@query("m17_embedding_facts", f"{_N}, 16 AS columns, true AS widths_fall FROM log")
def _(spark, sf):
    rows = A.txn(spark, sf).select("txn_id", *V_COLS)
    out = anomaly.reconstruction_error(rows, anomaly.fit_reconstruction(rows), keep_embedding=True)
    widths = F.array(*[F.var_samp(F.col("embedding")[i]) for i in range(16)])
    return out.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("txn_id").alias("keys"), F.max(F.size("embedding")).alias("columns"), (F.sort_array(widths, asc=False) == widths).alias("widths_fall")
    )


@query("r3_stream_scoring_facts", f"{_N}, round(sum(Amount), 4) AS amount, true AS are_probabilities, true AS decided_by_threshold FROM log")
def _(spark, sf):
    train, _test = training_rows(spark, sf)
    model = L.fit("decision_tree", train, INPUTS)
    out, ckpt = T.scratch_paths(spark, "scored", "ckpt")
    stream = E.score_requests(A.with_components(event_stream(spark, sf), spark, sf), model)
    E.run_available(stream.select("txn_id", "Amount", "fraud_probability", "is_fraud"), ckpt, path=out)
    p = F.col("fraud_probability")
    return spark.read.parquet(out).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("txn_id").alias("keys"),
        F.round(F.sum("Amount"), 4).alias("amount"),
        F.min((p >= 0) & (p <= 1)).alias("are_probabilities"),
        F.min(F.col("is_fraud") == (p >= 0.5)).alias("decided_by_threshold"),
    )
