"""Streaming queries (R1-R9): the log is replayed through Structured Streaming until all
input is used up, and what the sink received is returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskengine.catalog import sql as Q
from riskengine.catalog.models import INPUTS, training_rows
from riskengine.catalog.registry import query
from riskengine.operators import models as L
from riskengine.sources import adapter as A
from riskengine.streaming import events as E
from riskengine.streaming import velocity as T


def event_stream(spark, sf):
    batch = A.table(spark, sf, "events")
    raw = E.file_events(spark, sf, batch.schema, glob="events.parquet")
    rows = A.with_event_columns(raw)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def replay(stream, spark, mode="append"):
    out, ckpt = T.scratch_paths(spark, "out", "ckpt")
    E.run_available(stream, ckpt, path=out, mode=mode)
    return spark.read.schema(stream.schema).parquet(out)


def plain_time(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("r1_event_source", f"WITH {Q.LOG} SELECT txn_id, card_id, time_s, Amount, Class FROM log")
def _(spark, sf):
    return replay(event_stream(spark, sf).select("txn_id", "card_id", "time_s", "Amount", "Class"), spark)


@query(
    "r2_dead_letter_route",
    f"""WITH {Q.DIRTY}, r AS (SELECT txn_id, CASE WHEN NOT isnan(Amount) THEN Amount END AS a FROM dirty)
 SELECT coalesce(CASE WHEN a > 30000 THEN '422:amount_exceeds_maximum' WHEN a IS NULL THEN '422:amount_missing_or_not_numeric'
 WHEN a < 0 THEN '422:amount_negative' END, 'scored') AS route, count(*) AS rows, round(sum(a), 4) AS amount FROM r GROUP BY 1""",
)
def _(spark, sf):
    source, good, dead, ckpt = T.scratch_paths(spark, "requests", "good", "dead", "ckpt")
    A.dirty(spark, sf).select(
        F.to_json(F.struct(F.col("time_s").cast("double").alias("Time"), "Amount", "V1", "V2")).alias("value")
    ).write.text(source)
    lines = E.file_events(spark, source, spark.read.text(source).schema, fmt="text")
    E.run_available(E.parse_requests(lines), ckpt, writer=E.route(good, dead))
    fine = spark.read.parquet(good).select(F.lit("scored").alias("route"), "Amount")
    faulty = spark.read.parquet(dead).select(F.col("error").alias("route"), "Amount")
    return fine.unionByName(faulty).groupBy("route").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("Amount"), 4).alias("amount")
    )


@query("r3_stream_scoring")
def _(spark, sf):
    train, _test = training_rows(spark, sf)
    model = L.fit("decision_tree", train, INPUTS)
    rows = A.with_components(event_stream(spark, sf), spark, sf)
    scored = E.score_requests(rows, model).select("txn_id", "Amount", "fraud_probability", "is_fraud")
    return replay(scored, spark)


@query("r4_idempotent_ingest", f"WITH {Q.LOG} SELECT card_id, count(*) AS requests FROM log GROUP BY card_id")
def _(spark, sf):
    rows = event_stream(spark, sf).withColumn("transaction_hash", F.sha2(F.col("txn_id").cast("string"), 256))
    twice = rows.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    unique = replay(E.once_per_hash(twice).select("card_id", "transaction_hash"), spark)
    return unique.groupBy("card_id").agg(F.count(F.lit(1)).alias("requests"))


@query(
    "r5_sliding_velocity",
    f"""WITH {Q.LOG}, w AS (SELECT card_id, Amount, unnest([time_bucket(INTERVAL 6 HOURS, ts) - k * INTERVAL 6 HOURS FOR k IN [0, 1, 2, 3]]) AS window_start FROM log)
 SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, card_id, count(*) AS txn_count, round(avg(Amount), 6) AS avg_amount FROM w
 WHERE window_start + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTES FROM log) GROUP BY ALL""",
)
def _(spark, sf):
    out = replay(T.sliding_velocity(event_stream(spark, sf), "24 hours", "6 hours"), spark)
    return plain_time(out, "window_start", "window_end").withColumn("avg_amount", F.round("avg_amount", 6))


_CARD = f"""WITH {Q.LOG}, {Q.trailing('log', 3600, 'w1h', by='card_id')}, {Q.trailing('log', 86400, 'w24h', by='card_id')}"""


FILES = 4


def replay_exact(spark, sf, cuts=(8, 15, 23), shift=0):
    """The log in four parts in time order, one per micro-batch. ``shift``: days added to the times after
    the second cut."""
    source, out, cells, ckpt = T.scratch_paths(spark, "source", "out", "cells", "ckpt")
    rows = A.log(spark, sf).select("txn_id", "card_id", "time_s", "Amount")
    later = F.col("time_s") >= cuts[1] * 86400
    rows = rows.withColumn("time_s", F.col("time_s") + F.when(later, shift * 86400).otherwise(0))
    cuts = [c + (shift if c > cuts[1] else 0) for c in cuts]
    edges = [0, *[c * 86400 for c in cuts], 1 << 40]
    for low, high in zip(edges, edges[1:]):
        # a few files of equal size per quarter; files are taken by age
        rows.where((F.col("time_s") >= low) & (F.col("time_s") < high)).repartition(FILES).write.mode("append").parquet(source)
    stream = E.file_events(spark, source, rows.schema, files_per_batch=FILES)
    E.run_available(stream, ckpt, writer=T.exact_velocity(out, cells, {"w1h": 3600, "w24h": 86400}))
    return spark.read.parquet(out)


@query(
    "r5_exact_velocity",
    f"""{_CARD} SELECT txn_id, CAST(count_w1h AS BIGINT) AS count_w1h, round(round(avg_w1h, 9), 6) AS avg_w1h, CAST(count_w24h AS BIGINT) AS count_w24h,
 round(round(avg_w24h, 9), 6) AS avg_w24h, round(std_w24h, 6) AS std_w24h FROM w1h JOIN w24h USING (txn_id)""",
)
def _(spark, sf):
    out = replay_exact(spark, sf)
    return out.select(
        "txn_id",
        "count_w1h",
        F.round(F.round("avg_w1h", 9), 6).alias("avg_w1h"),
        "count_w24h",
        F.round(F.round("avg_w24h", 9), 6).alias("avg_w24h"),
        F.round("std_w24h", 6).alias("std_w24h"),
    )


@query(
    "r6_recency_per_card",
    f"""WITH {Q.LOG} SELECT txn_id, coalesce(time_s - lag(time_s) OVER (PARTITION BY card_id ORDER BY time_s, txn_id), 0) AS time_since_last_txn FROM log""",
)
def _(spark, sf):
    return replay_exact(spark, sf).select("txn_id", "time_since_last_txn")


@query(
    "r6_recency_after_a_gap",
    f"""WITH {Q.LOG}, s AS (SELECT card_id, txn_id, time_s + CASE WHEN time_s >= 15 * 86400 THEN 50 * 86400 ELSE 0 END AS time_s FROM log)
 SELECT txn_id, coalesce(time_s - lag(time_s) OVER (PARTITION BY card_id ORDER BY time_s, txn_id), 0) AS time_since_last_txn FROM s""",
)
def _(spark, sf):
    """Cards that were last seen fifty days ago."""
    return replay_exact(spark, sf, shift=50).select("txn_id", "time_since_last_txn")


@query(
    "r7_audit_sinks",
    f"""WITH {Q.LOG} SELECT CAST(txn_id AS VARCHAR) AS transaction_id, CAST(time_s AS DOUBLE) AS time_seconds, Amount AS amount, 'decision_tree' AS model_name FROM log""",
)
def _(spark, sf):
    train, _test = training_rows(spark, sf)
    model = L.fit("decision_tree", train, INPUTS)
    tx, pred, log, ckpt = T.scratch_paths(spark, "transactions", "predictions", "log", "ckpt")
    rows = A.with_components(event_stream(spark, sf), spark, sf)
    E.run_available(E.score_requests(rows, model), ckpt, writer=E.audit(tx, pred, log, "decision_tree"))
    p = spark.read.parquet(pred).select("transaction_id", "model_name")
    return spark.read.parquet(tx).select("transaction_id", "time_seconds", "amount").join(p, "transaction_id")


def scored_stream(spark, sf):
    rows = event_stream(spark, sf)
    num = (F.col("txn_id") * 7919) % 10007 + 4000 * F.col("Class")
    return rows.select(
        "txn_id",
        "ts",
        F.col("Amount").alias("amount"),
        F.lit("model_a").alias("model_name"),
        (num / F.lit(14007)).alias("fraud_probability"),
        (num / F.lit(14007) >= 0.5).alias("is_fraud"),
        F.when(F.col("txn_id") % 5 != 0, F.col("Class")).alias("true_label"),
        ((F.col("txn_id") % 97) / F.lit(10)).alias("inference_time_ms"),
    )


@query(
    "r8_daily_performance_stream",
    f"""WITH {Q.SCORED}, s AS (SELECT *, p >= 0.5 AS flag, CASE WHEN txn_id % 5 <> 0 THEN label END AS y FROM scored WHERE model_name = 'model_a')
 SELECT CAST(ts AS DATE) AS transaction_date, model_name, count(*) AS total_transactions, count(*) FILTER (flag) AS flagged_as_fraud,
 count(*) FILTER (y = 1) AS actual_fraud_count, count(*) FILTER (flag AND y = 1) AS true_positives, count(*) FILTER (flag AND y = 0) AS false_positives,
 count(*) FILTER (NOT flag AND y = 1) AS false_negatives, count(*) FILTER (NOT flag AND y = 0) AS true_negatives,
 round(round(CASE WHEN count(*) FILTER (y = 1) > 0 THEN count(*) FILTER (flag AND y = 1) / count(*) FILTER (y = 1) ELSE 0.0 END, 9), 6) AS recall,
 round(round(CASE WHEN count(*) FILTER (flag) > 0 THEN count(*) FILTER (flag AND y = 1) / count(*) FILTER (flag) ELSE 0.0 END, 9), 6) AS precision,
 round(round(CASE WHEN count(*) FILTER (y = 0) > 0 THEN count(*) FILTER (flag AND y = 0) / count(*) FILTER (y = 0) ELSE 0.0 END, 9), 6) AS false_positive_rate,
 round(round(avg(p), 9), 6) AS avg_fraud_score, round(round(avg((txn_id % 97) / 10), 9), 6) AS avg_latency_ms, round(round(avg(Amount), 9), 6) AS avg_transaction_amount FROM s
 WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM log) GROUP BY 1, 2""",
)
def _(spark, sf):
    out = replay(T.daily_performance(scored_stream(spark, sf)), spark)
    shares = [c for c in out.columns if c in ("recall", "precision", "false_positive_rate", "avg_latency_ms", "avg_fraud_score", "avg_transaction_amount")]
    return out.withColumns({c: F.round(F.round(c, 9), 6) for c in shares})


@query(
    "r9_late_labels",
    f"""WITH {Q.AUDIT}, m AS (SELECT p.transaction_id, p.model_name, p.created_at, g.true_label, g.feedback_source FROM predictions p LEFT JOIN ground_truth g USING (transaction_id)
 WHERE p.model_name = 'model_a') SELECT transaction_id, model_name, true_label, feedback_source FROM m
 WHERE true_label IS NOT NULL OR created_at < (SELECT max(ts) FROM log) - INTERVAL 5 DAYS""",
)
def _(spark, sf):
    rows = scored_stream(spark, sf).where(F.col("txn_id") % 11 != 0)
    guesses = rows.select(F.col("txn_id").cast("string").alias("transaction_id"), "model_name", F.col("ts").alias("created_at"))
    labels = event_stream(spark, sf).where(F.col("txn_id") % 5 != 0)
    names = F.array(*map(F.lit, A.FEEDBACK_SOURCES))
    feedback = labels.select(
        F.col("txn_id").cast("string").alias("transaction_id"),
        F.col("Class").alias("true_label"),
        F.element_at(names, (F.col("txn_id") % 4 + 1).cast("int")).alias("feedback_source"),
        (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("reported_at"),
    )
    out = replay(T.late_labels(guesses, feedback), spark)
    # unlabelled predictions come out once their time is over; the last days are still open when input ends
    last = A.log(spark, sf).agg(F.max("ts").alias("last"))  # one row
    settled = F.col("true_label").isNotNull() | (F.col("created_at").cast("timestamp_ntz") < F.col("last") - F.expr("INTERVAL 5 DAYS"))
    return out.crossJoin(F.broadcast(last)).where(settled).select("transaction_id", "model_name", "true_label", "feedback_source")
