import pytest
from pyspark.sql import functions as F

from riskengine.operators import models as L
from riskengine.operators.windows import trailing_stats
from riskengine.sources import adapter as A
from riskengine.streaming import events as E
from riskengine.streaming import velocity as T


def test_exact_velocity_equals_batch(spark, small, tmp_path):
    rows = A.log(spark, small).select("txn_id", "card_id", "time_s", "Amount")
    source = str(tmp_path / "in")
    for low, high in ((0, 9), (9, 20), (20, 99)):
        rows.where(F.floor(F.col("time_s") / 86400).between(low, high - 1)).coalesce(1).write.mode("append").parquet(source)
    writer = T.exact_velocity(str(tmp_path / "out"), str(tmp_path / "cells"), {"w": 86400 * 3})
    E.run_available(E.file_events(spark, source, rows.schema, files_per_batch=1), str(tmp_path / "ck"), writer=writer)
    got = {r.txn_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = trailing_stats(rows, {"w": 86400 * 3}, by=["card_id"], recency="time_since_last_txn").collect()
    assert len(got) == len(want)
    for r in want:
        assert got[r.txn_id].count_w == r.count_w and got[r.txn_id].time_since_last_txn == r.time_since_last_txn
        assert got[r.txn_id].avg_w == pytest.approx(r.avg_w)


def test_a_repeated_batch_changes_nothing(spark, small, tmp_path):
    rows = A.log(spark, small).select("txn_id", "card_id", "time_s", "Amount")
    out = str(tmp_path / "out")
    writer = T.exact_velocity(out, str(tmp_path / "cells"), {"w": 3600})
    writer(rows.where("time_s < 900000"), 0)
    for _ in range(2):
        writer(rows.where("time_s >= 900000"), 1)
    stored = spark.read.parquet(out)
    assert stored.count() == rows.count()
    want = trailing_stats(rows, {"w": 3600}, by=["card_id"]).agg(F.sum("count_w")).first()[0]
    assert stored.agg(F.sum("count_w")).first()[0] == want


def test_empty_batches_gaps_and_compaction(spark, tmp_path):
    """An empty first batch, cards last seen long ago, and history merged every second batch."""
    rows = spark.createDataFrame([(i, i % 3, 86400 * 50 * (i // 6) + 60 * i, 1e8 + i % 5) for i in range(60)], "txn_id long, card_id long, time_s long, Amount double")
    out = str(tmp_path / "out")
    writer = T.exact_velocity(out, str(tmp_path / "cells"), {"w": 3600}, compact_every=2)
    writer(rows.where("false"), 0)
    for k in range(10):
        writer(rows.where(f"txn_id div 6 = {k}"), k + 1 + (k > 4))
    writer(rows.where("txn_id div 6 = 9"), 11)  # a repeated batch
    got = {r.txn_id: (r.count_w, round(r.avg_w, 5), round(r.std_w, 5), r.time_since_last_txn) for r in spark.read.parquet(out).collect()}
    want = trailing_stats(rows, {"w": 3600}, by=["card_id"], recency="time_since_last_txn").collect()
    assert got == {r.txn_id: (r.count_w, round(r.avg_w, 5), round(r.std_w, 5), r.time_since_last_txn) for r in want}


def test_stream_scores_equal_batch_scores(spark, small, tmp_path):
    rows = A.txn(spark, small).drop("ts")
    model = L.fit("decision_tree", rows, ["V1", "V2", "Amount"])
    source = str(tmp_path / "in")
    rows.repartition(3).write.parquet(source)
    scored = E.score_requests(E.file_events(spark, source, rows.schema, files_per_batch=1), model)
    tx, pred, log = (str(tmp_path / n) for n in ("tx", "pred", "log"))
    E.run_available(scored, str(tmp_path / "ck"), writer=E.audit(tx, pred, log, "m"))
    streamed = spark.read.parquet(pred)
    batch = E.score_requests(rows, model).select(F.col("txn_id").cast("string").alias("transaction_id"), F.col("fraud_probability").alias("q"))
    both = streamed.join(batch, "transaction_id")
    assert streamed.count() == both.count() == rows.count() and both.where("fraud_probability <> q").count() == 0
    assert spark.read.parquet(tx).count() == rows.count()
    logged = spark.read.json(log)
    assert logged.count() == rows.count() and set(logged.columns) >= {"transaction_hash", "fraud_probability", "threshold"}


def test_requests_hash_by_content(spark):
    texts = ['{"Time": 1, "Amount": 2.0, "V1": 0.5}', '{"V1": 0.5, "Amount": 2.0, "Time": 1}', '{"Time": 1, "Amount": 3.0}', "not json"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = E.parse_requests(df).collect()
    assert got[0].transaction_hash == got[1].transaction_hash != got[2].transaction_hash
    assert [g.error is None for g in got] == [True, True, True, False]


def test_repeated_requests_are_dropped(spark, small, tmp_path):
    rows = A.log(spark, small).withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "transaction_hash", F.sha2(F.col("txn_id").cast("string"), 256)
    )
    rows.unionByName(rows).write.parquet(str(tmp_path / "in"))
    stream = E.once_per_hash(E.file_events(spark, str(tmp_path / "in"), rows.schema))
    E.run_available(stream, str(tmp_path / "ck"), path=str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()
