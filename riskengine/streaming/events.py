"""Scoring requests as a stream: source, parsing, validation, scoring, audit."""

from __future__ import annotations

import time as clock
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskengine import schema as S
from riskengine.functions import features as X
from riskengine.functions.columns import decision
from riskengine.operators.quality import request_error
from riskengine.sources.sinks import prediction_log, to_transactions


def file_events(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def kafka_events(spark: SparkSession, servers: str, topic: str, rows_per_batch: int | None = None) -> DataFrame:
    """Requests from a Kafka topic as (value, ts); needs the Kafka source on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if rows_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", rows_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ts"))


def parse_requests(events: DataFrame, value: str = "value", cap: float = S.SERVING_AMOUNT_CAP) -> DataFrame:
    """JSON text to request columns plus ``transaction_hash`` and ``error`` (null = fine).
    The hash is over the key-sorted object, so equal requests have equal hashes."""
    request = F.from_json(value, S.SCORE_REQUEST)
    parsed = events.withColumn("_r", request)

    def number(c):
        return F.when(~F.isnan(f"_r.{c}"), F.col(f"_r.{c}"))

    out = parsed.withColumns(
        {
            **{c: number(c) for c in ["Time", "Amount", *S.V_COLS]},
            # the map keeps only what was sent; sorting its entries fixes the key order
            "transaction_hash": F.sha2(
                F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.from_json(value, "map<string,string>"))))), 256
            ),
        }
    ).drop("_r")
    return out.withColumn("error", request_error(F.col("Amount"), F.col("Time"), cap))


def route(good: str, dead: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that sends faulty requests to a dead-letter table. A repeated batch
    overwrites its own folder, so nothing is written twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # parsed and hashed once for both sinks
        try:
            batch.where(F.col("error").isNull()).drop("error").write.mode("overwrite").parquet(f"{good}/batch_id={batch_id}")
            batch.where(F.col("error").isNotNull()).write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def once_per_hash(events: DataFrame, delay: str = "1 hour", time: str = "ts", key: str = "transaction_hash") -> DataFrame:
    """Drop repeated requests that arrive within the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def score_requests(events: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """Row-local features, probability and decision; the same functions as in batch, on a
    batch or a stream."""
    rows = events if "time_s" in events.columns else events.withColumn("time_s", F.floor("Time").cast("long"))
    scored = model.transform(rows.transform(X.stateless))
    return scored.withColumn("fraud_probability", vector_to_array("probability")[1]).withColumn(
        "is_fraud", decision("fraud_probability", threshold)
    )


def audit(
    transactions: str, predictions: str, log: str, model_name: str, threshold: float = 0.5
) -> Callable[[DataFrame, int], None]:
    """Batch writer for the audit tables and the per-prediction log. The id of a row is
    its request hash and a batch owns its folder, so a retry writes the same rows again; only the
    measured latency can differ. It is the scoring time of the batch by its rows. Rows without an arrival
    time get the time of writing. A failure is raised: the batch is then tried again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch if "transaction_hash" in batch.columns else batch.withColumn(
            "transaction_hash", F.sha2(F.col("txn_id").cast("string"), 256)
        )
        ident = F.col("txn_id").cast("string") if "txn_id" in batch.columns else F.col("transaction_hash")
        # three sinks read the scores
        scores = batch.withColumn("transaction_id", ident).persist()
        try:
            began = clock.perf_counter()
            rows = scores.agg(F.count("fraud_probability")).first()[0]
            batch_ms = (clock.perf_counter() - began) * 1000
            batch = scores.withColumn("latency_ms", F.lit(batch_ms / max(rows, 1)))
            to_transactions(batch).write.mode("overwrite").parquet(f"{transactions}/batch_id={batch_id}")
            batch.select(
                F.sha2(F.concat_ws("|", "transaction_id", F.lit(model_name)), 256).alias("prediction_id"),
                "transaction_id",
                F.lit(model_name).alias("model_name"),
                F.lit("1.0").alias("model_version"),
                "fraud_probability",
                "is_fraud",
                F.lit(threshold).alias("decision_threshold"),
                F.col("latency_ms").alias("inference_time_ms"),
                (F.col("ts").cast("timestamp") if "ts" in batch.columns else F.current_timestamp()).alias("created_at"),
            ).write.mode("overwrite").parquet(f"{predictions}/batch_id={batch_id}")
            prediction_log(batch, threshold, model_name).write.mode("overwrite").json(f"{log}/batch_id={batch_id}")
        finally:
            scores.unpersist()

    return write


def run_available(stream: DataFrame, checkpoint: str, writer=None, path: str | None = None, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop: to a batch writer or to a Parquet path."""
    sink = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = sink.foreachBatch(writer).start() if writer else sink.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query
