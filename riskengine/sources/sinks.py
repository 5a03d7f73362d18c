"""Sinks: tables, append-only audit data, reports, rankings and run metadata."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from riskengine import schema as S
from riskengine.operators.prep import latest_per_key
from riskengine.operators.views import drift_rows, evaluation_rows
from riskengine.session import scratch_path


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def to_transactions(df: DataFrame) -> DataFrame:
    """Rows in the shape of the ``transactions`` table; a missing component becomes 0."""
    have = set(df.columns)
    if "transaction_id" in have:
        ident = F.col("transaction_id")
    elif "txn_id" in have:
        ident = F.col("txn_id").cast("string")
    else:
        # the id follows from the content, so a repeated load gives the same id
        ident = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns]), 256)
    # a source without arrival time gets the load time
    received = F.col("ts").cast("timestamp") if "ts" in have else F.current_timestamp()
    time = "time_s" if "time_s" in have else "Time"
    columns = [
        ident.alias("transaction_id"),
        received.alias("timestamp_received"),
        F.col(time).cast("double").alias("time_seconds"),
        F.col("Amount").alias("amount"),
        *[
            (F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(0.0)) if c in have else F.lit(0.0)).alias(c.lower())
            for c in S.V_COLS
        ],
        *[
            (F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c)
            for c in ["card_id", "merchant_id", "merchant_category", "device_id", "ip_address"]
        ],
    ]
    return df.select(*columns)


def append_transactions(df: DataFrame, path: str) -> None:
    to_transactions(df).write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 5000, **options) -> None:
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=batch_rows).options(**options).save()


def _monitoring(rows: DataFrame, checked_at=None) -> DataFrame:
    """Fill the monitoring table; the id follows from model, metric and check time."""
    at = F.current_timestamp() if checked_at is None else checked_at
    have = set(rows.columns)
    stamped = rows.withColumn("check_timestamp", at)
    stamped = stamped.withColumn(
        "check_id", F.sha2(F.concat_ws("|", "model_name", "metric_type", F.col("check_timestamp").cast("string")), 256)
    )
    have |= {"check_id", "check_timestamp"}
    return stamped.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.MONITORING_METRICS
        ]
    )


def append_evaluation(documents: DataFrame, path: str, dataset_type: str | None = None, checked_at=None) -> None:
    _monitoring(evaluation_rows(documents, dataset_type), checked_at).write.mode("append").parquet(path)


def append_drift(drifted: DataFrame, path: str, checked_at=None) -> None:
    _monitoring(drift_rows(drifted), checked_at).write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small report as JSON lines in one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_ranking(ranking: DataFrame, path: str) -> None:
    """A ranking (one row per feature) as one CSV file in rank order."""
    ranking.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_feature_config(spark: SparkSession, features: Sequence[str], path: str) -> None:
    row = spark.createDataFrame([(list(features), len(features))], "features array<string>, count int")
    write_report(row, path)


def write_split_config(
    spark: SparkSession, ratio: float, split_at: float, train: int, test: int, path: str
) -> None:
    row = spark.createDataFrame(
        [("chronological_time_based", ratio, float(split_at), train, test)],
        "split_method string, train_ratio double, split_timestamp double, train_size long, test_size long",
    ).withColumn("written_at", F.current_timestamp())
    write_report(row, path)


def prediction_log(scored: DataFrame, threshold: float, model_name: str) -> DataFrame:
    """One log record per prediction, figures in the log's fixed precision."""
    return scored.select(
        F.col("transaction_hash"),
        F.round("fraud_probability", 6).alias("fraud_probability"),
        "is_fraud",
        F.round("latency_ms", 2).alias("latency_ms"),
        F.round("Amount", 2).alias("input_amount"),
        F.lit(round(threshold, 4)).alias("threshold"),
        F.lit(model_name).alias("model_name"),
    )



# ---- a stored table with upserts ----

#: the partition column of an upsert table
PART = "_part"


def _placed(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    return df.withColumn(PART, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))


def create_upsert_table(df: DataFrame, path: str, keys: Sequence[str], parts: int = 32) -> None:
    """Store rows in ``parts`` folders by a hash of their key, so that a merge touches few of them. Rows of one key are expected
    once; ``upsert`` settles those that are not, in the folders it touches. The number of folders is part of the table."""
    if PART in df.columns:
        raise ValueError(f"'{PART}' is the table's own column")
    placed = _placed(df, keys, parts)
    placed.repartition(PART).write.partitionBy(PART).parquet(path)
    # a table that has no rows yet keeps its schema and number of folders as well
    df.sparkSession.createDataFrame([(parts, df.schema.json())], "parts int, columns string").coalesce(1).write.json(f"{path}/_table")


def _table(spark: SparkSession, path: str):
    parts, columns = spark.read.schema("parts int, columns string").json(f"{path}/_table").first()
    return parts, StructType.fromJson(json.loads(columns))


def read_upsert_table(spark: SparkSession, path: str) -> DataFrame:
    _parts, columns = _table(spark, path)
    return spark.read.schema(StructType([*columns.fields, StructField(PART, IntegerType())])).parquet(path).drop(PART)


def upsert(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> list[int]:
    """Merge rows into the table at ``path``: of all rows of a key, stored and new, the largest by ``order`` stays. Only folders that
    hold a key of ``df`` are read and rewritten, by a dynamic partition overwrite from a staged copy; other files are not touched.
    Merging the same rows again leaves the same table. Returns the folders rewritten."""
    spark = df.sparkSession
    parts, columns = _table(spark, path)
    new = _placed(df.select(*columns.names), keys, parts)
    # at most as many as the table has folders
    touched = sorted(r[0] for r in new.select(PART).distinct().collect())
    if not touched:
        return []
    stored = spark.read.schema(StructType([*columns.fields, StructField(PART, IntegerType())])).parquet(path).where(F.col(PART).isin(touched))
    merged = latest_per_key(stored.unionByName(new), [PART, *keys], list(order)).select(*columns.names, PART)
    staged = scratch_path(spark, "upsert")
    merged.write.parquet(staged)
    # the staged rows, not the folders that are about to be replaced
    rows = spark.read.schema(merged.schema).parquet(staged)
    rows.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return touched
