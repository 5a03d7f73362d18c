"""Card-transaction view of the generic event tables.

``events`` plays the transaction log, the first 28 entries of an embedding play the
anonymised components V1..V28. The derived tables (scores, predictions, labels, ...)
are deterministic functions of it, so results can be compared with plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.schema import FEEDBACK_SOURCES, V_COLS

EPOCH_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z, time zero of the log


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_event_columns(events: DataFrame) -> DataFrame:
    t_us = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(EPOCH_US)
    return events.select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("card_id"),
        "ts",
        t_us.alias("t_us"),
        F.floor(t_us / F.lit(1_000_000)).cast("long").alias("time_s"),
        F.col("value").alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias("Class"),
    )


def component_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(V_COLS)]
    )


def with_components(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with V1..V28: vectors are dealt out in turn, so all of them are used. The planner
    broadcasts the vectors where they are few and shuffles both sides otherwise."""
    vectors = component_vectors(spark, sf_dir)
    return rows.join(vectors, F.col("txn_id") % vectors.count() == F.col("vec_id")).drop("vec_id")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without components, for operators that need none of them."""
    return with_event_columns(table(spark, sf_dir, "events"))


def spread(df: DataFrame) -> DataFrame:
    """A table stored as one small split would keep a single core busy with 28 columns of
    arithmetic: deal it out once. A table of several splits is left as it is, so this
    never moves more than one split (spark.sql.files.maxPartitionBytes)."""
    if df.rdd.getNumPartitions() > 1:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_components(spread(log(spark, sf_dir)), spark, sf_dir)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 31-column input contract: Time, V1..V28, Amount, Class."""
    return txn(spark, sf_dir).select(
        F.col("time_s").cast("double").alias("Time"), *V_COLS, "Amount", F.col("Class").cast("long").alias("Class")
    )


def _score(multiplier: int, weight: int, model: str, rows: DataFrame) -> DataFrame:
    num = (F.col("txn_id") * multiplier) % 10007 + weight * F.col("Class")
    return rows.select(
        F.lit(model).alias("model_name"),
        "txn_id",
        "ts",
        "Amount",
        F.col("Class").alias("label"),
        (num / F.lit(10007 + weight)).alias("p"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of two models for every transaction, in long form."""
    rows = log(spark, sf_dir)
    return _score(7919, 4000, "model_a", rows).unionByName(_score(6007, 1000, "model_b", rows))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).select(
        F.col("txn_id").cast("string").alias("transaction_id"),
        F.col("ts").alias("timestamp_received"),
        F.col("time_s").cast("double").alias("time_seconds"),
        F.col("Amount").alias("amount"),
        F.col("card_id").cast("string").alias("card_id"),
        F.lit(None).cast("string").alias("merchant_id"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        scored(spark, sf_dir)
        .where(F.col("txn_id") % 11 != 0)
        .select(
            F.concat_ws("-", "model_name", "txn_id").alias("prediction_id"),
            F.col("txn_id").cast("string").alias("transaction_id"),
            "model_name",
            F.lit("1.0").alias("model_version"),
            F.col("p").alias("fraud_probability"),
            (F.col("p") >= 0.5).alias("is_fraud"),
            F.lit(0.5).alias("decision_threshold"),
            ((F.col("txn_id") % 97) / F.lit(10)).alias("inference_time_ms"),
            F.col("ts").alias("created_at"),
        )
    )


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.element_at(F.array(*map(F.lit, FEEDBACK_SOURCES)), (F.col("txn_id") % 4 + 1).cast("int"))
    return (
        log(spark, sf_dir)
        .where(F.col("txn_id") % 5 != 0)
        .select(
            F.concat(F.lit("fb-"), F.col("txn_id")).alias("feedback_id"),
            F.col("txn_id").cast("string").alias("transaction_id"),
            F.col("Class").alias("true_label"),
            source.alias("feedback_source"),
            (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("reported_at"),
            F.lit(None).cast("string").alias("notes"),
        )
    )


def feedback_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth with later corrections for every seventh transaction."""
    first = ground_truth(spark, sf_dir)
    later = first.where(F.col("transaction_id").cast("long") % 7 == 0).select(
        F.concat("feedback_id", F.lit("-b")).alias("feedback_id"),
        "transaction_id",
        (1 - F.col("true_label")).alias("true_label"),
        F.lit("manual_review").alias("feedback_source"),
        (F.col("reported_at") + F.expr("INTERVAL 2 DAYS")).alias("reported_at"),
        F.lit("corrected").alias("notes"),
    )
    return first.unionByName(later)


def duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = txn(spark, sf_dir)
    return rows.unionByName(rows.where(F.col("txn_id") % 100 == 0))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with negative, null, NaN and absurd amounts mixed in."""
    amount = (
        F.when(F.col("txn_id") % 47 == 0, F.lit(99999.0))
        .when(F.col("txn_id") % 43 == 0, F.lit(float("nan")))
        .when(F.col("txn_id") % 41 == 0, F.lit(None).cast("double"))
        .when(F.col("txn_id") % 40 == 0, -F.col("Amount"))
        .otherwise(F.col("Amount"))
    )
    return txn(spark, sf_dir).withColumn("Amount", amount)


SHIPMENT_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "Amount"]


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A heavily tied log: line items at day grain, ordered within a day by the key columns and the amount."""
    li = table(spark, sf_dir, "lineitem")
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (day * 86400).alias("time_s"),
        F.col("l_extendedprice").alias("Amount"),
        "l_returnflag",
    )
