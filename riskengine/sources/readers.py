"""Sources: CSV with several null tokens, Parquet, JDBC or table audit data, metric files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskengine import schema as S
from riskengine.functions.columns import count_if, nan_to_null
from riskengine.operators.views import transaction_results


def _non_empty(df: DataFrame, path: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def read_csv(spark: SparkSession, path: str, schema: StructType = S.RAW_SCHEMA) -> DataFrame:
    """Typed CSV scan; a missing path or an empty file is an error."""
    return _non_empty(spark.read.schema(schema).option("header", True).csv(path), path)


def read_csv_null_tokens(
    spark: SparkSession, path: str, schema: StructType = S.RAW_SCHEMA, tokens: Sequence[str] = tuple(S.NULL_TOKENS)
) -> DataFrame:
    """CSV whose missing values are written in several ways. The reader takes only one
    null token, so fields are read as text and cast."""
    text = StructType([StructField(f.name, StringType()) for f in schema])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

    def typed(name: str, dtype) -> Column:
        value = F.when(~F.col(name).isin(list(tokens)), F.col(name))
        # an integer column may be written as 0.0
        if dtype.typeName() in ("long", "integer"):
            return value.try_cast("double").cast(dtype)
        return value.try_cast(dtype)

    return _non_empty(raw.select(*[typed(f.name, f.dataType).alias(f.name) for f in schema]), path)


def read_parquet(spark: SparkSession, path: str, label: str = "Class") -> tuple[DataFrame, list[str]]:
    """A stored table and its feature list: every column but the label."""
    df = spark.read.parquet(path)
    return df, [c for c in df.columns if c != label]


def read_labelled_batch(spark: SparkSession, path: str, label: str = "Class") -> tuple[DataFrame, dict]:
    """Labelled CSV batch with its size; a batch without any fraud is worth a warning."""
    header = spark.read.option("header", True).csv(path)
    if label not in header.columns:
        raise ValueError(f"column '{label}' not found in {path}")
    df = nan_to_null(
        header.select(*[F.col(c).try_cast("long" if c == label else "double").alias(c) for c in header.columns])
    )
    rows, fraud = df.agg(F.count(F.lit(1)), count_if(F.col(label) == 1)).first()
    if not rows:
        raise ValueError(f"no rows in {path}")
    return df, {"rows": rows, "fraud": fraud, "no_fraud_warning": fraud == 0}


def parse_metrics(documents: DataFrame) -> DataFrame:
    """Flat metrics from either document form (fixed schema, any of the known keys).

    ``documents`` has the columns of ``EVALUATION_DOC`` plus ``model_name``. In the
    cross-validation form the means are used and FPR is 1 - specificity."""
    cv = F.col("cv_metrics").isNotNull()

    def mean(*names):
        return F.coalesce(*[F.col(f"cv_metrics.{n}.mean") for n in names])

    def pick(cv_value, *direct, default=0.0):
        plain = F.coalesce(*[F.col(c).cast("double") for c in direct], F.lit(float(default)))
        return F.when(cv, F.coalesce(cv_value, F.lit(float(default)))).otherwise(plain)

    specificity = mean("specificity", "tnr")
    caught_share = F.coalesce("fraud_caught", F.lit(0)) / F.greatest(F.coalesce("test_samples", F.lit(0)), F.lit(1))
    return documents.select(
        "model_name",
        pick(mean("average_precision"), "pr_auc", "average_precision").alias("pr_auc"),
        pick(mean("roc_auc"), "roc_auc").alias("roc_auc"),
        pick(mean("recall"), "recall").alias("recall"),
        pick(mean("precision"), "precision").alias("precision"),
        F.when(cv, 1.0 - F.coalesce(specificity, F.lit(1.0)))
        .otherwise(F.coalesce("false_positive_rate", "fpr", F.lit(0.0)))
        .alias("false_positive_rate"),
        F.coalesce("threshold", F.lit(0.5)).alias("threshold"),
        F.when(cv, F.coalesce("train_samples", F.lit(0)))
        .otherwise(F.coalesce("test_samples", F.lit(0)))
        .cast("long")
        .alias("test_samples"),
        F.when(cv, F.coalesce("fraud_rate", F.lit(0.0)))
        .otherwise(F.coalesce(F.col("fraud_rate"), caught_share))
        .alias("fraud_ratio"),
        F.coalesce("inference_time_ms_per_sample", F.col("inference_time_seconds") * 1000, F.lit(0.0)).alias(
            "inference_ms"
        ),
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric JSON files of a folder; the model name is the file name without its suffix."""
    docs = spark.read.schema(S.EVALUATION_DOC).option("multiLine", True).json(path)
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    named = docs.withColumn("model_name", F.regexp_replace(stem, r"_(test_metrics|evaluation|metrics|eval)$", ""))
    return parse_metrics(named)


def labelled_predictions(
    transactions: DataFrame,
    predictions: DataFrame,
    ground_truth: DataFrame,
    as_of: Column | None = None,
    days_back: int = 7,
) -> DataFrame:
    """Scored transactions of the last days that have a label. The time filter is put on
    the transactions before the join, so it reaches their scan."""
    as_of = F.current_timestamp() if as_of is None else as_of
    recent = transactions.where(F.col("timestamp_received") >= as_of - F.make_dt_interval(F.lit(days_back)))
    return (
        transaction_results(recent, predictions, ground_truth)
        .where(F.col("actual_fraud").isNotNull())
        .select("transaction_id", "timestamp_received", "model_name", "fraud_probability", "actual_fraud")
    )


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int = 64, **options) -> DataFrame:
    """Audit table from a database, read in key ranges by many tasks."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts)
        .options(**options)
        .load()
    )
