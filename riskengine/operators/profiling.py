"""Descriptive analysis: statistics, correlations, histograms, variance shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskengine.functions.columns import count_if, nan_to_null
from riskengine.operators.quantiles import quantiles
from riskengine.operators.shape import per_column
from riskengine.operators.windows import running_share


def descriptive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    clean = nan_to_null(df.select(*cols))
    quart = quantiles(clean, cols, [0.25, 0.5, 0.75])

    def q(k):
        return lambda c: F.lit(quart[(None, c)][k]).cast("double")

    return per_column(
        clean,
        cols,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(c).cast("double"),
            "q25": q(0),
            "q50": q(1),
            "q75": q(2),
            "max": lambda c: F.max(c).cast("double"),
            "variance": F.var_samp,
            "range": lambda c: (F.max(c) - F.min(c)).cast("double"),
        },
    )


def hourly_rate(df: DataFrame, time: str = "time_s", label: str = "Class") -> DataFrame:
    """Volume and fraud rate by hour of day."""
    hour = (F.floor(F.col(time) / 3600) % 24).cast("int")
    return (
        df.groupBy(hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("total"), F.sum(label).cast("long").alias("fraud"))
        .withColumn("fraud_rate", F.col("fraud") / F.col("total") * 100)
    )


def absolute_hour_rate(df: DataFrame, time: str = "time_s", label: str = "Class") -> DataFrame:
    """Volume and fraud rate by hour since the start of the log."""
    return df.groupBy(F.floor(F.col(time) / 3600).cast("long").alias("abs_hour")).agg(
        F.count(F.lit(1)).alias("volume"), (F.avg(label) * 100).alias("fraud_rate")
    )


PERCENTS = [50, 75, 90, 95, 99]


def amount_by_class(df: DataFrame, amount: str = "Amount", label: str = "Class") -> DataFrame:
    probs = [p / 100 for p in PERCENTS]
    cuts = quantiles(df, [amount], probs, by=label)
    stats = df.groupBy(label).agg(
        F.avg(amount).alias("mean"),
        F.stddev_samp(amount).alias("std"),
        F.min(amount).alias("min"),
        F.max(amount).alias("max"),
    )
    rows = [(group, *values) for (group, _), values in cuts.items()]
    kind = df.schema[label].dataType
    fields = StructType([StructField("_c", kind), *[StructField(f"p{p}", DoubleType()) for p in PERCENTS]])
    table = df.sparkSession.createDataFrame(rows, fields)  # one row per class
    return stats.join(F.broadcast(table), F.col(label).eqNullSafe(F.col("_c"))).drop("_c").withColumn("median", F.col("p50"))


def label_correlation(df: DataFrame, cols: Sequence[str], label: str = "Class") -> DataFrame:
    """Pearson correlation of every column with the label, one pass."""
    return per_column(
        df, cols, {"correlation": lambda c: F.expr(f"corr(CAST(`{c}` AS DOUBLE), CAST(`{label}` AS DOUBLE))")}
    )


def ranked_correlation(df: DataFrame, cols: Sequence[str], label: str = "Class", top: int | None = None) -> DataFrame:
    ranked = (
        label_correlation(df, cols, label)
        .withColumn("abs_correlation", F.abs("correlation"))
        .orderBy(F.col("abs_correlation").desc_nulls_last(), "column")
    )
    return ranked.limit(top) if top else ranked


def top_features(df: DataFrame, cols: Sequence[str], label: str = "Class", n: int = 20) -> list[str]:
    return [r["column"] for r in ranked_correlation(df, cols, label, n).collect()]


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature1, feature2, correlation) for i < j. The matrix is columns x columns,
    whatever the number of rows; the Gram matrix is summed in a tree."""
    present = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    vectors = VectorAssembler(inputCols=list(cols), outputCol="v", handleInvalid="skip").transform(present)
    m = Correlation.corr(vectors, "v").first()[0].toArray()
    pairs = [
        (a, b, None if m[i, j] != m[i, j] else float(m[i, j]))
        for i, a in enumerate(cols)
        for j, b in enumerate(cols)
        if i < j
    ]
    shape = StructType(
        [
            StructField("feature1", StringType()),
            StructField("feature2", StringType()),
            StructField("correlation", DoubleType()),
        ]
    )
    return df.sparkSession.createDataFrame(pairs, shape)


correlation_pairs = correlation_matrix


def variance_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of each column in the summed variance, largest first, with running sum."""
    var = per_column(df, cols, {"variance": F.var_samp})
    total = var.agg(F.sum("variance").alias("_total"))
    shares = var.crossJoin(F.broadcast(total)).select(
        "column", (F.col("variance") / F.col("_total")).alias("explained")
    )
    return running_share(shares, "explained", "cumulative", ["column"])


def two_components(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, list[float]]:
    """Standardised two-component projection of all rows and the explained ratios."""
    vectors = VectorAssembler(inputCols=list(cols), outputCol="_raw").transform(df.select(*keep, *cols))
    scaled = StandardScaler(inputCol="_raw", outputCol="_std", withMean=True).fit(vectors).transform(vectors)
    model = PCA(k=2, inputCol="_std", outputCol="pc").fit(scaled)
    return model.transform(scaled).select(*keep, "pc"), [float(x) for x in model.explainedVariance]


def histogram(
    df: DataFrame,
    value: Column,
    bins: Mapping[int, int] | int,
    label: str = "Class",
    where: Column | None = None,
) -> DataFrame:
    """Equal-width bins between minimum and maximum of each class, last bin closed."""
    rows = df.select(F.col(label), value.cast("double").alias("v")).where(F.col("v").isNotNull())
    if where is not None:
        rows = df.where(where).select(F.col(label), value.cast("double").alias("v")).where(F.col("v").isNotNull())
    if isinstance(bins, int):
        width = F.lit(bins)
    else:
        # a class without an entry, a null one among them, gets as many bins as the finest
        width = F.lit(max(bins.values()))
        for group, k in bins.items():
            width = F.when(F.col(label) == group, k).otherwise(width)
    limits = rows.groupBy(F.col(label).alias("_c")).agg(
        F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    spread = F.col("_hi") - F.col("_lo")
    step = spread / F.col("_k")
    place = F.when(spread > 0, F.least(F.col("_k") - 1, F.floor((F.col("v") - F.col("_lo")) / step))).otherwise(0)
    return (
        rows.join(F.broadcast(limits), F.col(label).eqNullSafe(F.col("_c")))  # one row per class
        .withColumn("_k", width)
        .withColumn("bin", place.cast("long"))
        .groupBy(label, "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.first("_lo").alias("_lo"),
            F.first(step).alias("_step"),
            F.first("_n").alias("_n"),
        )
        .select(
            label,
            "bin",
            "n",
            (F.col("_lo") + F.col("bin") * F.col("_step")).alias("bin_start"),
            F.when(F.col("_step") > 0, F.col("n") / (F.col("_n") * F.col("_step"))).alias("density"),
        )
    )


def box_plot(df: DataFrame, value: str = "Amount", label: str = "Class") -> DataFrame:
    """Quartiles, whiskers (last value inside 1.5 IQR) and the number of points outside."""
    cuts = quantiles(df, [value], [0.25, 0.5, 0.75], by=label)
    kind = df.schema[label].dataType
    names = ["q1", "median", "q3"]
    fields = StructType([StructField("_c", kind), *[StructField(n, DoubleType()) for n in names]])
    table = df.sparkSession.createDataFrame([(g, *v) for (g, _), v in cuts.items()], fields)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col(value)
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        df.select(label, value)
        .join(F.broadcast(table), F.col(label).eqNullSafe(F.col("_c")))  # one row per class
        .groupBy(label, *names)
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            count_if(~inside).alias("outside"),
        )
    )
