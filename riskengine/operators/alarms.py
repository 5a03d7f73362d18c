"""Standing watches over daily figures: limits broken for days on end, latency percentiles, promotion of a challenger.

Defined results: a day without a row, or without a figure, ends a run. Percentiles of no latencies are null; a null latency is not
counted. A challenger without a champion, or either without figures, is held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: limits of the alarm and of the promotion gate ---
DAYS_IN_A_ROW = 3
LEAST_GAIN = 0.02
MOST_LOSS = 0.05
MOST_FPR = 0.02

#: size of a sketch; its normalised rank error is about 1.33 / K ** 0.9, here below 0.4 %
K = 800
RANK_ERROR = 0.004


def limit_runs(
    daily: DataFrame, limit: float, value: str = "false_positive_rate", day: str = "transaction_date", by: Sequence[str] = ("model_name",), least: int = DAYS_IN_A_ROW
) -> DataFrame:
    """Every run of calendar days on which ``value`` is above the limit: first_day, last_day, days, worst, alarm
    (``least`` days or more). One row per model and day goes in, so a model's window is small."""
    by = list(by)
    over = daily.where(F.col(value) > limit).select(*by, F.col(day).cast("date").alias("_day"), F.col(value).alias("_v"))
    # the day less its number in the run is the same all through a run
    numbered = over.withColumn("_run", F.date_sub("_day", F.row_number().over(Window.partitionBy(*by).orderBy("_day"))))
    runs = numbered.groupBy(*by, "_run").agg(F.min("_day").alias("first_day"), F.max("_day").alias("last_day"), F.count(F.lit(1)).alias("days"), F.max("_v").alias("worst"))
    return runs.select(*by, "first_day", "last_day", "days", "worst", (F.col("days") >= least).alias("alarm"))


def daily_sketches(rows: DataFrame, value: str, day: str, by: Sequence[str] = ("model_name",), k: int = K) -> DataFrame:
    """(by, day, n, sketch): one mergeable quantile sketch per day, to be stored."""
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy(*by, F.to_date(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    )


def merged_percentiles(sketches: DataFrame, probs: Sequence[float] = (0.50, 0.95, 0.99), by: Sequence[str] = ("model_name",), k: int = K) -> DataFrame:
    """(by, n, p50, p95, p99) of any days of stored sketches; the rows themselves are not read again."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("_s"))
    return merged.select(*by, "n", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(f"p{round(100 * p)}") for p in probs])


def promotion_gate(
    champion: DataFrame, challenger: DataFrame, least_gain: float = LEAST_GAIN, most_loss: float = MOST_LOSS, most_fpr: float = MOST_FPR
) -> DataFrame:
    """Verdict per model name over its champion's and its challenger's figures (model_name, pr_auc, false_positive_rate):
    ``blocked`` when the area falls by more than ``most_loss`` of the champion's or the rate exceeds ``most_fpr``, ``promoted`` when
    the area gains at least ``least_gain``, else ``held``; with the reason."""
    old = champion.select("model_name", F.col("pr_auc").alias("champion_pr_auc"))
    new = challenger.select("model_name", F.col("pr_auc").alias("challenger_pr_auc"), F.col("false_positive_rate").alias("challenger_fpr"))
    a, b, fpr = (F.col(c) for c in ("champion_pr_auc", "challenger_pr_auc", "challenger_fpr"))
    both = new.join(old, "model_name", "left").withColumn("gain", F.when(a > 0, b / a - 1))
    reason = (
        F.when(fpr > most_fpr, "false_positive_rate")
        .when(F.col("gain") < -most_loss, "pr_auc_loss")
        .when(fpr.isNull() | F.col("gain").isNull(), "no_comparison")
        .when(F.col("gain") >= least_gain, "pr_auc_gain")
        .otherwise("small_gain")
    )
    verdict = F.when(F.col("reason").isin("false_positive_rate", "pr_auc_loss"), "blocked").when(F.col("reason") == "pr_auc_gain", "promoted").otherwise("held")
    return both.withColumn("reason", reason).withColumn("verdict", verdict)
