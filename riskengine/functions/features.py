"""Row-local features: every function adds columns and needs no other row, so the
whole set stays in one whole-stage-codegen span and works unchanged on a stream."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: feature definitions --------------------------------------
INTERACTIONS = [
    ("V17", "V14"),
    ("V12", "V10"),
    ("V4", "V11"),
    ("V3", "V7"),
    ("V17", "V12"),
    ("V14", "V10"),
    ("V17", "V10"),
    ("V14", "V12"),
    ("V16", "V17"),
    ("V3", "V14"),
]
COMPONENT_RATIOS = [("V17", "V14"), ("V12", "V10")]
SIGNAL_COLUMNS = ["V17", "V14", "V12", "V10", "V16"]
RATIO_EPS = 1e-8
AMOUNT_EPS = 1e-6
NIGHT_LAST_HOUR = 5
# ----------------------------------------------------------------------------


def amount_column(df: DataFrame) -> str:
    """The unscaled amount when preprocessing kept it."""
    return "Amount_raw" if "Amount_raw" in df.columns else "Amount"


def calendar(df: DataFrame, time: str = "time_s") -> DataFrame:
    t = F.col(time)
    hour = (F.floor(t / F.lit(3600)) % F.lit(24)).cast("int")
    angle = F.lit(2 * math.pi) * F.col("hour") / F.lit(24)
    return (
        df.withColumns({"hour": hour, "day": F.floor(t / F.lit(86400)).cast("int")})
        .withColumns(
            {
                "hour_sin": F.sin(angle),
                "hour_cos": F.cos(angle),
                "hour_of_day": F.col("hour"),
                "is_night": F.col("hour").between(0, NIGHT_LAST_HOUR).cast("int"),
            }
        )
    )


def amount_log(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_log", F.log1p(F.col(amount_column(df))))


def interactions(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    products = {f"{a}_{b}": F.col(a) * F.col(b) for a, b in INTERACTIONS if {a, b} <= have}
    ratios = {
        f"{a}_to_{b}": F.try_divide(F.col(a), F.col(b) + F.lit(RATIO_EPS))
        for a, b in COMPONENT_RATIOS
        if {a, b} <= have
    }
    return df.withColumns({**products, **ratios})


def amount_deviation(df: DataFrame) -> DataFrame:
    """Amount against its trailing averages, plus the two constant columns that the
    feature contract carries (``*_true`` columns of the window operator hold real ranges)."""
    have = set(df.columns)
    a = F.col(amount_column(df))
    eps = F.lit(AMOUNT_EPS)
    out = {}
    for w in ("1h", "24h"):
        if f"avg_amount_{w}" in have:
            out[f"amount_ratio_{w}"] = a / (F.col(f"avg_amount_{w}") + eps)
    if "std_amount_1h" in have:
        avg, std = F.col("avg_amount_1h"), F.col("std_amount_1h")
        out["amount_zscore_1h"] = (a - avg) / (std + eps)
        out["amount_cv_1h"] = std / (avg + eps)
    out["amount_range_1h"] = F.lit(0.0)
    out["amount_percentile_in_range"] = F.lit(0.5)
    return df.withColumns(out)


def burst_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "velocity_spike_ratio",
        F.col("txn_count_1h") * F.lit(24) / (F.col("txn_count_24h") + F.lit(1)),
    )


def signal_score(df: DataFrame) -> DataFrame:
    present = [c for c in SIGNAL_COLUMNS if c in df.columns]
    if not present:
        return df
    magnitude, direction = F.lit(0.0), F.lit(0)
    for c in present:
        magnitude = magnitude + F.abs(c)
        direction = direction + (F.col(c) < 0).cast("int")
    return df.withColumns({"fraud_feature_magnitude": magnitude, "fraud_direction_score": direction})


def flags(df: DataFrame) -> DataFrame:
    out = {
        "is_zero_amount": (F.col(amount_column(df)) == 0).cast("int"),
        "amount_skew_1h": F.lit(0.0),
    }
    if "hour" in df.columns:
        out["is_night"] = F.col("hour").between(0, NIGHT_LAST_HOUR).cast("int")
    return df.withColumns(out)


def stateless(df: DataFrame, time: str = "time_s") -> DataFrame:
    """The features that need only the row itself (used by batch and stream scoring)."""
    return (
        df.transform(calendar, time)
        .transform(amount_log)
        .transform(interactions)
        .transform(signal_score)
        .withColumn("is_zero_amount", (F.col(amount_column(df)) == 0).cast("int"))
    )
