"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType


def count_if(cond: Column) -> Column:
    """Rows for which ``cond`` is true; unknown counts as false, empty input as 0."""
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` and 0 where there is nothing to divide by."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column: both mean "no value" in the source data."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    floating = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, (DoubleType, FloatType)) and (cols is None or f.name in cols)
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def content_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the JSON object with its keys in sorted order."""
    return F.sha2(F.to_json(F.struct(*sorted(cols))), 256)


def decision(probability: Column | str, threshold: float) -> Column:
    """One rule everywhere: flagged when ``p >= threshold``."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return p >= F.lit(float(threshold))


def row_order(df: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """A reproducible pseudo-random order key."""
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def outcome(predicted: Column, actual: Column, labels: Sequence[str]) -> Column:
    """Pick one of (tp, fp, fn, tn, other) labels from a decision and a label."""
    tp, fp, fn, tn, other = labels
    return (
        F.when(predicted & (actual == 1), tp)
        .when(predicted & (actual == 0), fp)
        .when(~predicted & (actual == 1), fn)
        .when(~predicted & (actual == 0), tn)
        .otherwise(other)
    )
