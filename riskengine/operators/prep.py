"""Cleaning, scaling, splitting and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskengine.functions.columns import row_order
from riskengine.operators.quality import repair_negative_amounts, require_no_nulls
from riskengine.operators.quantiles import quantiles

SCALER_FIELDS = StructType(
    [StructField("column", StringType()), StructField("center", DoubleType()), StructField("scale", DoubleType())]
)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key. An aggregate instead of a row number: a key with
    a third of all rows is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "standard") -> DataFrame:
    """Center and scale per column: mean and population deviation, median and quartile
    distance, or minimum and range. A constant column keeps scale 1."""
    if kind == "standard":
        row = df.agg(
            *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
        ).first()
        found = [(c, row[f"m_{c}"], row[f"s_{c}"]) for c in cols]
    elif kind == "robust":
        cuts = quantiles(df, cols, [0.25, 0.5, 0.75])
        found = [(c, cuts[(None, c)][1], cuts[(None, c)][2] - cuts[(None, c)][0]) for c in cols]
    elif kind == "minmax":
        row = df.agg(*[F.min(c).alias(f"l_{c}") for c in cols], *[F.max(c).alias(f"h_{c}") for c in cols]).first()
        found = [(c, row[f"l_{c}"], row[f"h_{c}"] - row[f"l_{c}"]) for c in cols]
    else:
        raise ValueError(f"unknown scaler '{kind}'")
    return df.sparkSession.createDataFrame([(c, float(m), float(s) or 1.0) for c, m, s in found], SCALER_FIELDS)


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Scale and keep the originals as ``<column>_raw``. The scaler has one row per
    column, so its numbers enter the plan as literals."""
    params = {r["column"]: (r["center"], r["scale"]) for r in scaler.collect()}
    kept = {f"{c}_raw": F.col(c) for c in params if f"{c}_raw" not in df.columns}
    return df.withColumns(kept).withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()}
    )


def log_amount(df: DataFrame) -> DataFrame:
    """log(1 + scaled amount). Named apart from ``amount_log`` because column names are
    case-insensitive; where the scaled amount is -1 or less there is no logarithm."""
    a = F.col("Amount")
    return df.withColumn("amount_log_scaled", F.when(a > -1, F.log1p(a)))


def preprocess(
    df: DataFrame,
    scaler: DataFrame | None = None,
    kind: str = "standard",
    cols: Sequence[str] = ("Amount", "Time"),
    remove_duplicates: bool = True,
    log_transform: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Null gate, duplicate removal, negative repair, scaling, log. Give a fitted scaler
    to treat another split the same way."""
    require_no_nulls(df)
    clean = repair_negative_amounts(drop_duplicate_rows(df) if remove_duplicates else df)
    if scaler is None:
        scaler = fit_scaler(clean, cols, kind)
    scaled = apply_scaler(clean, scaler)
    return (log_amount(scaled) if log_transform else scaled), scaler


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "median") -> DataFrame:
    """Fill missing values with the column's median, mean or zero."""
    if strategy == "zero":
        fill = {c: 0.0 for c in cols}
    elif strategy == "mean":
        row = df.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in cols]).first()
        fill = {c: row[c] for c in cols}
    elif strategy == "median":
        cuts = quantiles(df, cols, [0.5])
        fill = {c: cuts[(None, c)][0] for c in cols}
    else:
        raise ValueError(f"unknown strategy '{strategy}'")
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in cols}).fillna(
        {c: v for c, v in fill.items() if v is not None}
    )


def time_column(df: DataFrame) -> str:
    """Raw seconds if present, else the plain column; otherwise an error."""
    for name in ("Time_raw", "time_s", "Time"):
        if name in df.columns:
            return name
    raise ValueError(f"no time column among {df.columns}")


def split_point(df: DataFrame, ratio: float = 0.80, time: str = "time_s") -> float:
    low, high = df.agg(F.min(time), F.max(time)).first()
    if low is None:
        raise ValueError("nothing to split")
    return low + ratio * (high - low)


def chronological_split(
    df: DataFrame, ratio: float = 0.80, time: str = "time_s"
) -> tuple[DataFrame, DataFrame, float]:
    """Split at a share of the time range, boundary in train. Both sides are filters on
    the time column, so they reach the scan; the last row is never in train."""
    if time not in df.columns:
        raise ValueError(f"time column '{time}' not found in {df.columns}")
    at = split_point(df, ratio, time)
    train, test = df.where(F.col(time) <= F.lit(at)), df.where(F.col(time) > F.lit(at))
    for name, side in (("training", train), ("test", test)):
        if side.isEmpty():
            raise ValueError(f"{name} set is empty")
    return train, test, at


def hash_sample(
    df: DataFrame, n: int, keys: Sequence[str] = ("txn_id",), seed: int = 42, rows: int | None = None
) -> DataFrame:
    """The ``n`` rows that come first in a seeded hash order: the same rows on every run.
    A sampling operator: ``n`` is its purpose and a constant.

    Hash values are uniform, so all but about 1.5 n + 1000 rows are filtered out in the
    scan before anything is ordered. Repeated keys can upset that: the filter is only used if
    it leaves enough rows."""
    hashed = df.withColumn("_h", row_order(df, keys, seed))
    rows = df.count() if rows is None else rows
    keep = 1.5 * n + 1000
    if rows > 2 * keep:
        near = hashed.where(F.col("_h") <= F.lit(int(-(2**63) + keep / rows * 2**64)))
        if near.limit(n).count() == n:
            hashed = near
    return hashed.orderBy("_h", *keys).limit(n).drop("_h")
