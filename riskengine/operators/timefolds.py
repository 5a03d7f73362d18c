"""Expanding-window cross-validation on a time line, with a purge gap and labels that arrive late.

Fold i trains on everything before ``train_end`` and tests on the window after it. Between the two lies the gap, and a
training row counts only with the label that was reported by ``test_start``: the newest report until then, not a
later correction. The plan is a handful of literals from the first and last time, so rows get their folds in one pass.

Defined results: rows without a time belong to no fold; a training row without a report by then is left out; a test row without
any report too. Rows at the last second belong to the last test window. Of reports at one time the largest id counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 3
START = 0.5


@dataclass(frozen=True)
class Fold:
    """Seconds: train is time < train_end, test is test_start <= time < test_end."""

    fold: int
    train_end: int
    test_start: int
    test_end: int


def plan_folds(df: DataFrame, time: str = "time_s", k: int = FOLDS, start: float = START, gap_s: int = 3600) -> list[Fold]:
    """``k`` equal test windows over the part of the time line after the share ``start``."""
    low, high = df.agg(F.min(time), F.max(time)).first()
    if low is None:
        return []
    begin = low + int((high - low) * start)
    edges = [begin + (high - begin) * i // k for i in range(k)] + [high + 1]
    return [Fold(i, edges[i] - gap_s, edges[i], edges[i + 1]) for i in range(k)]


def labels_at(reports: DataFrame, cuts: list[int], key: str, time: str, label: str, report_id: str) -> DataFrame:
    """(key, known: the label by each cut, final: the newest label), one row per key with map-side combine."""
    order = F.struct(F.col(time), F.col(report_id))
    by_then = [F.max_by(label, F.when(F.col(time) <= c, order)) for c in cuts]
    return reports.groupBy(key).agg(F.array(*by_then).alias("known"), F.max_by(label, order).alias("final"))


def assign_folds(
    df: DataFrame,
    plan: list[Fold],
    reports: DataFrame,
    key: str = "txn_id",
    time: str = "time_s",
    reported: str = "reported_s",
    label: str = "label",
    report_id: str = "report_id",
) -> DataFrame:
    """The rows once per fold and part they belong to: columns of ``df``, fold, part ("train" or "test"), ``label``."""
    if not plan:
        return df.select("*", F.lit(0).alias("fold"), F.lit("train").alias("part"), F.lit(0).alias(label)).where("false")
    known = labels_at(reports, [f.test_start for f in plan], key, reported, label, report_id)
    t = F.col(time)

    def entry(f: Fold, part: str, inside: Column, value: Column) -> Column:
        return F.when(inside & value.isNotNull(), F.struct(F.lit(f.fold).alias("fold"), F.lit(part).alias("part"), value.alias(label)))

    entries = []
    for i, f in enumerate(plan):
        entries.append(entry(f, "train", t < f.train_end, F.get("known", F.lit(i))))
        entries.append(entry(f, "test", (t >= f.test_start) & (t < f.test_end), F.col("final")))
    joined = df.join(known, key, "left")
    return joined.select(*df.columns, F.explode(F.array_compact(F.array(*entries))).alias("_e")).select(*df.columns, "_e.*")


def fold_table(plan: list[Fold], assigned: DataFrame, label: str = "label") -> DataFrame:
    """One row per fold: edges, rows and positives of both parts."""
    spark = assigned.sparkSession
    edges = spark.createDataFrame([(f.fold, f.train_end, f.test_start, f.test_end) for f in plan], "fold int, train_end long, test_start long, test_end long")

    def count(part: str, positive: bool) -> Column:
        hit = F.col("part") == part
        return F.count_if(hit & (F.col(label) == 1) if positive else hit)

    counts = assigned.groupBy("fold").agg(
        *[count(p, positive).alias(f"{p}_{'positives' if positive else 'rows'}") for p in ("train", "test") for positive in (False, True)]
    )
    return edges.join(counts, "fold", "left").fillna(0)


def backtest(assigned: DataFrame, plan: list[Fold], evaluate: Callable[[int, DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Fold by fold the result of ``evaluate(fold, train, test)`` with a column ``fold``."""
    out = None
    for f in plan:
        mine = assigned.where(F.col("fold") == f.fold)
        found = evaluate(f.fold, mine.where("part = 'train'"), mine.where("part = 'test'")).withColumn("fold", F.lit(f.fold))
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("there are no folds")
    return out
