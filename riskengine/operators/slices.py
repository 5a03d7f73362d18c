"""Evaluation by slice: the metric set of every amount band, hour and day, and of all rows, from one pass.

``GROUPING SETS`` over the slice columns count each distinct score once per slice with map-side combine; the score
curves of all slices are then accumulated together, slot by slot, and give areas and cells at the threshold alike.

Defined results: rows without a score or label are left out. A null slice value is a slice of its own, named null. A slice with one class
has areas of 0; an empty denominator gives 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.functions.columns import decision
from riskengine.operators import metrics as M
from riskengine.operators.ranking import running_totals

# --- fixed values: lower edges of the amount bands ---
BANDS = (0.0, 22.0, 100.0, 500.0)


def amount_band(amount: str = "Amount", edges: Sequence[float] = BANDS) -> Column:
    """Name of the band of an amount: "0-22", ..., "500+"; null for a null or negative amount."""
    a = F.col(amount)
    name: Column = F.when(a >= edges[-1], f"{edges[-1]:g}+")
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        name = name.when((a >= low) & (a < high), f"{low:g}-{high:g}")
    return name


def with_slices(scored: DataFrame, amount: str = "Amount", time: str = "ts") -> DataFrame:
    """Adds amount_band, hour and day (as text)."""
    return scored.withColumns({"amount_band": amount_band(amount), "hour": F.format_string("%02d", F.hour(time)), "day": F.to_date(time).cast("string")})


def evaluate_slices(
    scored: DataFrame,
    slices: Sequence[str] = ("amount_band", "hour", "day"),
    by: Sequence[str] = ("model_name",),
    threshold: float = 0.5,
    label: str = "label",
    score: str = "p",
    one_task_rows: int = 1_000_000,
) -> DataFrame:
    """One row per (by, slice_set, slice): samples, positives, areas, cells and rates. ``slice_set`` is the
    slice column's name, or "all"."""
    by, slices = list(by), list(slices)
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(*by, *slices, F.col(score).alias("_p"), F.col(label).cast("long").alias("_y"))
    keys = [F.col(c) for c in [*by, "_p"]]
    sets = [[*keys, F.col(s)] for s in slices] + [keys]
    counted = rows.groupingSets(sets, *keys, *[F.col(s) for s in slices]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos"), *[F.grouping(s).alias(f"_g_{s}") for s in slices]
    )
    which = reduce(lambda c, s: c.when(F.col(f"_g_{s}") == 0, s), slices[1:], F.when(F.col(f"_g_{slices[0]}") == 0, slices[0])).otherwise("all")
    value = F.when(F.col("slice_set") == "all", "all").otherwise(F.coalesce(*slices, F.lit("null")))
    curve = counted.withColumn("slice_set", which).withColumn("slice", value).select(*by, "slice_set", "slice", F.col("_p").alias(score), "n", "pos")
    keys = [*by, "slice_set", "slice"]
    curve = running_totals(curve, score, ["n", "pos"], by=keys, descending=True, one_task_rows=one_task_rows)
    hit = decision(score, threshold)
    found = M.curve_areas(
        curve,
        keys,
        digits=None,
        tp=F.sum(F.when(hit, F.col("pos")).otherwise(0)),
        fp=F.sum(F.when(hit, F.col("n") - F.col("pos")).otherwise(0)),
    )
    cells = found.withColumns({"fn": F.col("positives") - F.col("tp"), "tn": F.col("samples") - F.col("positives") - F.col("fp")})
    return M.rates(cells, None).select(*keys, "samples", "positives", "pr_auc", "average_precision", "roc_auc", "tn", "fp", "fn", "tp", *M.RATES)
