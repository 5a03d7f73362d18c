"""Exact, linearly interpolated quantiles.

``percentile`` keeps every distinct value of a group in one task. That is right for
a table whose row count is known to be small; beyond it the order statistics are
bracketed with a sketch, and only the rows inside the brackets (about one row in
five thousand) are counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.operators.ranking import running_totals
from riskengine.session import scratch_path

ONE_TASK_ROWS = 2_000_000
_SKETCH = 10_000


def _numeric(df: DataFrame, name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: str | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
    rows: int | None = None,
) -> dict[tuple, list[float | None]]:
    """``{(group, column): [value per prob]}``; group is None without ``by``. Give ``rows``
    when the row count is already known."""
    narrow = df.select(*([by] if by else []), *[_numeric(df, c).alias(c) for c in cols])
    if (df.count() if rows is None else rows) <= one_task_rows:
        return _in_one_task(narrow, cols, probs, by)
    return _bracketed(narrow, cols, probs, by)


def _in_one_task(df, cols, probs, by):
    wanted = ", ".join(f"{p!r}D" for p in map(float, probs))
    exact = [F.expr(f"percentile(`{c}`, array({wanted})) AS `{c}`") for c in cols]
    grouped = df.groupBy(by) if by else df.groupBy()
    return {
        (row[by] if by else None, c): list(row[c]) if row[c] is not None else [None] * len(probs)
        for row in grouped.agg(*exact).collect()
        for c in cols
    }


def _bracketed(df, cols, probs, by):
    slack = 2.0 / _SKETCH
    edges = [e for p in probs for e in (max(0.0, p - slack), min(1.0, p + slack))]
    grouped = df.groupBy(by) if by else df.groupBy()
    sketch = grouped.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.percentile_approx(c, edges, _SKETCH).alias(f"q_{i}") for i, c in enumerate(cols)],
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)],
    ).collect()

    brackets, result = [], {}
    for row in sketch:
        group = row[by] if by else None
        for i, c in enumerate(cols):
            n = row[f"n_{i}"]
            result[(group, c)] = [None] * len(probs)
            if not n:
                continue
            for k, p in enumerate(probs):
                # a sketch edge may be off by n / _SKETCH ranks: too coarse for a small group
                coarse = n <= 4 / slack
                lo = row[f"lo_{i}"] if coarse or p - slack <= 0 else row[f"q_{i}"][2 * k]
                hi = row[f"hi_{i}"] if coarse or p + slack >= 1 else row[f"q_{i}"][2 * k + 1]
                brackets.append((group, c, k, n, p * (n - 1), lo, hi))
    if not brackets:
        return result

    counted = _inside(df, cols, by, brackets)
    below = dict.fromkeys(range(len(brackets)), 0) | {r["bracket"]: r["n"] for r in counted.where("v is null").collect()}
    ranked = running_totals(counted.where("v is not null"), "v", ["n"], by=["bracket"])
    wanted = {}
    for j, (_, _, _, _, pos, _, _) in enumerate(brackets):
        wanted[j] = (math.floor(pos) - below[j], math.ceil(pos) - below[j])
    ranks = sorted({(j, r) for j, pair in wanted.items() for r in pair})
    # two rows per bracket; a condition with a term for each would be too deep for the planner
    asked = F.broadcast(df.sparkSession.createDataFrame(ranks, "_bracket int, _rank long"))
    reached = (F.col("bracket") == F.col("_bracket")) & (F.col("before_n") <= F.col("_rank")) & (F.col("before_n") + F.col("n") > F.col("_rank"))
    found = {(r["bracket"], r["_rank"]): r["v"] for r in ranked.join(asked, reached).select("bracket", "_rank", "v").collect()}
    for j, (g, c, k, _, pos, _, _) in enumerate(brackets):
        low, high = (found[j, r] for r in wanted[j])
        frac = pos - math.floor(pos)
        result[(g, c)][k] = low + (high - low) * frac
    return result


def _inside(df, cols, by, brackets):
    """(bracket, v, n), stored: how often a value inside a bracket occurs; the row whose ``v`` is null has the number of values
    below the bracket. One pass over the rows for all brackets."""
    groups = {g: i for i, g in enumerate(dict.fromkeys(b[0] for b in brackets))}
    places = {c: i for i, c in enumerate(cols)}
    plan = [(j, groups[g], places[c], lo, hi) for j, (g, c, _, _, _, lo, hi) in enumerate(brackets)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = np.zeros(len(plan), dtype=np.int64)
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            values = [batch.column(i + 1).cast("double").to_numpy(zero_copy_only=False) for i in range(len(places))]
            names, seen, often = [], [], []
            for j, g, place, lo, hi in plan:
                v = values[place] if len(groups) == 1 and (group == g).all() else values[place][group == g]
                # a null is NaN here, which is neither below nor inside
                below[j] += np.count_nonzero(v < lo)
                distinct, n = np.unique(v[(v >= lo) & (v <= hi)], return_counts=True)
                names.append(np.full(len(distinct), j, dtype=np.int32))
                seen.append(distinct)
                often.append(n.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (names, seen, often)], ["bracket", "v", "n"])
        nothing = pa.nulls(len(plan), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(plan), dtype=np.int32)), nothing, pa.array(below)], ["bracket", "v", "n"])

    number = F.lit(0)
    if by:
        number = F.lit(-1)
        for g, i in groups.items():
            number = F.when(F.col(by).eqNullSafe(F.lit(g)), i).otherwise(number)
    rows = df.select(number.cast("int").alias("_group"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(cols)])
    counts = rows.mapInArrow(count, "bracket int, v double, n long").groupBy("bracket", "v").agg(F.sum("n").alias("n"))
    path = scratch_path(df.sparkSession, "quantiles")
    counts.write.parquet(path)
    return df.sparkSession.read.schema(counts.schema).parquet(path)
