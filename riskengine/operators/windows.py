"""Trailing time windows over an ordered table.

The frame of row *i* is every row with ``t >= t_i - w`` that is not after row *i* in
(time, key) order: the lower bound is inclusive by value, the upper bound is the row
itself, so a later row with the same time is outside.

Plan shape. Whole rows are shuffled once, by time (and segment). Everything that
looks across time works on *cells*, one row per (segment, second), built with
map-side combine: a window partition then holds at most two window lengths of
seconds, however many rows share a second. A second that itself holds a huge share
of the rows is split into key slots whose totals are carried as offsets.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.operators.ranking import ONE_TASK_ROWS, slot_splits, with_slots

HOUR, DAY = 3600, 86400
_FIRST = Window.unboundedPreceding
_SUMS = ("n", "s", "q")


def centre_of(df: DataFrame, value: str) -> float:
    """A literal near the bulk of the values (their approximate median). Sums and squares of the distances
    from it keep the digits that those of the values themselves lose when amounts are large."""
    middle = df.agg(F.percentile_approx(F.col(value).cast("double"), 0.5, 1000)).first()[0]
    return float(middle) if middle is not None and math.isfinite(middle) else 0.0


def recentred(cells: DataFrame, centre: float) -> DataFrame:
    """Cells whose sums are distances from their own ``c``, as distances from ``centre``."""
    by = F.col("c") - F.lit(centre)
    return cells.withColumn("q", F.col("q") + 2 * by * F.col("s") + F.col("n") * by * by).withColumn("s", F.col("s") + F.col("n") * by).drop("c")


def time_cells(df: DataFrame, time: str, value: str, by: Sequence[str] = (), centre: float = 0.0) -> DataFrame:
    """Count, sum and sum of squares of the distances from ``centre`` per (segment, second)."""
    v = F.col(value).cast("double") - F.lit(centre)
    return df.groupBy(*by, time).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("q")
    )


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    # plain equality: a null-safe one hashes other expressions and would shuffle again
    return reduce(Column.__and__, [left[c] == right[c] for c in cols])


def _look_back(
    cells: DataFrame, totals: DataFrame, time: str, by: list[str], windows: Mapping[str, int], previous: bool
) -> DataFrame:
    """Per cell: sums over the earlier cells of every window and, on request, the time of
    the previous cell and the number of rows before this one.

    Time is cut into buckets as long as the widest window, and each cell is shown to its
    own bucket and to the next one, so no frame leaves its partition and one sort serves
    all windows. A window sum is a difference of two running sums. What lies further back
    than a bucket is carried by ``totals``, one row per (segment, bucket)."""
    shown = cells.withColumn("_bucket", F.explode(F.array(F.col("_home"), F.col("_home") + 1)))
    part = Window.partitionBy(*by, "_bucket").orderBy(time)
    earlier = part.rowsBetween(_FIRST, -1)

    def total(m, frame):
        return F.coalesce(F.sum(m).over(frame), F.lit(0).cast(cells.schema[m].dataType))

    made = [
        (total(m, earlier) - total(m, part.rangeBetween(_FIRST, -int(width) - 1))).alias(f"{m}_{tag}")
        for tag, width in windows.items()
        for m in _SUMS
    ]
    if previous:
        native = F.when(F.col("_bucket") == F.col("_home"), F.col("n"))
        made += [
            F.lag(time).over(part).alias("_prev"),
            F.coalesce(F.sum(native).over(earlier), F.lit(0)).alias("_rows"),
        ]
    kept = shown.select("*", *made).where(F.col("_bucket") == F.col("_home")).drop("_home")
    if not previous:
        return kept.drop("_bucket")
    # one row per segment and bucket: bounded by the time span, not by the number of rows
    across = Window.partitionBy(*by).orderBy("_bucket")
    carry = (
        totals.select(
            *by,
            "_bucket",
            F.lag("_last").over(across).alias("_carry_prev"),
            F.coalesce(F.sum("_n").over(across.rowsBetween(_FIRST, -1)), F.lit(0)).alias("_carry_rows"),
        )
        # spread again, so that the cells stay where their windows left them
        .repartition(*by, "_bucket")
    )
    return kept.join(carry, _same(kept, carry, [*by, "_bucket"]), "left").select(
        *[kept[c] for c in kept.columns if c not in ("_bucket", "_prev", "_rows")],
        F.coalesce(kept["_prev"], carry["_carry_prev"]).alias("prev_time"),
        (kept["_rows"] + carry["_carry_rows"]).alias("rows_before"),
    )


def measure(df: DataFrame, cell: Sequence[str] = ("time_s",)) -> tuple[int, int]:
    """(rows, rows of the fullest second): reads the time column only."""
    fill = df.groupBy(*cell).count()
    rows, fullest = fill.agg(F.sum("count"), F.max("count")).first()
    return rows or 0, fullest or 0


def _tie_splits(df: DataFrame, cell: list[str], key: str, split_ties: str | bool, tie_rows: int) -> list[float]:
    """Cuts of the unique key for a second too full for one task, else none. With them no
    (second, slot) holds more than a slot's even share of all rows."""
    if split_ties == "auto":
        split_ties = measure(df, cell)[1] > tie_rows
    return slot_splits(df, key, one_task_rows=0) if split_ties else []


def trailing_stats(
    df: DataFrame,
    windows: Mapping[str, int],
    *,
    time: str = "time_s",
    key: str | Sequence[str] = "txn_id",
    value: str = "Amount",
    by: Sequence[str] = (),
    centre: float | None = None,
    recency: str | None = None,
    position: str | None = None,
    history: DataFrame | None = None,
    cells_from: DataFrame | None = None,
    split_ties: str | bool = "auto",
    tie_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add ``count_<w>``, ``avg_<w>``, ``std_<w>`` (population) per window, optionally the
    seconds since the previous row and the 0-based row position in its segment.

    Times and segments must not be null (the validation gate sees to it).

    ``time`` is whole seconds; ``key``, one column or several, of which the first is a number, orders
    equal times. Sums run over distances from ``centre`` (by default found by :func:`centre_of`), so
    that deviations hold for large amounts too. ``history`` may hold earlier cells (as made by
    :func:`time_cells` with the same centre) that count but are not returned. ``cells_from``: the same rows from a plan that is cheaper to read
    than ``df``, which then runs once. ``split_ties``: "auto" measures the fullest second.
    """
    by = list(by)
    cell = [*by, time]
    keys = [key] if isinstance(key, str) else list(key)
    source = df if cells_from is None else cells_from
    if centre is None:
        centre = centre_of(source, value) if windows and history is None else 0.0
    splits = _tie_splits(source, cell, keys[0], split_ties, tie_rows)
    split_ties = bool(splits)
    rows = with_slots(df, keys[0], splits)

    own = time_cells(with_slots(source, keys[0], splits), time, value, [*by, "_slot"], centre)
    cells = own.groupBy(*cell).agg(*[F.sum(m).alias(m) for m in _SUMS]) if split_ties else own.drop("_slot")
    present = cells.select(*cell)
    home = F.floor(F.col(time) / F.lit(max(windows.values(), default=DAY)))
    bucket_rows = source.withColumn("n", F.lit(1).cast("long"))
    if history is not None:
        cells = (
            cells.unionByName(history.select(*cell, *_SUMS))
            .groupBy(*cell)
            .agg(*[F.sum(m).alias(m) for m in _SUMS])
        )
        bucket_rows = cells
    totals = bucket_rows.groupBy(*by, home.alias("_bucket")).agg(F.max(time).alias("_last"), F.sum("n").alias("_n"))
    cells = _look_back(cells.withColumn("_home", home), totals, time, by, windows, bool(recency or position))
    lookup = cells.drop(*_SUMS)
    if history is not None:
        lookup = lookup.join(present, _same(lookup, present, cell), "left_semi")

    if split_ties:
        earlier_slots = Window.partitionBy(*cell).orderBy("_slot").rowsBetween(_FIRST, -1)
        slots = own.select(
            *cell,
            "_slot",
            *[F.sum(m).over(earlier_slots).alias(f"_e_{m}") for m in _SUMS],
        )
        lookup = slots.join(lookup, _same(slots, lookup, cell), "left").select(
            *[slots[c] for c in slots.columns], *[lookup[c] for c in lookup.columns if c not in cell]
        )
    else:
        lookup = lookup.withColumn("_slot", F.lit(0)).withColumns(
            {f"_e_{m}": F.lit(0).cast("double" if m != "n" else "long") for m in _SUMS}
        )
    if history is not None:
        # rows of an earlier batch in the same second come before every row of this one
        past = history.select(*cell, *[F.col(m).alias(f"_h_{m}") for m in _SUMS])
        lookup = lookup.join(past, _same(lookup, past, cell), "left").select(
            *[lookup[c] for c in lookup.columns if not c.startswith("_e_")],
            *[
                (F.coalesce(lookup[f"_e_{m}"], F.lit(0)) + F.coalesce(past[f"_h_{m}"], F.lit(0))).alias(f"_e_{m}")
                for m in _SUMS
            ],
        )

    v = F.col(value).cast("double")
    far = v - F.lit(centre)
    in_second = Window.partitionBy(*cell, "_slot").orderBy(*keys).rowsBetween(_FIRST, 0)
    ranked = rows.select(
        "*",
        F.count(F.lit(1)).over(in_second).alias("_r_n"),
        F.sum(far).over(in_second).alias("_r_s"),
        F.sum(far * far).over(in_second).alias("_r_q"),
    )
    joined = ranked.join(lookup, _same(ranked, lookup, [*cell, "_slot"]), "left").select(
        *[ranked[c] for c in ranked.columns],
        *[lookup[c] for c in lookup.columns if c not in [*cell, "_slot"]],
    )

    tie = {m: F.coalesce(F.col(f"_e_{m}"), F.lit(0)) + F.col(f"_r_{m}") for m in _SUMS}
    made = []
    for tag in windows:
        n, s, q = (F.coalesce(F.col(f"{m}_{tag}"), F.lit(0)) + tie[m] for m in _SUMS)
        mean = s / n
        made += [
            n.cast("long").alias(f"count_{tag}"),
            F.when(n == 1, v).otherwise(F.lit(centre) + mean).alias(f"avg_{tag}"),
            # two sums subtract to a tiny negative now and then; one row has no spread
            F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), q / n - mean * mean)))
            .otherwise(F.lit(0.0))
            .alias(f"std_{tag}"),
        ]
    if recency:
        gap = F.when(tie["n"] > 1, F.lit(0)).otherwise(F.col(time) - F.col("prev_time"))
        made.append(F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)).cast("long").alias(recency))
    if position:
        made.append((F.col("rows_before") + tie["n"] - 1).cast("long").alias(position))
    return joined.select(*df.columns, *made)


def window_range(
    df: DataFrame,
    width: int,
    *,
    time: str = "time_s",
    key: str = "txn_id",
    value: str = "Amount",
    tag: str = "1h",
    split_ties: str | bool = "auto",
    tie_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Real range, position in range and skewness of the trailing window.

    Minimum and maximum cannot be subtracted, so they are taken over cells with a
    sliding frame, at most ``width`` cells long. Earlier slots and the row's own slot
    complete the row's own second.
    """
    v = F.col(value).cast("double")
    far = v - F.lit(centre_of(df, value))
    rows = with_slots(df, key, _tie_splits(df, [time], key, split_ties, tie_rows))
    power = {"n": F.lit(1), "s": far, "q": far * far, "c": far * far * far}
    own = rows.groupBy(time, "_slot").agg(
        *[F.sum(e).cast("double").alias(m) for m, e in power.items()], F.min(v).alias("lo"), F.max(v).alias("hi")
    )
    cells = own.groupBy(time).agg(
        *[F.sum(m).alias(m) for m in power], F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    shown = cells.withColumn("_home", F.floor(F.col(time) / F.lit(width))).withColumn(
        "_bucket", F.explode(F.array(F.col("_home"), F.col("_home") + 1))
    )

    def over(frame, prefix):
        return [
            *[F.coalesce(F.sum(m).over(frame), F.lit(0.0)).alias(f"{prefix}_{m}") for m in power],
            F.min("lo").over(frame).alias(f"{prefix}_lo"),
            F.max("hi").over(frame).alias(f"{prefix}_hi"),
        ]

    sliding = Window.partitionBy("_bucket").orderBy(time).rangeBetween(-width, -1)
    around = (
        shown.select(time, "_bucket", "_home", *over(sliding, "w"))
        .where(F.col("_bucket") == F.col("_home"))
        .drop("_bucket", "_home")
    )
    earlier = Window.partitionBy(time).orderBy("_slot").rowsBetween(_FIRST, -1)
    lookup = own.select(time, "_slot", *over(earlier, "e")).join(around, time, "left")

    here = Window.partitionBy(time, "_slot").orderBy(key).rowsBetween(_FIRST, 0)
    ranked = rows.select(
        "*",
        *[F.sum(e).over(here).cast("double").alias(f"r_{m}") for m, e in power.items()],
        F.min(v).over(here).alias("r_lo"),
        F.max(v).over(here).alias("r_hi"),
    )
    n, s, q, c = (F.col(f"w_{m}") + F.col(f"e_{m}") + F.col(f"r_{m}") for m in power)
    lo = F.least("w_lo", "e_lo", "r_lo")
    hi = F.greatest("w_hi", "e_hi", "r_hi")
    mean = s / n
    m2 = F.greatest(q / n - mean * mean, F.lit(0.0))
    m3 = c / n - 3 * mean * q / n + 2 * mean * mean * mean
    return ranked.join(lookup, [time, "_slot"], "left").select(
        *df.columns,
        (hi - lo).alias(f"amount_range_{tag}_true"),
        F.when(hi > lo, (v - lo) / (hi - lo)).otherwise(F.lit(0.5)).alias(f"amount_percentile_in_range_{tag}_true"),
        F.when((hi > lo) & (m2 > 0), m3 / F.pow(m2, F.lit(1.5))).otherwise(F.lit(0.0)).alias(f"amount_skew_{tag}_true"),
    )


def running_share(df: DataFrame, share: str, out: str, keys: Sequence[str]) -> DataFrame:
    """Cumulative share, largest first, of a table with one row per column name."""
    w = Window.orderBy(F.col(share).desc(), *keys).rowsBetween(_FIRST, 0)
    return df.withColumn(out, F.sum(share).over(w))
