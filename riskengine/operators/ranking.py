"""Global order without a single task.

A window without ``partitionBy`` sends every row to one task. The functions here
replace it: rows are first reduced to distinct values (map-side combine), the
distinct values are cut into equi-depth slots, each slot is summed on its own and
the slot totals (at most one row per slot) carry the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: up to this many rows one sorted task is cheap, so no slots are cut
ONE_TASK_ROWS = 1_000_000

_BEFORE = (Window.unboundedPreceding, -1)


def slot_splits(
    df: DataFrame, order: str, one_task_rows: int = ONE_TASK_ROWS, at_most: int | None = None
) -> list[float]:
    """Cut points that split the rows evenly along ``order``; none when one task is enough.
    ``at_most``: a row count the caller already knows not to be exceeded."""
    if at_most is not None and at_most <= one_task_rows:
        return []
    slots = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probs = [i / slots for i in range(1, slots)]
    rows, cuts = df.agg(F.count(order), F.percentile_approx(F.col(order).cast("double"), probs, 10_000)).first()
    return [] if rows <= one_task_rows else sorted(set(cuts))


def with_slots(df: DataFrame, order: str, splits: Sequence[float], out: str = "_slot") -> DataFrame:
    """Add a slot number that never decreases with ``order``. The cut points are literals,
    so a retried task, or another plan, gets the same slots."""
    if not splits:
        return df.withColumn(out, F.lit(0))
    edges = [-float("inf"), *splits, float("inf")]
    return (
        Bucketizer(splits=edges, inputCol="_slot_key", outputCol="_slot_no", handleInvalid="keep")
        .transform(df.withColumn("_slot_key", F.col(order).cast("double")))
        .withColumn(out, F.col("_slot_no").cast("int"))
        .drop("_slot_key", "_slot_no")
    )


def cut_slots(
    df: DataFrame, order: str, out: str = "_slot", one_task_rows: int = ONE_TASK_ROWS, at_most: int | None = None
) -> DataFrame:
    return with_slots(df, order, slot_splits(df, order, one_task_rows, at_most), out)


def running_totals(
    df: DataFrame,
    order: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    one_task_rows: int = ONE_TASK_ROWS,
    at_most: int | None = None,
) -> DataFrame:
    """Add ``before_<m>``: the sum of ``m`` over rows ordered strictly before this one.

    ``df`` must hold one row per (``by``, ``order``): aggregate first, then call. The
    ``by`` columns must not be null.
    """
    by = list(by)
    ranked = df.withColumn("_ord", F.negative(order) if descending else F.col(order))
    slotted = cut_slots(ranked, "_ord", one_task_rows=one_task_rows, at_most=at_most)
    within = Window.partitionBy(*by, "_slot").orderBy("_ord").rowsBetween(*_BEFORE)
    across = Window.partitionBy(*by).orderBy("_slot").rowsBetween(*_BEFORE)

    def zero(m: str) -> Column:
        return F.lit(0).cast(df.schema[m].dataType)

    local = slotted.withColumns(
        {f"before_{m}": F.coalesce(F.sum(m).over(within), zero(m)) for m in measures}
    )
    offsets = (
        slotted.groupBy(*by, "_slot")
        .agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
        .select(
            *[F.col(c).alias(f"_o_{c}") for c in [*by, "_slot"]],
            *[F.coalesce(F.sum(f"_t_{m}").over(across), zero(m)).alias(f"_off_{m}") for m in measures],
        )
    )
    # plain equality keeps the partitioning of the window
    same = reduce(Column.__and__, [F.col(c) == F.col(f"_o_{c}") for c in [*by, "_slot"]])
    joined = local.join(offsets, same, "left")
    return joined.withColumns(
        {f"before_{m}": F.col(f"before_{m}") + F.col(f"_off_{m}") for m in measures}
    ).select(*df.columns, *[f"before_{m}" for m in measures])


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def rows_at_ranks(
    df: DataFrame, order: Sequence[str], ranks: Sequence[int], at_most: int | None = None
) -> list[tuple]:
    """Order-key values of the rows at the given 1-based ranks.

    The rank is resolved one key column at a time: count per distinct value, find
    the value that holds the rank, keep only that value's rows, go on with the next
    column. Only ``len(ranks)`` rows ever reach the driver and no row is moved except
    as a count. Stops early when a value holds a single row.
    """
    spark = df.sparkSession
    # one entry per rank: position in the output, rank inside the current candidates, keys so far
    open_ranks = [(i, int(r), ()) for i, r in enumerate(ranks)]
    done: dict[int, tuple] = {}
    for depth, col in enumerate(order):
        if not open_ranks:
            break
        keys = list(order[:depth])
        rows = df
        if keys:
            chosen = sorted({t[2] for t in open_ranks})
            wanted = reduce(
                Column.__or__,
                [reduce(Column.__and__, [F.col(k) == F.lit(v) for k, v in zip(keys, vals)]) for vals in chosen],
            )
            rows = df.where(wanted)
        totals = running_totals(value_counts(rows, col, keys), col, ["n"], by=keys, at_most=at_most)
        hits = [
            reduce(
                Column.__and__,
                [F.col(k) == F.lit(v) for k, v in zip(keys, vals)],
                (F.col("before_n") < r) & (F.col("before_n") + F.col("n") >= r),
            )
            for _, r, vals in open_ranks
        ]
        found = totals.where(reduce(Column.__or__, hits)).collect()
        following = []
        for i, r, vals in open_ranks:
            hit = next(
                h
                for h in found
                if tuple(h[k] for k in keys) == vals and h["before_n"] < r <= h["before_n"] + h["n"]
            )
            reached = (*vals, hit[col])
            # the last row of a value needs no further key: "<= value" already says it
            if hit["n"] == r - hit["before_n"] or depth == len(order) - 1:
                done[i] = reached
            else:
                following.append((i, r - hit["before_n"], reached))
        open_ranks = following
    return [done[i] for i in range(len(ranks))]


def after(order: Sequence[str], bound: Sequence) -> Column:
    """Row lies strictly after ``bound`` in the lexicographic order; a bound shorter
    than the order stands for the last row with those leading values."""
    beyond, equal = F.lit(False), F.lit(True)
    for name, value in zip(order, bound):
        beyond = beyond | (equal & (F.col(name) > F.lit(value)))
        equal = equal & (F.col(name) == F.lit(value))
    return beyond


def decile_bounds(
    df: DataFrame, order: Sequence[str], buckets: int = 10, rows: int | None = None
) -> list[tuple]:
    """Last row of each of the first ``buckets - 1`` quantile buckets of the rank."""
    n = df.count() if rows is None else rows
    if n < 2:
        return []
    # rank r (1-based) falls in bucket 1 + floor((r - 1) * k / (n - 1)), edges closed on the right
    last = [(b * (n - 1)) // buckets + 1 for b in range(1, buckets)]
    return rows_at_ranks(df, order, last, at_most=n)


def quantile_bucket(
    df: DataFrame, order: Sequence[str], out: str, buckets: int = 10, bounds: list[tuple] | None = None
) -> DataFrame:
    """Equal-count bucket of the first-come rank, 1-based. The nine bounds are literals,
    so no row is shuffled."""
    if bounds is None:
        bounds = decile_bounds(df, order, buckets)
    bucket = F.lit(1)
    for bound in bounds:
        bucket = bucket + after(order, bound).cast("int")
    return df.withColumn(out, bucket)


def percentile_rank(
    df: DataFrame, value: str, out: str, at_most: int | None = None, counts_from: DataFrame | None = None
) -> DataFrame:
    """Average rank divided by the row count (ties share the mean of their ranks).
    ``counts_from``: the same rows from a plan that is cheaper to read twice.

    The lookup holds one row per distinct value; a value shared by very many rows is
    split by the adaptive skew join, because nothing after it needs the partitioning."""
    source = df if counts_from is None else counts_from
    counts = value_counts(source.where(F.col(value).isNotNull()), value)
    table = running_totals(counts, value, ["n"], at_most=at_most)
    total = counts.agg(F.sum("n").alias("_all"))
    lookup = table.crossJoin(F.broadcast(total)).select(
        F.col(value).alias("_v"),
        ((F.col("before_n") + (F.col("n") + 1) / F.lit(2)) / F.col("_all")).alias(out),
    )
    return df.join(lookup, F.col(value) == F.col("_v"), "left").drop("_v")
