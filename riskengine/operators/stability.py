"""Has a feature moved? Population stability index and two-sample Kolmogorov-Smirnov distance, all columns at once.

Values are counted per (feature, value, side) with map-side combine and stored once. Both figures come from
these counts: bins are sums of them between literal edges, and the distance of the two distribution functions is taken from
running totals over equi-depth slots with carried offsets, so no feature is sorted in one task.

Defined results: nulls and NaN are left out and counted in no share. A bin that one side lacks has the share ``FLOOR``. A feature without
values on a side has null figures. Infinite values are values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.operators.quantiles import quantiles
from riskengine.operators.ranking import ONE_TASK_ROWS, running_totals
from riskengine.session import scratch_path

BINS = 10
FLOOR = 1e-4
#: the index above which a feature counts as moved
MOVED = 0.2


def side_counts(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, n_reference, n_current), one row per feature and distinct value, stored."""
    def long(df: DataFrame, side: str) -> DataFrame:
        pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols]))
        return df.select(pairs).where("value is not null and not isnan(value)").withColumn("side", F.lit(side))

    both = long(reference, "r").unionByName(long(current, "c"))
    # -0.0 and 0.0 are one value
    counts = both.groupBy("feature", (F.col("value") + F.lit(0.0)).alias("value")).agg(
        F.count_if(F.col("side") == "r").alias("n_reference"), F.count_if(F.col("side") == "c").alias("n_current")
    )
    path = scratch_path(reference.sparkSession, "stability")
    counts.write.parquet(path)
    return reference.sparkSession.read.schema(counts.schema).parquet(path)


def stability(
    reference: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = BINS, digits: int = 9, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """One row per column: feature, n_reference, n_current, psi, ks, moved. Bins are the reference's quantiles,
    closed on the right; edges and values are compared at ``digits`` digits."""
    spark = reference.sparkSession
    counts = side_counts(reference, current, cols)
    found = quantiles(reference, cols, [i / bins for i in range(1, bins)])
    edges = spark.createDataFrame(
        [(c, [round(e, digits) for e in found[None, c] if e is not None]) for c in cols], "feature string, edges array<double>"
    )
    # one row per column
    known = counts.join(F.broadcast(edges), "feature")
    place = F.size(F.filter("edges", lambda e: e < F.round("value", digits)))
    binned = known.groupBy("feature", place.alias("bin")).agg(F.sum("n_reference").alias("r"), F.sum("n_current").alias("c"))
    totals = binned.groupBy("feature").agg(F.sum("r").alias("n_reference"), F.sum("c").alias("n_current"))
    share = {k: F.greatest(F.col(k) / F.col(n), F.lit(FLOOR)) for k, n in (("r", "n_reference"), ("c", "n_current"))}
    both = "n_reference > 0 and n_current > 0"
    index = (
        binned.join(F.broadcast(totals), "feature").where(both).groupBy("feature").agg(F.sum((share["c"] - share["r"]) * F.log(share["c"] / share["r"])).alias("psi"))
    )
    running = running_totals(counts, "value", ["n_reference", "n_current"], by=["feature"], one_task_rows=one_task_rows)
    upto = {n: (F.col(f"before_{n}") + F.col(n)) for n in ("n_reference", "n_current")}
    gaps = running.select("feature", *[c.alias(f"_{n}") for n, c in upto.items()]).join(F.broadcast(totals), "feature").where(both)
    distance = gaps.groupBy("feature").agg(F.max(F.abs(F.col("_n_reference") / F.col("n_reference") - F.col("_n_current") / F.col("n_current"))).alias("ks"))
    zero = F.lit(0).cast("long")
    return (
        edges.select("feature")
        .join(totals, "feature", "left")
        .join(index, "feature", "left")
        .join(distance, "feature", "left")
        .select("feature", F.coalesce("n_reference", zero).alias("n_reference"), F.coalesce("n_current", zero).alias("n_current"), "psi", "ks", (F.col("psi") > MOVED).alias("moved"))
    )
