"""Point-in-time join: for every event the newest feature row of its key that is not after it.

Both sides are reduced to one cell per (key, time), with map-side combine. Time is cut into slots of equal numbers of cells;
within a (key, slot) the last feature is carried forward by a window, and what earlier slots hold is carried by
a table with one row per (key, slot). So no task holds a whole key, however crowded, and the events themselves are moved
once, to look up their cell; a cell with very many events is split by the adaptive skew join.

Defined results: feature rows without key or time are left out; events without key or time, and events before the first
feature row of their key, stay and get nulls. Of feature rows equal in key and time the one with the largest ``tie`` (by default
the largest values) counts. Equal events stay as often as they are. Columns of the events that clash
with feature names must be renamed by the caller (ValueError).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskengine.operators.ranking import ONE_TASK_ROWS, cut_slots


def asof_join(
    events: DataFrame,
    features: DataFrame,
    by: Sequence[str],
    time: str,
    feature_time: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """``events`` with ``feature_time`` and ``values`` of the newest feature row not after ``time``."""
    by, carried = list(by), [feature_time, *values]
    clash = set(carried) & set(events.columns)
    if clash:
        raise ValueError(f"events already have {sorted(clash)}")
    if feature_time in by:
        raise ValueError("the feature time cannot be a key")
    present = [F.col(c).isNotNull() for c in by]

    def filled(df: DataFrame, moment: str) -> DataFrame:
        for c in present:
            df = df.where(c)
        return df.where(F.col(moment).isNotNull())

    kept = filled(features, feature_time)
    order = F.struct(*[F.col(c) for c in [*(tie or values), feature_time]])
    newest = kept.groupBy(*by, F.col(feature_time).alias("_t")).agg(F.max_by(F.struct(*carried), order).alias("_f"))
    asked = filled(events, time).groupBy(*by, F.col(time).alias("_t")).agg(F.count(F.lit(1)).alias("_e"))
    none = F.lit(None).cast(newest.schema["_f"].dataType)
    cells = newest.withColumn("_e", F.lit(0).cast("long")).unionByName(asked.withColumn("_f", none))
    # a cell of both sides is one cell
    cells = cells.groupBy(*by, "_t").agg(F.max("_e").alias("_e"), F.max_by("_f", F.col("_f").isNotNull()).alias("_f"))
    cells = cut_slots(cells, "_t", one_task_rows=one_task_rows)
    inside = Window.partitionBy(*by, "_slot").orderBy("_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    seen = cells.withColumn("_here", F.last("_f", ignorenulls=True).over(inside))
    # one row per key and slot
    ends = cells.groupBy(*by, "_slot").agg(F.max_by("_f", F.when(F.col("_f").isNotNull(), F.col("_t"))).alias("_end"))
    ends = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    found = seen.where("_e > 0").join(ends, [*by, "_slot"]).select(*by, F.col("_t").alias("_time"), F.coalesce("_here", "_carry").alias("_found"))
    found = found.withColumnsRenamed({c: f"_k_{c}" for c in by})
    same = F.col(time) == F.col("_time")
    for c in by:
        same = same & (F.col(c) == F.col(f"_k_{c}"))
    return events.join(found, same, "left").select(*events.columns, *[F.col("_found")[c].alias(c) for c in carried])
