"""Velocity on streams: sliding windows per card and exact per-event windows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.operators.views import performance_measures
from riskengine.operators.windows import recentred, time_cells, trailing_stats
from riskengine.session import scratch_root


def sliding_velocity(
    events: DataFrame, width: str, slide: str, delay: str = "10 minutes", time: str = "ts", key: str = "card_id"
) -> DataFrame:
    """Count and mean amount per card and sliding window. Partial aggregates are combined
    before the shuffle, so a busy card costs one row per task and window."""
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, width, slide), key)
        .agg(F.count(F.lit(1)).alias("txn_count"), F.avg("Amount").alias("avg_amount"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "txn_count", "avg_amount")
    )


def daily_performance(scored: DataFrame, delay: str = "1 hour", time: str = "ts") -> DataFrame:
    """Tumbling day per model over a stream with is_fraud, true_label, fraud_probability,
    inference_time_ms and amount; a day is emitted when the watermark has passed it."""
    return (
        scored.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day"), "model_name")
        .agg(*performance_measures(F.col("is_fraud"), F.col("true_label")))
        .withColumn("transaction_date", F.to_date("window.start"))
        .drop("window")
    )


def late_labels(
    predictions: DataFrame, feedback: DataFrame, within: str = "3 days", delay: str = "1 hour"
) -> DataFrame:
    """Predictions with the label that arrives up to ``within`` later; a prediction
    without one comes out with a null label once its time is over."""
    p = predictions.withWatermark("created_at", delay).alias("p")
    g = feedback.select(
        F.col("transaction_id").alias("labelled_id"), "true_label", "feedback_source", "reported_at"
    ).withWatermark("reported_at", delay)
    matched = (
        (F.col("p.transaction_id") == F.col("labelled_id"))
        & (F.col("reported_at") >= F.col("created_at"))
        & (F.col("reported_at") <= F.col("created_at") + F.expr(f"INTERVAL {within}"))
    )
    return p.join(g, matched, "leftOuter").drop("labelled_id")


class _Deltas:
    """A table kept as one folder per micro-batch, and now and then one folder with all before it. A
    batch reads the newest whole folder and the deltas after it, at most ``every`` of them."""

    def __init__(self, spark, base: str, schema: str, every: int = 16):
        self.spark, self.base, self.schema, self.every = spark, base, schema, every
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _there(self, folder: str) -> bool:
        return self._fs.exists(self._path(f"{folder}/_SUCCESS"))

    def before(self, batch_id: int) -> DataFrame | None:
        whole = (batch_id - 1) // self.every * self.every
        folders = [f"{self.base}/delta-{i}" for i in range(whole, batch_id)]
        if whole and self._there(f"{self.base}/whole-{whole}"):
            folders.append(f"{self.base}/whole-{whole}")
        elif whole:
            folders = [f"{self.base}/delta-{i}" for i in range(batch_id)]
        found = [f for f in folders if self._there(f)]
        return self.spark.read.schema(self.schema).parquet(*found) if found else None

    def add(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.base}/delta-{batch_id}")

    def compact(self, batch_id: int, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Merge what was stored before a batch whose turn it is."""
        if batch_id and batch_id % self.every == 0 and not self._there(f"{self.base}/whole-{batch_id}"):
            old = self.before(batch_id)
            if old is not None:
                merge(old).write.mode("overwrite").parquet(f"{self.base}/whole-{batch_id}")


def exact_velocity(
    out: str,
    cells: str,
    windows: Mapping[str, int],
    by: Sequence[str] = ("card_id",),
    recency: str | None = "time_since_last_txn",
    compact_every: int = 16,
) -> Callable[[DataFrame, int], None]:
    """Batch writer giving every event its trailing windows, final at arrival.

    History is a table of cells (card, second), of which a batch reads the seconds that its windows
    reach, and a table with the time when each card was last seen, however long ago. Both are kept as
    deltas per batch and merged now and then. The windows themselves are the batch operator, so a
    busy card or second is split the same way. A repeated batch ignores what it wrote
    before and overwrites it; empty batches write nothing. An event that comes later than the widest
    window may miss an older predecessor of its card in its recency."""
    by = list(by)
    reach = max(windows.values(), default=0)
    columns = [*by, "time_s"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keys = ", ".join(f"{c} {batch.schema[c].dataType.simpleString()}" for c in by)
        past = _Deltas(spark, f"{cells}/cells", f"{keys}, time_s long, n long, s double, q double, c double", compact_every)
        seen = _Deltas(spark, f"{cells}/seen", f"{keys}, time_s long", compact_every)
        batch = batch.persist()
        try:
            low, centre = batch.agg(F.min("time_s"), F.percentile_approx(F.col("Amount").cast("double"), 0.5, 1000)).first()
            if low is None:
                return
            centre = float(centre) if centre is not None else 0.0
            history = None
            merge = lambda df: recentred(df, centre).groupBy(*columns).agg(*[F.sum(m).alias(m) for m in ("n", "s", "q")]).withColumn("c", F.lit(centre))
            last = lambda df: df.groupBy(*by).agg(F.max("time_s").alias("time_s"))
            past.compact(batch_id, merge)
            seen.compact(batch_id, last)
            stored, known = past.before(batch_id), seen.before(batch_id)
            if stored is not None:
                near = recentred(stored.where(F.col("time_s") >= low - reach), centre)
                if recency and known is not None:
                    # a cell without rows marks when a card was last seen
                    marks = last(known.join(batch.select(*by).distinct(), by, "left_semi"))
                    near = near.unionByName(marks.select(*columns, F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q")))
                history = near.groupBy(*columns).agg(*[F.sum(m).alias(m) for m in ("n", "s", "q")])
            trailing_stats(batch, windows, by=by, recency=recency, history=history, centre=centre).write.mode("overwrite").parquet(
                f"{out}/batch_id={batch_id}"
            )
            past.add(time_cells(batch, "time_s", "Amount", by, centre).withColumn("c", F.lit(centre)), batch_id)
            seen.add(last(batch), batch_id)
        finally:
            batch.unpersist()

    return write


def scratch_paths(spark, *names: str) -> list[str]:
    from uuid import uuid4

    base = f"{scratch_root(spark)}/stream-{uuid4().hex[:12]}"
    return [f"{base}/{n}" for n in names]
