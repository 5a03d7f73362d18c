"""Every row beside the next one in a global order, with one shuffle of the rows and no global sort in one task."""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.store import materialise

SLOT_BYTES = 16_000_000
MOST_SLOTS = 20_000
LOWEST = -(1 << 63)


def in_slots(docs: DataFrame) -> DataFrame:
    """(slot, seat, doc_id, th, text), dealt by slot and sorted by falling ``doc_id`` (null lowest, equal ids by text
    hash) within it. Slots are ranges of ``doc_id`` with about ``SLOT_BYTES`` of text, at most
    ``MOST_SLOTS``; an id (or null) that fills several slots is cut further by text hash. ``seat`` 0 marks a slot's own rows, 1 a copy of the first row of the next slot that
    has rows (after the last slot: of the first), which stands at its end."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = rows.select("*", F.coalesce("doc_id", F.lit(LOWEST)).alias("ord"), F.xxhash64("text").alias("th"))
    narrow = materialise(keyed.select("ord", "th", F.octet_length("text").alias("bytes")), "order")
    total, n = narrow.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    slots = int(min(MOST_SLOTS, max(1, (total or 0) // SLOT_BYTES), max(1, n)))
    cuts = narrow.agg(F.percentile_approx("ord", [k / slots for k in range(1, slots)], 20 * slots)).first()[0] if slots > 1 else []
    # an id that several cuts fall on gets as many slots by itself; double is exact for these
    crowded = {c: k + 1 for c, k in Counter(int(c) for c in cuts or []).items() if k > 1 and (abs(c) < 1 << 53 or c == LOWEST)}
    edges = [float("-inf"), *sorted({float(c) for c in cuts or []}), float("inf")]
    # the number of a slot falls with doc_id, so that slots follow each other in the order of the rows
    def slotted(df: DataFrame) -> DataFrame:
        if len(edges) == 2:
            return df.withColumn("slot", F.lit(0))
        put = Bucketizer(splits=edges, inputCol="_at", outputCol="_slot").transform(df.withColumn("_at", F.col("ord").cast("double")))
        base = (len(edges) - F.col("_slot")).cast("int")
        if crowded:
            # of a slot's rows those with a greater id come first, then the crowded id's by rising text hash
            parts = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in crowded.items() for x in pair]), F.col("ord"))
            share = (F.col("th").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
            base = base * (max(crowded.values()) + 1) + F.coalesce(1 + F.least(F.floor(share * parts), parts - 1), F.lit(0)).cast("int")
        return put.withColumn("slot", base.cast("int")).drop("_at", "_slot")

    # one row per slot
    tops = slotted(narrow).groupBy("slot").agg(F.max(F.struct("ord", (-F.col("th").cast("decimal(20,0)")).alias("t"), "th")).alias("top")).select("slot", "top.ord", "top.th").orderBy("slot").collect()
    before = [(tops[k - 1]["slot"], r["ord"], r["th"]) for k, r in enumerate(tops)]
    guests = docs.sparkSession.createDataFrame(before, "guest_slot int, ord long, th long")
    marked = slotted(keyed).join(F.broadcast(guests), ["ord", "th"], "left")
    seats = F.when(F.col("guest_slot").isNull(), F.array(F.struct(F.col("slot"), F.lit(0).alias("seat")))).otherwise(
        F.array(F.struct(F.col("slot"), F.lit(0).alias("seat")), F.struct(F.col("guest_slot").alias("slot"), F.lit(1).alias("seat")))
    )
    out = marked.select(F.explode(seats).alias("at"), "ord", "doc_id", "th", "text").select("at.slot", "at.seat", "ord", "doc_id", "th", "text")
    return out.repartition("slot").sortWithinPartitions(F.col("slot"), F.col("seat"), F.col("ord").desc(), F.col("th")).drop("ord")
