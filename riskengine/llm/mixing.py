"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. A document's inclusion is its expected number of copies: its
source's rate times its own preference, at most ``most``. The whole part of it is certain. The rest is
an inclusion probability p, and documents are ranked by Pareto's ratio u (1 - p) / ((1 - u) p), u being a uniform
number from a keyed hash of the document's id; they are taken in this order until the words left to
the source are filled (the size of the sample is fixed in words). The document at the edge is taken if that brings the sum nearer.

Ranking needs no sort of a whole source: the ratios' words are summed in a fixed number of bins per
source, the bin at the edge is found from these sums, and only its rows are ordered.

Defined results: a null text has size 0, a document of size 0 is never drawn beyond its certain copies and
counts no words; a null source is a source of its own, last in order. A row without an id is
named by its text. Repeated rows have one ratio and follow each other: the last ones of a group of equal
rows may be left out, so that the sum stays near the target. An empty table gives an empty table. Other columns, also ones named like those
used here, pass untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.store import materialise

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BINS = 1 << 13
PIECE = 1000
UNITS = float(1 << 52)


def word_count(text: str = "text") -> Column:
    """Number of words between the six ASCII white-space characters; null: 0."""
    return F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) -> the same with target: ``share`` of all words by weight, a source's part
    at most ``most`` times its size, the excess shared again by weight until none is above.

    With r = most * size / weight, sources are capped in the order of r. The words per weight left to the
    others rise with each source that is rightly capped and fall with each that is not, so the common level is the
    highest of them. One row per source is ordered here."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    numbered = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("w", F.element_at(cycle, (F.col("k") % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "k").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        numbered.withColumn("total", share * F.sum("source_size").over(everything))
        .withColumn("weight", F.sum("w").over(everything))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("before")) / (F.col("weight") - F.col("gone")))
        .withColumn("level", F.max("level").over(everything))
    )
    return levels.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def _small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df``, one stored row per source, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def uniform(doc_id: str, seed: int) -> Column:
    """A number in (0, 1) from the document's id; the same in every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(doc_id)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / UNITS


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, preference: Column | None = None, seed: int = 7) -> DataFrame:
    """(row, size, source_size, target, copies): the input row as a struct, its words, its source's words
    and target, and how many times the mix takes it (0 to ``most``).

    ``preference``: a positive column that scales a document's inclusion odds within its source (null:
    1); inclusions stop at ``most``. Rates are scaled so that the source's expected words are its target
    wherever no document is capped."""
    liking = F.lit(1.0) if preference is None else F.coalesce(preference.cast("double"), F.lit(1.0))
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))).alias("id"), word_count().alias("size"), liking.alias("liking"), F.xxhash64(F.struct("*").cast("string")).alias("same"))
    narrow = materialise(rows.select("source", "id", "size", "liking", "same"), "mix-sizes")
    sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("liking")).alias("liked"))
    targets = source_targets(sums.select("source", "source_size"), weights, share, most)
    # one row per source
    plan = materialise(targets.join(sums.select(F.col("source").alias("s"), "liked"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-targets")

    def judged(df: DataFrame) -> DataFrame:
        """Certain copies, inclusion probability and ratio of each row."""
        own = plan.select(F.col("source").alias("s"), "source_size", "target", "liked")
        joined = df.join(_small(own), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        expected = F.least(F.lit(most), F.when(F.col("liked") > 0, F.col("target") * F.col("liking") / F.col("liked")).otherwise(0.0))
        u = uniform("id", seed)
        return (
            joined.withColumn("expected", expected)
            .withColumn("certain", F.floor("expected"))
            .withColumn("p", F.col("expected") - F.col("certain"))
            .withColumn("ratio", F.when((F.col("p") > 0) & (F.col("size") > 0), u * (1 - F.col("p")) / ((1 - u) * F.col("p"))))
            .withColumn("bin", F.floor(BINS * (F.col("ratio") / (1 + F.col("ratio")))).cast("int"))
        )

    marked = judged(narrow)
    # words per source and bin: at most BINS rows a source
    bins = marked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.sum(F.col("certain") * F.col("size")).alias("sure"), F.first("target").alias("target"))
    upto = Window.partitionBy("source").orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("source")
    drawn = F.when(F.col("bin").isNotNull(), F.col("words")).otherwise(0)
    edges = (
        bins.withColumn("left", F.col("target") - F.sum("sure").over(whole))
        .withColumn("after", F.sum(drawn).over(upto))
        .withColumn("before", F.col("after") - drawn)
        .withColumn("here", F.expr("bin is not null and before < left and after >= left"))
        .groupBy("source")
        .agg(F.min(F.when(F.col("here"), F.struct("bin", "before"))).alias("e"), F.min("left").alias("left"))
        # a source without an edge is drawn whole, or not at all where nothing is left to draw
        .select("source", F.coalesce("e.bin", F.when(F.col("left") > 0, BINS + 1).otherwise(-1)).alias("edge"), F.col("e.before").alias("before"), "left")
    )
    edges = materialise(edges, "mix-edges")
    ends = _small(edges.select(F.col("source").alias("s"), "edge", "before", "left"))
    place = ("ratio", "id", "size", "same")
    in_order = Window.partitionBy("source").orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # equal rows are one row here, however many they are
    at_edge = marked.join(ends, F.col("source").eqNullSafe(F.col("s"))).where("bin = edge").groupBy("source", *place, "before", "left").agg(F.count(F.lit(1)).alias("n"))
    starts = at_edge.withColumn("start", F.col("before") + F.sum(F.col("size") * F.col("n")).over(in_order) - F.col("size") * F.col("n"))
    # the last one taken is that whose middle still lies inside
    inside = starts.withColumn("m", F.least(F.floor((F.col("left") - F.col("start")) / F.col("size") + 0.5), F.col("n"))).where("m > 0")
    cut = inside.groupBy("source").agg(F.max(F.struct(*place, "m", "n")).alias("c"))
    cut = cut.select(F.col("source").alias("s"), F.struct(*[F.col("c").getField(p).alias(p) for p in place]).alias("last"), "c.m", "c.n")
    last = materialise(edges.select("source", "edge").join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "edge", "last", "m", "n"), "mix-cuts")
    out = judged(rows).join(_small(last.select(F.col("source").alias("s"), "edge", "last", "m", "n")), F.col("source").eqNullSafe(F.col("s")), "left")
    key = F.struct(*place)
    extra = F.when(F.col("ratio").isNull(), 0).when(F.col("bin") < F.col("edge"), 1).when((F.col("bin") == F.col("edge")) & (key <= F.col("last")), 1).otherwise(0)
    result = lambda df, more: df.select("row", "size", "source_size", "target", (F.col("certain") + more).cast("long").alias("copies"))
    if last.where("m < n").limit(1).count() == 0:
        return result(out, extra)
    # at most one group of equal rows per source is taken in part: counted, and put out again in pieces
    parted = F.coalesce((F.col("bin") == F.col("edge")) & (key == F.col("last")) & (F.col("m") < F.col("n")), F.lit(False))
    groups = out.where(parted).groupBy("source", *place).agg(*[F.first(c).alias(c) for c in ("row", "source_size", "target", "certain", "m", "n")])
    pieces = groups.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / PIECE)))).repartition("source", "piece")
    single = pieces.withColumn("k", F.explode(F.sequence(F.col("piece") * PIECE + 1, F.least((F.col("piece") + 1) * PIECE, F.col("n")))))
    return result(out.where(~parted), extra).unionByName(result(single, F.when(F.col("k") <= F.col("m"), 1).otherwise(0)))
