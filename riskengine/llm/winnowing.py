"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every ``WINDOW`` consecutive hashes of ``GRAM`` words the smallest (of equal ones the last) is a fingerprint.
Both sides choose alike, so a span of ``SPAN = GRAM + WINDOW - 1`` words that a document shares with an item
shares a fingerprint at the same place. Fingerprints of the two sides are joined; a hit is extended to each
span of ``SPAN`` words around it, and a span counts when its words equal a window of an item. Items
shorter than ``SPAN`` are one window each; there every run of their length is a fingerprint, so they are
found whole as well. Hashes only propose, words decide.

Windows that occur in the same items share one *item set*. A document carries the keys of its item sets, and
documents with the same keys have their item list resolved once, so a window that many documents and many items
hold never makes all pairs of them. One list of items is one row: the result asks for its digest.

Broadcast are fingerprints and windows of the benchmark below ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES``;
a larger benchmark is joined by a shuffle, where the adaptive skew join splits a frequent fingerprint.

Defined results: a null or empty text has no words, is not contaminated and no item occurs in it. A null
``item_id`` is an item with an empty id; items of one id are one item. Equal rows of documents give equal rows. An empty
table of documents gives no rows, an empty benchmark leaves every document clean. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.llm.store import materialise

SPAN = 10
GRAM = 6
WINDOW = SPAN - GRAM + 1
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HIGH = 0x7FFFFFFF
# a fingerprint that every document has, so that clean documents pass the join too
_EVERY = -(1 << 63)


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def _hashed(rows: DataFrame) -> DataFrame:
    """Adds ``n`` and ``hashes`` to rows with ``words``."""
    return rows.withColumns({"n": F.size("words"), "hashes": F.transform("words", lambda w: F.xxhash64(w))})


def _packed_runs(length: int) -> Column:
    """Per run of ``length`` words: the upper half of its hash, and its place counted downwards."""

    def one(i: Column) -> Column:
        run = F.xxhash64(*[F.get("hashes", i + j if j else i) for j in range(length)])
        return F.bitwise_not(F.lit(0xFFFFFFFF).cast("long")).bitwiseAND(run).bitwiseOR((F.lit(_HIGH) - i).cast("long"))

    return F.when(F.col("n") >= length, F.transform(F.sequence(F.lit(0), F.col("n") - length), one)).otherwise(F.array().cast("array<bigint>"))


def _winnowed() -> Column:
    """The distinct fingerprints of ``runs``, the packed runs of ``GRAM`` words."""
    smallest = F.transform(F.sequence(F.lit(0), F.col("n") - SPAN), lambda i: F.least(*[F.get("runs", i + j if j else i) for j in range(WINDOW)]))
    return F.when(F.col("n") >= SPAN, F.array_distinct(smallest)).otherwise(F.array().cast("array<bigint>"))


def _fingerprinted(rows: DataFrame, *more: Column) -> DataFrame:
    """Adds ``marks``. Take them apart with ``explode_outer``: ``explode`` infers a filter on the array's size, which
    the optimizer pushes below the projections with every array computed anew for each element."""
    return _hashed(rows).withColumn("runs", F.when(F.col("n") >= SPAN, _packed_runs(GRAM))).withColumn("marks", F.concat(_winnowed(), *more)).drop("runs")


def _span(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", start + 1, length), " ")


def _bounded(table: DataFrame) -> DataFrame:
    """``table``, marked for broadcast where its measured size allows it."""
    sizes = [F.octet_length(f.name) for f in table.schema.fields if f.dataType.simpleString() == "string"]
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(sizes, F.lit(0))), F.lit(0))).first()
    return F.broadcast(table) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else table


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of a benchmark (item_id, text): fingerprints (key, length), windows (span, item_set), sets (item_set, items)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    marked = materialise(_fingerprinted(items), "winnow-items")
    short = F.col("n") < SPAN
    length = F.least("n", F.lit(SPAN))
    keys = marked.where(~short).select(F.explode_outer("marks").alias("mark")).select(F.shiftright("mark", 32).alias("key"), F.lit(SPAN).alias("length"))
    # a short item's key is taken as a document's runs are, word by word
    for size in [r[0] for r in marked.where(short).select("n").distinct().collect()]:  # at most SPAN - 1 rows
        whole = F.shiftright(F.xxhash64(*[F.get("hashes", F.lit(j)) for j in range(size)]), 32)
        keys = keys.unionByName(marked.where(F.col("n") == size).select(whole.alias("key"), F.lit(size).alias("length")))
    starts = marked.select("item", "words", length.alias("length"), F.explode(F.sequence(F.lit(0), F.col("n") - length)).alias("start"))
    spans = starts.select("item", _span(F.col("start"), F.col("length")).alias("span")).distinct()
    held = spans.groupBy("span").agg(F.array_sort(F.collect_set("item")).alias("items"))
    held = materialise(held.withColumn("item_set", F.sha2(F.to_json("items"), 256)), "winnow-windows")
    return (
        materialise(keys.distinct(), "winnow-keys"),
        held.select("span", "item_set"),
        held.groupBy("item_set").agg(F.first("items").alias("items")),
    )


def hits(docs: DataFrame, keys: DataFrame, windows: DataFrame) -> DataFrame:
    """Per distinct (doc_id, text): doc_id, text_key, n_words, copies, spans (sorted first and last + 1 word of
    every window found), sets (sorted keys of the item sets)."""
    sizes = [r[0] for r in keys.where(F.col("length") < SPAN).select("length").distinct().collect()]
    every = keys.select("key", "length").unionByName(keys.sparkSession.range(1).select(F.lit(_EVERY >> 32).cast("long").alias("key"), F.lit(0).alias("length")))
    rows = docs.select("doc_id", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("text_key"), words_of(F.col("text")).alias("words"))
    marked = _fingerprinted(rows, *[_packed_runs(k) for k in sizes], F.array(F.lit(_EVERY)))
    met = marked.select("doc_id", "text_key", "words", "n", F.explode_outer("marks").alias("mark")).join(_bounded(every), F.shiftright("mark", 32) == F.col("key"))
    place = F.lit(_HIGH) - F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")
    first = F.greatest(F.lit(0), place - F.when(F.col("length") == SPAN, SPAN - GRAM).otherwise(0))
    last = F.least(place, F.col("n") - F.col("length"))
    sentinel = F.col("mark") == F.lit(_EVERY)
    # a chance hit of another length may leave no room for its span
    starts = F.when(sentinel, F.array(F.lit(-1))).when((F.col("length") == 0) | (last < first), F.array().cast("array<int>")).otherwise(F.sequence(first, last))
    tried = met.withColumn("start", F.explode_outer(starts)).withColumn("span", F.when(F.col("start") >= 0, _span(F.col("start"), F.col("length"))))
    found = tried.join(_bounded(windows), "span", "left").where("start < 0 or item_set is not null")
    real = F.col("start") >= 0
    return found.groupBy("doc_id", "text_key").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count_if(~real).alias("copies"),
        F.array_sort(F.collect_set(F.when(real, F.struct("start", (F.col("start") + F.col("length")).alias("end"))))).alias("spans"),
        F.array_sort(F.collect_set("item_set")).alias("sets"),
    )


def _covered(spans: str) -> Column:
    """How many words lie in sorted spans that may overlap."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        spans,
        start,
        lambda a, s: F.struct(F.greatest(a["upto"], s["end"]).alias("upto"), (a["total"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["upto"], s["start"]))).alias("total")),
        lambda a: a["total"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    keys, windows, sets = item_windows(benchmark)
    judged = hits(docs, keys, windows).withColumns({"n_hit": _covered("spans"), "combination": F.sha2(F.array_join("sets", ","), 256)})
    judged = materialise(judged, "winnow-documents")
    lists = judged.where("n_hit > 0").select("combination", "sets").distinct()
    lists = lists.select("combination", F.explode("sets").alias("item_set")).join(sets, "item_set").select("combination", F.explode("items").alias("item"))
    lists = lists.groupBy("combination").agg(F.array_sort(F.collect_set("item")).alias("items"))
    lists = materialise(lists.select("combination", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "winnow-lists")
    dirty = judged.where("n_hit > 0").join(_bounded(lists), "combination")
    clean = judged.where("n_hit = 0").withColumns({"n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)})
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "spans"]
    every = [d.select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")) for d in (dirty, clean)]
    return every[0].unionByName(every[1]).drop("_copy")
