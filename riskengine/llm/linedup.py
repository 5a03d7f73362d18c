"""Deletion of repeated runs of lines by suffix ranks over line-id sequences.

The text of a document is a sequence of lines (split at line feeds; blank lines carry no id and stay).
A run is a later copy if the same sequence of lines stands earlier: in a document with a smaller
``doc_id``, or further up in the same document without overlap. Every later copy of ``min_words`` words
or more is deleted, the first stays.

Suffixes are ranked by prefix doubling: the rank of the run of 2**(k+1) lines at a position is the rank
of the pair of its two halves, found by sorting the distinct pairs over the cluster; suffixes alone in
their class drop out. Two suffixes share a prefix of L lines, 2**k <= L < 2**(k+1), if and only if the
ranks of the first and of the last 2**k of these lines are equal, so the intervals of common prefix
length L are the classes of such pairs. It suffices to ask for the shortest prefixes that reach
``min_words`` from each line onward and back from each line: every longer repeated run is the union of
those inside it. As each line has a word, log2(min_words) doublings suffice whatever the lengths.

Defined results: null and empty texts pass unchanged. Rows equal in ``doc_id`` and text are one
document and lose the same lines. A null ``doc_id`` counts as the largest. Equal lines inside one document
are copies like any others. An empty table gives an empty table. Other columns, also ones named like those
used here, pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.store import materialise, small_batches
from riskengine.llm.textbytes import Substrings, U, blocks, mix, string_parts, words

MIN_WORDS = 50
LAST = (1 << 63) - 1


def _list(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def _line_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = string_parts(batch.column("text"))
        whole, total, at, ids, sizes = [], [], [], [], []
        for _lo, _hi, raw, offs in blocks(data, offsets):
            subs = Substrings(raw)
            starts, _ends, _at = words(raw, offs)
            breaks = np.flatnonzero(raw == 10)
            for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                inner = breaks[np.searchsorted(breaks, a) : np.searchsorted(breaks, b)]
                heads = np.concatenate(([a], inner + 1))
                tails = np.concatenate((inner, [b]))
                n = np.searchsorted(starts, tails) - np.searchsorted(starts, heads)
                filled = np.flatnonzero(n)
                found = subs.hash(heads[filled], tails[filled])
                ids.append(found.view(np.int64))
                at.append(filled)
                sizes.append(n[filled])
                total.append(int(n.sum()))
                turned = mix(found + np.arange(1, len(found) + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
                whole.append(int(mix(turned.sum(keepdims=True, dtype=np.uint64) + U(len(found))).view(np.int64)[0]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("ord"), batch.column("th"), pa.array(whole, pa.int64()), pa.array(total, pa.int64()), _list(at, pa.int32()), _list(ids, pa.int64()), _list(sizes, pa.int32())],
            names=["ord", "th", "seq", "words", "at", "ids", "sizes"],
        )


def shortest_runs(sizes: np.ndarray, least: int) -> set[tuple[int, int]]:
    """(start, length) of the shortest runs with ``least`` words that begin, or end, at each line."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    n = len(sizes)
    out = set()
    stop = np.searchsorted(ends, begins + least)  # the first line with which the run from here is long enough
    for i in np.flatnonzero(stop < n).tolist():
        out.add((i, int(stop[i]) - i + 1))
    first = np.searchsorted(begins, ends - least, side="right") - 1  # the last line from which the run to here is
    for j in np.flatnonzero(first >= 0).tolist():
        out.add((int(first[j]), j - int(first[j]) + 1))
    return out


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, ids, starts, lengths = [], [], [], []
            for items in batch.column("items").to_pylist():
                i = np.array([x["i"] for x in items], dtype=np.int64)
                h = np.array([x["h"] for x in items], dtype=np.int64)
                w = np.array([x["w"] for x in items], dtype=np.int64)
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(i) != 1) + 1, [len(i)]))
                own_i, own_h, own_s, own_l = [], [], [], []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    if w[a:b].sum() >= least:
                        own_i.append(i[a:b])
                        own_h.append(h[a:b])
                        for s, n in sorted(shortest_runs(w[a:b], least)):
                            own_s.append(int(i[a]) + s)
                            own_l.append(n)
                kept.append(np.concatenate(own_i) if own_i else np.zeros(0, dtype=np.int64))
                ids.append(np.concatenate(own_h) if own_h else np.zeros(0, dtype=np.int64))
                starts.append(np.array(own_s, dtype=np.int64))
                lengths.append(np.array(own_l, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ord"), batch.column("th"), _list(kept, pa.int32()), _list(ids, pa.int64()), _list(starts, pa.int32()), _list(lengths, pa.int32())],
                names=["ord", "th", "i", "h", "starts", "lengths"],
            )

    return run


def _order() -> list:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64("text").alias("th")]


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(ord, th, gone): per document that loses lines, the numbers of these lines. ``ord`` is the
    ``doc_id`` (null: the largest long), ``th`` the hash of its text."""
    small_batches(docs.sparkSession)
    rows = docs.select(*_order(), F.col("text").cast("string").alias("text")).where("text is not null")
    lines = materialise(rows.mapInArrow(_line_ids, "ord long, th long, seq long, words long, at array<int>, ids array<long>, sizes array<int>"), "lines")
    lines = lines.where("words > 0")
    # documents with one and the same sequence: the first stands for all
    first = materialise(lines.groupBy("seq", "words").agg(F.min(F.struct("ord", "th", "at", "ids", "sizes")).alias("f")).select("seq", "words", "f.*"), "lines-first")
    same = lines.select("ord", "th", "seq", "words", "at").where(f"words >= {min_words}").join(first.select("seq", "words", F.col("ord").alias("ford"), F.col("th").alias("fth")), ["seq", "words"]).where("ord <> ford or th <> fth").select("ord", "th", F.col("at").alias("gone"))
    items = first.select("ord", "th", F.posexplode(F.arrays_zip(F.col("ids"), F.col("sizes"))).alias("i", "x")).select("ord", "th", "i", F.col("x.ids").alias("h"), F.col("x.sizes").alias("w"))
    common = items.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    held = items.join(common, "h").groupBy("ord", "th").agg(F.sum("w").alias("all"), F.sort_array(F.collect_list(F.struct("i", "h", "w"))).alias("items")).where(f"all >= {min_words}").select("ord", "th", "items")
    active = materialise(held.mapInArrow(_runs(min_words), "ord long, th long, i array<int>, h array<long>, starts array<int>, lengths array<int>").where("size(starts) > 0"), "lines-active")
    copies = _later_copies(active, min_words)
    at = copies.join(first.select("ord", "th", "at"), ["ord", "th"]).select("ord", "th", F.transform("lines", lambda i: F.get("at", i)).alias("gone"))
    return same.unionByName(at)


def _later_copies(active: DataFrame, min_words: int) -> DataFrame:
    """(ord, th, lines): numbers of the filled lines covered by later copies."""
    runs = active.select("ord", "th", F.explode(F.arrays_zip("starts", "lengths")).alias("x")).select("ord", "th", F.col("x.starts").alias("i"), F.col("x.lengths").alias("n"))
    runs = runs.withColumn("level", F.floor(F.log2("n") + F.lit(1e-9)).cast("int"))
    ranks = active.select("ord", "th", F.explode(F.arrays_zip("i", "h")).alias("x")).select("ord", "th", F.col("x.i").alias("i"), F.col("x.h").alias("r"))
    levels = [ranks.withColumn("level", F.lit(0))]
    for k in range((max(1, min_words)).bit_length() - 1):
        ranks = _doubled(ranks, 1 << k)
        levels.append(ranks.withColumn("level", F.lit(k + 1)))
    every = levels[0]
    for one in levels[1:]:
        every = every.unionByName(one)
    paired = (
        runs.withColumn("j", (F.col("i") + F.col("n") - F.expr("shiftleft(1, level)")).cast("int"))
        .join(every.withColumnRenamed("r", "r1"), ["level", "ord", "th", "i"])
        .join(every.select("level", "ord", "th", F.col("i").alias("j"), F.col("r").alias("r2")), ["level", "ord", "th", "j"])
        .select("ord", "th", "i", "n", "r1", "r2")
    )
    paired = materialise(paired, "lines-runs")
    firsts = paired.groupBy("n", "r1", "r2").agg(F.min(F.struct("ord", "th", "i")).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1").select("n", "r1", "r2", "f")
    later = paired.join(firsts, ["n", "r1", "r2"]).where("ord <> f.ord or th <> f.th or i >= f.i + n")
    return later.groupBy("ord", "th").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("i", F.col("i") + F.col("n") - 1)))).alias("lines"))


def _doubled(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks of the runs twice as long. The order of ranks is that of the sequences."""
    ahead = Window.partitionBy("ord", "th").orderBy("i").rangeBetween(step, step)
    pairs = ranks.withColumn("r2", F.max("r").over(ahead)).where("r2 is not null")
    kinds = pairs.groupBy("r", "r2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("r", "r2")
    # partitions come in the order of the pairs, so that numbers given in turn are ranks
    order = materialise(kinds.repartitionByRange("r", "r2").sortWithinPartitions("r", "r2").withColumn("rank", F.monotonically_increasing_id()), "lines-ranks")
    return materialise(pairs.join(order, ["r", "r2"]).select("ord", "th", "i", F.col("rank").alias("r")), "lines-suffixes")


def delete_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, text, n_lines, n_deleted): the input row as a struct, its text without later copies, its
    number of filled lines and how many of them went."""
    marks = repeated_lines(docs, min_words).groupBy("ord", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("gone")))).alias("gone"))
    marks = materialise(marks.select("ord", "th", "gone"), "lines-gone")
    full = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"), *_order())
    # one plan at every size: few marks would be broadcast, and the text shuffled all of a sudden where they are more
    full = full.join(marks.hint("merge"), ["ord", "th"], "left")
    lines = F.split("text", "\n", -1)
    # positions that stay, then the lines at them: linear in the length of the text
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    filled = F.size(F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return full.select(
        "row", text.alias("text"), F.when(F.col("text").isNull(), 0).otherwise(filled).cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_deleted")
    )
