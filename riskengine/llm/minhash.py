"""Near-duplicate documents by one-permutation MinHash with optimal densification.

Defined results: null, empty or blank texts have an empty set and link with nothing. Rows with equal
shingle sets form one class, represented by its smallest ``doc_id``. Rows are judged by their text;
rows that share a ``doc_id`` are taken as the same document, a null ``doc_id`` row belongs to the class
of its text, links like any other, but names nothing (its component is null if it has no id at all). An empty table
gives an empty table. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.llm.components import extended
from riskengine.llm.store import materialise, small_batches
from riskengine.llm.textbytes import U, blocks, mix, shingle_sets, string_parts

BINS = 128
BAND_ROWS = 4
SHINGLE = 5
PERCENT = 75
ROUNDS = 6
SLOTS = 1 << 18
CROWD = 1000

_BIN_SHIFT = U(64 - BINS.bit_length() + 1)
_PROBES = np.random.default_rng(5).integers(0, BINS, (BINS, 4096), dtype=np.int64)
_SLOT_SHIFT = U(64 - SLOTS.bit_length() + 1)
_ROW_SALT = np.random.default_rng(6).integers(1, 1 << 63, BINS, dtype=np.uint64)


def one_permutation(found: np.ndarray) -> np.ndarray:
    """Signature of a non-empty sorted set: the least hash of each bin. An empty bin copies the bin
    that its own sequence of probes meets first (optimal densification: the sequence depends on the
    bin and the attempt alone, so two sets agree on a borrowed bin as often as on a filled one)."""
    at = (found >> _BIN_SHIFT).astype(np.int64)
    first = np.concatenate(([True], at[1:] != at[:-1]))
    out = np.zeros(BINS, dtype=np.uint64)
    filled = np.zeros(BINS, dtype=bool)
    out[at[first]] = found[first]
    filled[at[first]] = True
    empty = np.flatnonzero(~filled)
    done = 0
    for upto in (8, 64, 512, _PROBES.shape[1]):
        if not len(empty):
            return out
        probes = _PROBES[empty, done:upto]
        hit = filled[probes]
        got = hit.any(axis=1)
        rows = np.flatnonzero(got)
        out[empty[rows]] = out[probes[rows, hit[rows].argmax(axis=1)]]
        empty, done = empty[~got], upto
    out[empty] = found[0]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = mix(signature + _ROW_SALT).reshape(-1, BAND_ROWS)
    return mix(rows.sum(axis=1, dtype=np.uint64)).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = string_parts(batch.column("text"))
        unnamed = pc.if_else(batch.column("doc_id").is_null(), batch.column("text"), pa.scalar(None, batch.column("text").type))
        sizes, one, two, bands = [], [], [], []
        for _lo, _hi, raw, offs in blocks(data, offsets):
            for found in shingle_sets(raw, offs, SHINGLE):
                sizes.append(len(found))
                one.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mix(found).sum(dtype=np.uint64).view(np.int64)))
                bands.append(band_keys(one_permutation(found)) if len(found) else np.zeros(0, dtype=np.int64))
        lengths = np.concatenate(([0], np.cumsum([len(b) for b in bands]))).astype(np.int32)
        flat = np.concatenate(bands) if bands else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(one, pa.int64()),
                pa.array(two, pa.int64()),
                pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)),
                unnamed,
            ],
            names=["doc_id", "n_shingles", "set1", "set2", "bands", "unnamed"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: set size, two order-free digests of the set, band keys, and the text where ``doc_id`` is null."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_sketch, "doc_id long, n_shingles long, set1 long, set2 long, bands array<long>, unnamed string")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = (string_parts(batch.column(c)) for c in ("text_a", "text_b"))
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        keep = np.zeros(len(a), dtype=bool)
        last, sets_a = None, None
        for i in range(len(a)):
            if a[i] != last:
                sets_a = shingle_sets(left[0][left[1][i] : left[1][i + 1]], left[1][i : i + 2] - left[1][i], SHINGLE)[0]
                last = None if a[i] is None else a[i]
            sets_b = shingle_sets(right[0][right[1][i] : right[1][i + 1]], right[1][i : i + 2] - right[1][i], SHINGLE)[0]
            both = len(np.intersect1d(sets_a, sets_b, assume_unique=True))
            keep[i] = 100 * both >= PERCENT * (len(sets_a) + len(sets_b) - both) > 0
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(keep))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are alike enough. ``texts``: (rep, text)."""
    half = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
    full = half.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long").distinct()


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        for _lo, _hi, raw, offs in blocks(*string_parts(batch.column("text"))):
            found = np.concatenate(shingle_sets(raw, offs, SHINGLE))
            total += np.bincount((found >> _SLOT_SHIFT).astype(np.int64), minlength=SLOTS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "k"])


def _rare_shingles(counts: np.ndarray):
    """Per text the first shingles in the order of (count of the slot, hash), as many as any like text must share one of."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, places, shingles = [], [], [], []
            for lo, _hi, raw, offs in blocks(*string_parts(batch.column("text"))):
                for i, found in enumerate(shingle_sets(raw, offs, SHINGLE), lo):
                    n = len(found)
                    first = np.lexsort((found, counts[(found >> _SLOT_SHIFT).astype(np.int64)]))[: n - -(-PERCENT * n // 100) + 1]
                    rows.append(np.full(len(first), i))
                    sizes.append(np.full(len(first), n))
                    places.append(np.arange(len(first)))
                    shingles.append(found[first].view(np.int64))
            rows, sizes, places, shingles = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (rows, sizes, places, shingles))
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(at), batch.column("part").take(at), pa.array(sizes), pa.array(places), pa.array(shingles)],
                names=["rep", "part", "n", "place", "shingle"],
            )

    return search


def rare_pairs(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``rest``: (rep, part) in different parts, among them every pair that is alike enough.

    All shingles have one order, roughly from rare to common. Two sets of n and m that share at least
    ``need`` shingles share one whose place is at most n - need in one set and m - need in the other.
    The part with most members of a shingle is never joined with itself, and crowded shingles are salted."""
    full = materialise(texts.join(rest, "rep").select("rep", "part", "text"), "minhash-rest")
    counts = np.zeros(SLOTS, dtype=np.int64)
    # at most SLOTS rows
    found = full.select("text").mapInArrow(_slot_counts, "slot long, k long").groupBy("slot").agg(F.sum("k").alias("k")).toArrow()
    counts[found["slot"].to_numpy()] = found["k"].to_numpy()
    rare = materialise(full.mapInArrow(_rare_shingles(counts), "rep long, part long, n long, place long, shingle long"), "minhash-rare")
    shared = (
        rare.groupBy("shingle", "part")
        .agg(F.count(F.lit(1)).alias("k"))
        .groupBy("shingle")
        .agg(F.max_by("part", F.struct("k", "part")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("k").alias("k"))
        .where("parts > 1")
        .select("shingle", "main", F.ceil(F.col("k") / CROWD).cast("int").alias("salts"))
    )
    rare = materialise(rare.join(shared, "shingle"), "minhash-shared")
    left = rare.where("part <> main").withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int"))
    right = rare.select(
        "shingle",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        *[F.col(c).alias(f"{c}_b") for c in ("rep", "part", "n", "place")],
    )
    need = f"(({PERCENT} * (n + n_b) + {99 + PERCENT}) div {100 + PERCENT})"
    met = left.join(right, ["shingle", "salt"]).where(
        f"part <> part_b and (part_b = main or rep < rep_b) and place <= n - {need} and place_b <= n_b - {need}"
    )
    return met.select(F.least("rep", "rep_b").alias("a"), F.greatest("rep", "rep_b").alias("b")).distinct()


def _order(member: str, turn: int) -> Column:
    return F.xxhash64(F.col(member), F.lit(turn)) if turn else F.col(member)


def _judged(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, unnamed, node (of its component), named (has an id).

    Equal sets are one class. The bands of the class representatives fill buckets; in each bucket a
    star of candidate edges runs from one centre to the other members, so n members give n - 1 edges.
    Edges are confirmed on the full sets. A bucket whose members are not all in one component gets a star
    around another centre in the next turn, against the members outside the centre's component
    only; turns end when one of them finds nothing to test, or no new link after the third. Buckets
    that still hold members of several components, none of them a centre so far, are finished by
    ``rare_pairs``, which leaves no pair of theirs out.
    """
    small_batches(docs.sparkSession)
    seen = materialise(sketches(docs), "minhash-sketches")
    keys = ["n_shingles", "set1", "set2"]
    filled = seen.where("n_shingles > 0")
    classes = materialise(filled.groupBy(*keys).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("unnamed", ignorenulls=True).alias("unnamed")), "minhash-classes")
    # classes without any id are numbered above the largest one, so that a component's smallest node is an id if it has one
    top = seen.agg(F.max("doc_id")).first()[0]
    top = -1 if top is None else top
    nameless = classes.where("rep is null").select(*keys)
    if not nameless.isEmpty():
        numbers = nameless.rdd.zipWithIndex().map(lambda r: (*r[0], top + 1 + r[1]))
        numbers = docs.sparkSession.createDataFrame(numbers, "n_shingles long, set1 long, set2 long, number long")
        classes = materialise(classes.join(numbers, keys, "left").withColumn("rep", F.coalesce("rep", "number")).drop("number"), "minhash-classes")
    members = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    members = materialise(members.join(crowded, "bucket"), "minhash-buckets")
    # every row whose text stands for a candidate class; equal rows once
    wanted = members.select("rep").distinct()
    named = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text")).where("rep is not null and text is not null")
    numbered = classes.where(F.col("rep") > top).select("rep", F.col("unnamed").alias("text"))
    texts = materialise(named.unionByName(numbered).join(wanted, "rep", "left_semi"), "minhash-texts")
    tested = placed = centres = None

    def in_parts() -> DataFrame:
        if placed is None:
            return members.withColumn("part", F.col("rep"))
        return members.join(placed.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "n", "bucket", F.coalesce("component", "rep").alias("part"))

    for turn in range(ROUNDS):
        rows = in_parts()
        mixed = rows.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min(F.struct(_order("rep", turn).alias("o"), "rep", "n", "part")).alias("c")).where("lo < hi").select("bucket", "c")
        mixed = materialise(mixed, "minhash-mixed")
        chosen = mixed.select("bucket", "c.rep", "c.n")
        centres = chosen if centres is None else centres.unionByName(chosen)
        pairs = (
            rows.join(mixed, "bucket")
            .where(f"part <> c.part and 100 * least(n, c.n) >= {PERCENT} * greatest(n, c.n)")
            .select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b"))
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "minhash-pairs")
        if pairs.isEmpty():
            break
        tested = pairs if tested is None else tested.unionByName(pairs)
        new = materialise(confirmed(pairs, texts), "minhash-links")
        if not new.isEmpty():
            placed = extended(placed, new)
        elif turn >= 2:
            break
    # pairs with a centre are settled: what is left are buckets with several components without their centres
    untested = materialise(in_parts().join(centres.distinct(), ["bucket", "rep", "n"], "left_anti"), "minhash-untested")
    crowds = untested.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("bucket")
    rest = materialise(untested.join(crowds, "bucket").select("rep", "part").distinct(), "minhash-open")
    if not rest.isEmpty():
        pairs = rare_pairs(rest, texts)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        new = materialise(confirmed(materialise(pairs, "minhash-pairs"), texts), "minhash-links")
        if not new.isEmpty():
            placed = extended(placed, new)
    rep = classes.select(*keys, "rep")
    if placed is not None:
        rep = rep.join(placed.withColumnRenamed("node", "rep"), "rep", "left").select(*keys, F.coalesce("component", "rep").alias("component_id"))
    else:
        rep = rep.withColumnRenamed("rep", "component_id")
    full = seen.drop("bands").join(rep, keys, "left")
    node = F.coalesce("component_id", "doc_id")
    return full.select("doc_id", "n_shingles", "unnamed", node.alias("node"), (node <= top).alias("named"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    component = F.when(F.col("named"), F.col("node"))
    return _judged(docs).select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The documents left when each near-duplicate group keeps its member with the smallest ``doc_id``;
    documents without words stay. Rows without a ``doc_id`` go if their component is named; of a
    component without any id one row stays."""
    judged = materialise(_judged(docs), "minhash-judged")
    marks = judged.where("named and doc_id is not null and doc_id <> node").select(F.col("doc_id").alias("_gone")).distinct()
    # one plan at every size, see linedup
    kept = docs.join(marks.hint("merge"), docs["doc_id"] == marks["_gone"], "left_anti")
    nameless = judged.where("doc_id is null and n_shingles > 0")
    if nameless.isEmpty():
        return kept
    # rows without an id are known by their text
    nodes = nameless.select(F.col("unnamed").alias("text"), "node", "named").distinct()
    rows = docs.where("doc_id is null").select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    found = rows.where("text is not null").join(nodes.hint("merge"), "text", "left").select("row", "node", "named")
    stay = found.where("node is null").unionByName(found.where("not named").dropDuplicates(["node"])).select("row")
    stay = stay.unionByName(rows.where("text is null").select("row"))
    return kept.where("doc_id is not null").unionByName(stay.select("row.*"))
