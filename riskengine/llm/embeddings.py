"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Normalised vectors are projected on random Gaussian directions; an offset projection, divided by a width and
rounded down, is one hash, and ``k`` hashes form a table's bucket. Vectors with cosine c lie sqrt(2 - 2c) apart, which
gives the chance of a common bucket; k grows with the logarithm of the number of vectors, so that unrelated ones
rarely meet, and the number of tables is that which misses a pair at the threshold with a chance of ``miss``.

Equal vectors form one class, compared once. A crowded bucket is cut into blocks of ``BLOCK`` classes; a task compares
two blocks by a matrix product and returns counts per vector and at most one edge per vector, never the pairs.
A pair that meets in several tables is counted in the first of them only.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
different lengths do not link. A null ``vec_id`` row is compared like others; its component is the
smallest id of those reachable, or null. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.components import connected_components
from riskengine.llm.store import materialise

COSINE = 0.95
WIDTH = 2.0
MISS = 0.002
BLOCK = 512
UNRELATED = math.sqrt(2.0)


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that two vectors at a distance have one hash in common."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(hashes per table, tables) for ``n`` vectors."""
    k = max(4, math.ceil(math.log(max(n, 2)) / -math.log(collision(UNRELATED))))
    near = collision(math.sqrt(2 - 2 * cosine)) ** k
    return k, max(1, math.ceil(math.log(miss) / math.log1p(-near)))


def _buckets(k: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            keys = []
            for vector in batch.column("embedding"):
                v = np.asarray(vector.values, dtype=np.float64)
                if len(v) not in drawn:
                    rng = np.random.default_rng([seed, len(v)])
                    drawn[len(v)] = (rng.standard_normal((k * tables, len(v))), rng.uniform(0, WIDTH, k * tables), rng.integers(1, 1 << 62, k * tables) | 1)
                directions, offsets, salts = drawn[len(v)]
                top = np.abs(v).max()
                unit = v / top
                unit /= np.linalg.norm(unit)
                cells = np.floor((directions @ unit + offsets) / WIDTH).astype(np.int64)
                mixed = (cells * salts).reshape(tables, k).sum(axis=1) + np.arange(tables) * 0x9E3779B97F4A7C1 + len(v)
                mixed ^= mixed >> 29
                keys.append(mixed * np.int64(-0x61C8864680B583EB))
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, tables, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "keys"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Rows of equal ``names`` from sorted batches, each group as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _local_components(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable, by a boolean link matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        after = np.minimum(label, low)
        after = np.minimum(after, after[after])
        if (after == label).all():
            return label
        label = after


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, tos = [], [], []

        def pack() -> pa.RecordBatch:
            nonlocal ids, counts, tos
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(counts), pa.int64()), pa.array(np.concatenate(tos), pa.int64())], names=["rep", "n", "to"]
            )
            ids, counts, tos = [], [], []
            return out

        for group in _groups(batches, ["bucket", "one", "two"]):
            group = group.combine_chunks()
            table, one, two = group["tab"][0].as_py(), group["one"][0].as_py(), group["two"][0].as_py()
            rep = group["rep"].to_numpy()
            size = group["size"].to_numpy()
            block = group["block"].to_numpy()
            n = len(rep)
            vectors = group["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)
            keys = group["keys"].combine_chunks().flatten().to_numpy().reshape(n, -1)
            vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            left = np.flatnonzero(block == one)
            right = np.flatnonzero(block == two)
            i, j = np.nonzero(vectors[left] @ vectors[right].T >= threshold)
            i, j = left[i], right[j]
            keep = i < j if one == two else i != j
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            # met in an earlier table: counted there, linked there
            new = np.ones(len(i), dtype=bool)
            for t in range(table):
                new &= keys[i, t] != keys[j, t]
            i, j = i[new], j[new]
            if not len(i):
                continue
            links = np.bincount(i, weights=size[j], minlength=n) + np.bincount(j, weights=size[i], minlength=n)
            linked = np.zeros((n, n), dtype=bool)
            linked[i, j] = linked[j, i] = True
            some = np.flatnonzero(links)
            label = _local_components(linked[np.ix_(some, some)])
            ids.append(rep[some])
            counts.append(links[some].astype(np.int64))
            tos.append(rep[some[label]])
            if sum(map(len, ids)) > 50_000:
                yield pack()
        if ids:
            yield pack()

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, seed: int = 11) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("embedding", F.when(F.col("embedding").isNotNull() & whole, F.transform("embedding", lambda x: x + F.lit(0.0))))
    # classes of equal vectors, named by a hash of their components
    rows = rows.withColumn("cls", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")))
    classes = rows.where("cls is not null").groupBy("cls", "embedding").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("size"))
    classes = materialise(classes.withColumnRenamed("cls", "rep"), "vectors")
    n = classes.count()
    k, tables = table_plan(n, cosine)
    hashed = classes.select("rep", "size", "embedding").mapInArrow(_buckets(k, tables, seed), "rep long, size long, embedding array<double>, keys array<long>")
    hashed = materialise(hashed, "vectors-hashed")
    met = hashed.select("rep", F.posexplode("keys").alias("tab", "key")).select("rep", "tab", F.xxhash64("tab", "key").alias("bucket"))
    crowded = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
    seats = met.join(crowded, "bucket").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int"))
    # a row goes to every pair of blocks that its own is part of
    seats = seats.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    seats = seats.select("rep", "tab", "bucket", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    dealt = seats.join(hashed, "rep").repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    found = materialise(dealt.select("bucket", "one", "two", "block", "tab", "rep", "size", "embedding", "keys").mapInArrow(_compare(cosine), "rep long, n long, `to` long"), "vectors-found")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    placed = connected_components(found.where("rep <> `to`").select(F.col("rep").alias("a"), F.col("to").alias("b")))
    own = classes.select("rep", "low", "size").join(counts, "rep", "left").join(placed.withColumnRenamed("node", "rep"), "rep", "left")
    own = own.withColumn("component", F.coalesce("component", "rep"))
    # components are named by class hashes; their smallest id names them in the result
    names = own.groupBy("component").agg(F.min("low").alias("component_id"))
    marks = materialise(own.join(names, "component").select(F.col("rep").alias("cls"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"), "vectors-marks")
    out = rows.select("vec_id", "cls").join(marks, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
