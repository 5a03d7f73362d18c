"""Merkle manifest of a table with proofs for every leaf, by octopus multiproofs.

A leaf is the digest of a row. Leaves of a language are folded two by two up to its subroot, subroots up to the root.
The nodes of all levels are stored. To prove leaves, each *leaf partition* (an aligned run of at most
``2**HEIGHT`` leaves of one tree) computes the least set of node coordinates that its own leaves do not give,
fetches these once in one join, derives all shared interior nodes from its leaves and expands every
single proof locally. A tree is built by folding aligned blocks of ``2**HEIGHT`` nodes in tasks, level group by level
group, so no task holds more than one block, however many leaves a language has.

Places come from a range sort of (language, doc_id, leaf) with counts per sorted partition; equal leaves are
dealt to several partitions. Where ``doc_id`` repeats, rows follow by their leaf digest; null ids come first.

Defined results: a null field is ``-``; a null language is its own group, before all others; an empty text is ``0:``. Equal rows
are leaves of their own. A lone leaf is its subroot, a lone subroot the root; a leaf without siblings has the
digest of the empty text as its proof's. ``doc_id`` null or ``n_chars`` null: nothing is tampered with. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.store import materialise

HEIGHT = 12
TAMPERED_EVERY = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "tree string, level int, idx long, n long, digest string"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed): tree names the language, ``changed`` is the tampered leaf or null."""
    def digest(n_chars: Column) -> Column:
        return F.sha2(F.concat(*[_field(n_chars if c == "n_chars" else F.col(c)) for c in FIELDS]), 256)

    # one more than the largest long is a number as well
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0) & F.col("n_chars").isNotNull()
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        "doc_id",
        digest(F.col("n_chars")).alias("leaf"),
        F.when(hit, digest(more)).alias("changed"),
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their place in their tree by ``order``, and ``n``, the tree's size."""
    tie = F.monotonically_increasing_id()
    keys = ["tree", *order, "_tie"]
    ordered = rows.withColumn("_tie", tie).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    stored = materialise(ordered.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    stored = stored.withColumn("_part", F.shiftright("_at", 33))
    counts = stored.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("k"), F.min("_at").alias("_first"))
    # one row per tree and sorted partition that holds some of it
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("k").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("tree", "_part", "_first", before.alias("_before"), F.sum("k").over(tree).alias("n"))
    return stored.join(starts, ["tree", "_part"]).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


def folded_levels(digests: list[str], most: int) -> list[list[str]]:
    """The levels above a run of nodes: pairs in order, a last odd one alone, at most ``most`` levels."""
    out, now = [], digests
    while len(out) < most:
        now = [_sha("".join(now[i : i + 2])) for i in range(0, len(now), 2)]
        out.append(now)
    return out


def _levels(n: int) -> int:
    return max(0, (n - 1).bit_length())


def _fold(height: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        tree, n, base, first = (block.column(c)[0].as_py() for c in ("tree", "n", "level", "idx"))
        levels = folded_levels(block.column("digest").to_pylist(), min(height, _levels(n)))
        rows = [(tree, base + up, (first >> up) + i, -(-n // (1 << up)), d) for up, level in enumerate(levels, 1) for i, d in enumerate(level)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["tree", "level", "idx", "n", "digest"])

    return run


def nodes_of(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """All nodes (tree, level, idx, n: nodes of that level, digest) above and with the leaves (tree, idx, n, digest)."""
    now = leaves.select("tree", F.lit(0).alias("level"), "idx", "n", "digest")
    every, base = now, 0
    while now.where("n > 1").limit(1).count():
        now = materialise(now.where("n > 1").groupBy("tree", F.shiftright("idx", height).alias("block")).applyInArrow(_fold(height), _NODE), "merkle-nodes")
        every, base = every.unionByName(now), base + height
        now = now.where(F.col("level") == base)
    return every


@dataclass
class Manifest:
    """Leaves (tree, idx, n, doc_id, leaf, changed), nodes of the trees, and the tree of their roots."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    top: DataFrame
    height: int


def build(docs: DataFrame, height: int = HEIGHT) -> Manifest:
    leaves = materialise(placed(leaves_of(docs), ["doc_id", "leaf"]), "merkle-leaves")
    nodes = nodes_of(leaves.withColumnRenamed("leaf", "digest"), height)
    roots = nodes.where("n = 1").select(F.lit("top").alias("tree"), F.col("tree").alias("name"), F.col("digest"))
    subroots = materialise(placed(roots, ["name"]), "merkle-subroots")
    return Manifest(leaves, nodes, subroots, nodes_of(subroots, height), height)


def missing(idx: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Per level the places of the nodes that proofs of the leaves ``idx`` (sorted, distinct) of ``n`` need and that
    neither these leaves nor nodes derived from them give."""
    out, have, level = [], idx, 0
    while n > 1:
        beside = have ^ 1
        beside = beside[beside < n]
        out.append((level, np.setdiff1d(beside, have, assume_unique=True)))
        have, n, level = np.unique(have >> 1), (n + 1) >> 1, level + 1
    return out


def _coordinates(part: pa.Table) -> pa.Table:
    tree, n, block = (part.column(c)[0].as_py() for c in ("tree", "n", "block"))
    need = missing(np.unique(part.column("idx").to_numpy()), n)
    at = np.concatenate([np.zeros(0, dtype=np.int64), *[p for _level, p in need]])
    levels = np.concatenate([np.zeros(0, dtype=np.int32), *[np.full(len(p), level, dtype=np.int32) for level, p in need]])
    k = len(at)
    return pa.Table.from_arrays(
        [pa.array([tree] * k, pa.string()), pa.array([block] * k, pa.int64()), pa.array(levels, pa.int32()), pa.array(at, pa.int64())], names=["tree", "block", "level", "idx"]
    )


def fetched(wanted: DataFrame, nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(tree, block, level, idx, digest): the nodes that each leaf partition of ``wanted`` (tree, idx, n) lacks."""
    parts = wanted.select("tree", "idx", "n", F.shiftright("idx", height).alias("block")).groupBy("tree", "block")
    need = parts.applyInArrow(_coordinates, "tree string, block long, level int, idx long")
    return need.join(nodes.select("tree", "level", "idx", "digest"), ["tree", "level", "idx"]).select("tree", "block", "level", "idx", "digest")


def derived(idx: list[int], digests: list[str], got: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """All nodes that proofs of these leaves touch, level by level, the last one holding the root only."""
    now = dict(zip(idx, digests, strict=True))
    out = []
    level = 0
    while n > 1:
        beside = {i ^ 1 for i in now if i ^ 1 < n} - now.keys()
        now.update((i, got[level, i]) for i in beside)
        out.append(now)
        up = {}
        for i in now:
            if i >> 1 not in up:
                left = i & ~1
                up[i >> 1] = _sha(now[left] + now[left + 1]) if left + 1 < n else _sha(now[left])
        now, n, level = up, (n + 1) >> 1, level + 1
    out.append(now)
    return out


def siblings(i: int, levels: list[dict[int, str]]) -> list[tuple[int, str]]:
    """The way up from leaf ``i``: per level 0 where it stands left, 1 right, 2 alone, and its sibling."""
    out = []
    for level in levels[:-1]:
        beside = level.get(i ^ 1)
        out.append((2, "") if beside is None else (i & 1, beside))
        i >>= 1
    return out


def fold(leaf: str, way: list[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for side, beside in way:
        leaf = _sha(beside + leaf if side == 1 else leaf + beside)
    return leaf


_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _expand(part: pa.Table, nodes: pa.Table) -> pa.Table:
    idx, leaves, changed = (part.column(c).to_pylist() for c in ("idx", "leaf", "changed"))
    got, above, root = {}, [], ""
    for kind, level, at, digest in zip(*(nodes.column(c).to_pylist() for c in ("kind", "level", "idx", "digest")), strict=True):
        if kind == "node":
            got[level, at] = digest
        elif kind == "above":
            above.append((level, at, digest))
        else:
            root = digest
    levels = derived(idx, leaves, got, part.column("n")[0].as_py()) if idx else []
    onward = [(side, digest) for _level, side, digest in sorted(above)]
    rows = {c: [] for c in ("subroot", "root", "proof_sha256", "folded_root")}
    for i, leaf, other in zip(idx, leaves, changed, strict=True):
        way = siblings(i, levels) + onward
        rows["subroot"].append(next(iter(levels[-1].values())))
        rows["root"].append(root)
        rows["proof_sha256"].append(_sha("".join(d for _side, d in way)))
        rows["folded_root"].append(fold(leaf if other is None else other, way))
    out = {"doc_id": part.column("doc_id").cast(pa.int64()), "leaf": part.column("leaf").cast(pa.string()), **{c: pa.array(v, pa.string()) for c, v in rows.items()}}
    out["verified"] = pa.array([a == b for a, b in zip(rows["root"], rows["folded_root"], strict=True)], pa.bool_())
    return pa.table(out)


def _ways(top: pa.Table, nodes: pa.Table) -> pa.Table:
    """For a leaf partition of the top tree: each name's way up, and the root."""
    got = {(lv, i): d for lv, i, d in zip(*(nodes.column(c).to_pylist() for c in ("level", "idx", "digest")), strict=True)}
    rows = []
    if top.num_rows:
        idx = top.column("idx").to_pylist()
        levels = derived(idx, top.column("digest").to_pylist(), got, top.column("n")[0].as_py())
        for i, name in zip(idx, top.column("name").to_pylist(), strict=True):
            rows += [(name, "above", k, side, d) for k, (side, d) in enumerate(siblings(i, levels))]
            rows.append((name, "root", 0, 0, next(iter(levels[-1].values()))))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["tree", "kind", "level", "idx", "digest"])


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of ``wanted``, rows of ``manifest.leaves`` (all of them by default): ``_PROOF``."""
    leaves, height = manifest.leaves if wanted is None else wanted, manifest.height
    top = manifest.subroots.withColumn("block", F.shiftright("idx", height))
    top_nodes = fetched(manifest.subroots, manifest.top, height)
    ways = top.groupBy("tree", "block").cogroup(top_nodes.groupBy("tree", "block")).applyInArrow(_ways, "tree string, kind string, level int, idx long, digest string")
    ways = materialise(ways, "merkle-ways")
    leaves = leaves.withColumn("block", F.shiftright("idx", height))
    blocks = leaves.select("tree", "block").distinct()
    nodes = fetched(leaves, manifest.nodes, height).withColumn("kind", F.lit("node")).unionByName(blocks.join(ways, "tree"))
    return leaves.groupBy("tree", "block").cogroup(nodes.groupBy("tree", "block")).applyInArrow(_expand, _PROOF)
