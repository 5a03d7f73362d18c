"""Forests and boosted trees grown on binned rows, as Spark's learners grow them, with numpy in the tasks.

Rows are stored once as blocks of one-byte bins. A pass counts, block by block, how the classes (forest) or the residuals
(boosting) lie over the bins of the nodes to be split; only counts leave a task, so no task holds more than its share of the rows.
The trees become a model of Spark ML by way of its stored form, so scoring, importances and saving are Spark's own.

What is the same as in Spark's learners: 32 bins by quantiles (here of all rows, there of a sample), Poisson bags and a random set of
columns per node (forest), row shares drawn anew each round, residuals and leaf values of the logistic loss (boosting), weighted Gini
or variance gain, least rows per node, depth. The random numbers are others than Spark's.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.session import scratch_path

BINS = 32
BLOCK_ROWS = 1 << 17
#: rows taken through several steps at a time, while they are in the cache
PART = 1 << 13
#: points of a block's summary of one column
POINTS = 256
#: histogram cells that a task of the forest holds at a time (64 MB)
CELLS = 1 << 24
#: rows that a task holds at most
TASK_ROWS = 1 << 21
#: binned bytes up to which boosting runs in one task: its rounds are hundreds of short passes
ONE_TASK_BYTES = 1 << 25


# ---- binned rows ---------------------------------------------------------------


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.stack([batch.column(c).cast("double").to_numpy(zero_copy_only=False) for c in names])


def _in_blocks(batches: Iterator[pa.RecordBatch], names: Sequence[str], rows: int) -> Iterator[np.ndarray]:
    """Arrays (column, row) of ``rows`` rows each."""
    held, n = [], 0
    for batch in batches:
        table = _columns(batch, names)
        while table.shape[1]:
            part = table[:, : rows - n]
            held.append(part)
            n += part.shape[1]
            table = table[:, part.shape[1] :]
            if n == rows:
                yield np.concatenate(held, axis=1)
                held, n = [], 0
    if n:
        yield np.concatenate(held, axis=1)


def _points(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and their counts, or as many values at even ranks, each with the rows it stands for."""
    values = values[~np.isnan(values)]
    distinct, n = np.unique(values, return_counts=True)
    if len(distinct) <= POINTS:
        return distinct, n
    ends = np.cumsum(n)
    at = np.unique(np.searchsorted(ends, np.arange(1, POINTS + 1) * len(values) / POINTS - 1e-9))
    return distinct[at], np.diff(ends[at], prepend=0)


def thresholds(rows: DataFrame, cols: Sequence[str], bins: int = BINS, block_rows: int = BLOCK_ROWS) -> list[np.ndarray]:
    """Per column at most ``bins`` - 1 increasing bounds between values, at even shares of the rows; a bin is closed on the right."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _in_blocks(batches, cols, block_rows):
            found = [_points(v) for v in block]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cols)), pa.int32()), pa.array([v for v, _n in found], pa.list_(pa.float64())), pa.array([n for _v, n in found], pa.list_(pa.int64()))],
                ["place", "v", "n"],
            )

    parts = rows.select(*cols).mapInArrow(summary, "place int, v array<double>, n array<long>").toArrow()
    place = parts["place"].to_numpy()
    out = []
    for i in range(len(cols)):
        mine = parts.filter(pa.array(place == i))
        v, n = (np.concatenate([np.zeros(0), *[x.values.to_numpy() for x in mine[c]]]) for c in ("v", "n"))
        distinct, where = np.unique(v, return_inverse=True)
        ends = np.cumsum(np.bincount(where, weights=n, minlength=len(distinct)))
        at = np.arange(len(distinct) - 1)
        if len(distinct) > bins:
            at = np.unique(np.searchsorted(ends, np.arange(1, bins) * ends[-1] / bins - 1e-9))
            at = at[at < len(distinct) - 1]
        middle = distinct[at] / 2 + distinct[at + 1] / 2
        out.append(np.where(np.isfinite(middle), middle, distinct[at]))
    return out


class Block:
    """Bins of some rows, those of class 0 first. ``by_row``: (row, column), else (column, row)."""

    def __init__(self, number: int, zeros: int, x: np.ndarray):
        self.number, self.zeros, self.x = number, zeros, x


def binned(rows: DataFrame, cols: Sequence[str], label: str, cuts: list[np.ndarray], n_rows: int, tasks: int, by_row: bool, block_rows: int = BLOCK_ROWS) -> RDD:
    """The rows as stored blocks, one list of them per partition, kept. A task that is run again gets the same blocks."""
    spark = rows.sparkSession
    d = len(cols)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, block in enumerate(_in_blocks(batches, [*cols, label], block_rows)):
            y = block[d]
            if not ((y == 0) | (y == 1)).all():
                raise ValueError(f"{label} must be 0 or 1")
            if not np.isfinite(block).all():
                raise ValueError("values must not be missing or infinite")
            order = np.argsort(y, kind="stable")
            x = np.stack([np.searchsorted(cut, v).astype(np.uint8) for cut, v in zip(cuts, block[:d], strict=True)])[:, order]
            one = [pa.array([(part << 32) + i], pa.int64()), pa.array([int((y == 0).sum())], pa.int64()), pa.array([len(y)], pa.int64())]
            yield pa.RecordBatch.from_arrays([*one, pa.array([(x.T if by_row else x).tobytes()], pa.binary())], ["id", "zeros", "n", "x"])

    path = scratch_path(spark, "binned")
    # blocks end with a partition of the rows
    block_rows = max(1, min(block_rows, -(-n_rows // tasks)))
    rows.select(*cols, label).mapInArrow(write, "id long, zeros long, n long, x binary").write.parquet(path)
    stored = spark.read.schema("id long, zeros long, n long, x binary").parquet(path)
    numbers = {r["id"]: i for i, r in enumerate(stored.select("id", "n").orderBy("n", "id").collect())}

    def open_block(r) -> tuple[int, tuple]:
        return numbers[r["id"]], (r["zeros"], r["n"], bytes(r["x"]))

    def gather(found) -> list[list[Block]]:
        shape = (lambda n: (n, d)) if by_row else (lambda n: (d, n))
        return [[Block(k, zeros, np.frombuffer(x, np.uint8).reshape(shape(n))) for k, (zeros, n, x) in sorted(found)]]

    dealt = stored.rdd.map(open_block).partitionBy(max(1, min(tasks, len(numbers))), lambda k: k)
    return dealt.mapPartitions(gather).persist(StorageLevel.MEMORY_AND_DISK)


def tasks_for(rows: DataFrame, n: int, rows_per_task: int) -> int:
    """One task per ``rows_per_task`` rows, up to one per core, and whole waves of them where a task would hold too many."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(math.ceil(n / rows_per_task), cores * math.ceil(n / (cores * TASK_ROWS))))


def class_weights(rows: DataFrame, label: str, weight: str | None) -> np.ndarray:
    """The weight of a row of class 0 and 1. Rows of a class have one weight."""
    if weight is None:
        return np.ones(2)
    found = {r[label]: (r["lo"], r["hi"]) for r in rows.groupBy(label).agg(F.min(weight).alias("lo"), F.max(weight).alias("hi")).collect()}
    if any(lo != hi for lo, hi in found.values()):
        raise ValueError("rows of a class must have one weight")
    return np.array([found[c][0] if c in found else 1.0 for c in (0, 1)])


def _walk(x: np.ndarray, at: np.ndarray, step: int, tree: tuple[np.ndarray, np.ndarray], levels: int, node: np.ndarray, start: int = 0) -> np.ndarray:
    """Place of rows within a level. ``x``: flat bins, ``at``: where a row's column 0 lies, ``step``: from column to column.
    Nodes that are not split send all rows to the left."""
    feature, cut = tree
    code = (feature * step << 8) | cut
    out = np.empty(len(at), dtype=np.int64)
    for begin in range(0, len(at), PART):
        part = slice(begin, begin + PART)
        first, here = at[part], node[part].copy()
        for level in range(start, levels):
            c = code[(1 << level) - 1 : (2 << level) - 1].take(here)
            here += here
            here += x.take(first + (c >> 8)) > (c & 255)
        out[part] = here
    return out


# ---- forest ----------------------------------------------------------------------

_POISSON = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16)
).astype(np.uint8)


def _columns_of(seed: int, tree: int, level: int, d: int, k: int) -> np.ndarray:
    """The columns that each node of a level may be split by."""
    draws = np.random.Generator(np.random.SFC64([seed, 1, tree, level])).random((1 << level, d), dtype=np.float32)
    return np.sort(np.argpartition(draws, min(k, d) - 1, axis=1)[:, :k], axis=1).astype(np.int64)


def _count_classes(blocks: list[Block], trees: dict[int, tuple], level: int, seed: int, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per tree the bagged rows by (open node, column of its set, bin, class). ``trees``: columns and cuts so far, open nodes."""
    d = blocks[0].x.shape[1] if blocks else 0
    counts = {t: np.zeros(len(opened) * k * BINS * 2, dtype=np.float32) for t, (_f, _c, opened) in trees.items()}
    plans = {}
    for t, (feature, cut, opened) in trees.items():
        place = np.full(1 << level, -1, dtype=np.int64)
        place[opened] = np.arange(len(opened))
        plans[t] = ((feature, cut), place, np.ascontiguousarray(_columns_of(seed, t, level, d, k)[opened].T), len(opened) == 1 << level)
    for block in blocks:
        x, n = block.x.reshape(-1), len(block.x)
        for t, (tree, place, sets, whole) in plans.items():
            bag = _POISSON[np.random.Generator(np.random.SFC64([seed, 0, t, block.number])).integers(0, 1 << 16, n, dtype=np.uint16)]
            drawn = np.flatnonzero(bag)
            node = place[_walk(x, drawn * d, 1, tree, level, np.zeros(len(drawn), dtype=np.int64))]
            if not whole:
                inside = node >= 0
                drawn, node = drawn[inside], node[inside]
            times, base = bag[drawn].astype(np.float32), node * (k * BINS * 2) + (drawn >= block.zeros)
            for start in range(0, len(drawn), PART):
                part = slice(start, start + PART)
                for j in range(k):
                    cell = x.take(drawn[part] * d + sets[j].take(node[part])).astype(np.int64)
                    cell += cell
                    cell += base[part]
                    cell += j * BINS * 2
                    np.add.at(counts[t], cell, times[part])
    for t, c in counts.items():
        top = c.max(initial=0)
        yield t, c.astype(np.uint8 if top < 256 else np.uint16 if top < 1 << 16 else np.int64)


def _gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.maximum(a + b, 1e-300)
    return 1.0 - (a / total) ** 2 - (b / total) ** 2


def _best_classes(counts: np.ndarray, sets: np.ndarray, weights: np.ndarray, least: int) -> tuple:
    """Per open node: gain (0 where no split is allowed), column, bin, bagged rows by class of the node and of its left child."""
    nodes, k = sets.shape
    upto = counts.reshape(nodes, k, BINS, 2).astype(np.float64).cumsum(axis=2)
    every = upto[:, :1, -1:, :]
    left, right = upto, every - upto
    total, w_left, w_right = ((x * weights).sum(axis=-1) for x in (every, left, right))
    before = _gini(*np.moveaxis(every * weights, -1, 0))
    gain = before - w_left / total * _gini(*np.moveaxis(left * weights, -1, 0)) - w_right / total * _gini(*np.moveaxis(right * weights, -1, 0))
    allowed = (left.sum(axis=-1) >= least) & (right.sum(axis=-1) >= least)
    gain = np.where(allowed, gain, 0.0).reshape(nodes, -1)
    best = gain.argmax(axis=1)
    row = np.arange(nodes)
    column, cut = sets[row, best // BINS], best % BINS
    return gain[row, best], column, cut, every[:, 0, 0, :], left.reshape(nodes, -1, 2)[row, best]


def fit_forest(rows: DataFrame, cols: Sequence[str], label: str, forest: RandomForestClassifier, n: int, tasks: int) -> RandomForestClassificationModel:
    """The forest that ``forest`` describes, grown level by level, as many trees at a time as a task can count."""
    d, depth, least, n_trees, seed = len(cols), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getNumTrees(), forest.getSeed()
    k = max(1, math.ceil(math.sqrt(d)))
    weights = class_weights(rows, label, forest.getWeightCol())
    cuts = thresholds(rows, cols)
    data = binned(rows, cols, label, cuts, n, tasks, by_row=True)
    size = (1 << depth) - 1
    feature = np.zeros((n_trees, size), dtype=np.int64)
    cut = np.full((n_trees, size), 255, dtype=np.uint8)
    gain = np.zeros((n_trees, size))
    # bagged rows by class of every node, the leaves of the last level included; none where there is no node
    stats = np.zeros((n_trees, 2 * size + 1, 2))
    opened = {t: np.zeros(1, dtype=np.int64) for t in range(n_trees)}
    for level in range(depth):
        per_node, first, waiting = k * BINS * 2, (1 << level) - 1, [t for t in opened if len(opened[t])]
        while waiting:
            group, cells = {}, 0
            while waiting and (not group or cells + len(opened[waiting[0]]) * per_node <= CELLS):
                t = waiting.pop(0)
                group[t] = (feature[t, :first].copy(), cut[t, :first].copy(), opened[t])
                cells += len(opened[t]) * per_node

            def count(parts, group=group, level=level):
                for blocks in parts:
                    yield from _count_classes(blocks, group, level, seed, k)

            nodes = {t: g[2] for t, g in group.items()}

            def split(item, nodes=nodes, level=level):
                t, counts = item
                return t, _best_classes(counts, _columns_of(seed, t, level, d, k)[nodes[t]], weights, least)

            summed = data.mapPartitions(count).reduceByKey(lambda a, b: a.astype(np.int64) + b, data.getNumPartitions())
            for t, (won, column, at, every, left) in summed.map(split).collect():
                here = first + opened[t]
                stats[t, here] = every
                s = won > 0
                feature[t, here[s]], cut[t, here[s]], gain[t, here[s]] = column[s], at[s], won[s]
                stats[t, 2 * here[s] + 1], stats[t, 2 * here[s] + 2] = left[s], every[s] - left[s]
                children = np.stack([2 * opened[t][s], 2 * opened[t][s] + 1], axis=1).reshape(-1)
                inside = stats[t, 2 * first + 1 + children]
                # a pure node is a leaf
                opened[t] = children[(inside > 0).all(axis=1)]
    data.unpersist()
    trees = [_nodes(feature[t], cut[t], gain[t], stats[t], cuts, weights) for t in range(n_trees)]
    return _stored_model(rows.sparkSession, forest, RandomForestClassificationModel, trees, [1.0] * n_trees, d, {"numClasses": 2})


def _nodes(feature, cut, gain, stats, cuts, weights) -> dict[str, np.ndarray]:
    """The nodes of one tree of the forest in the order of Spark's stored form."""
    w = stats * weights
    return _listed(feature, cut, gain, cuts, w.argmax(axis=1).astype(float), _gini(w[:, 0], w[:, 1]), w, stats.sum(axis=1))


def _listed(feature, cut, gain, cuts, prediction, impurity, stats, raw) -> dict[str, np.ndarray]:
    size = len(gain)
    split = np.append(gain > 0, np.zeros(len(raw) - size, dtype=bool))
    firsts = [(1 << level) - 1 for level in range(size.bit_length())]
    for first in reversed(firsts):
        i = np.arange(first, 2 * first + 1)
        left, right = 2 * i + 1, 2 * i + 2
        # as in Spark, leaves that predict the same are one
        split[i] &= split[left] | split[right] | (prediction[left] != prediction[right])
    kept = np.zeros(len(raw), dtype=bool)
    kept[0] = True
    for first in firsts:
        i = np.arange(first, 2 * first + 1)
        kept[2 * i + 1] = kept[2 * i + 2] = kept[i] & split[i]
    split &= kept
    here = np.flatnonzero(kept)
    number = np.cumsum(kept) - 1
    inner = split[here]
    at = np.where(inner, here, 0)
    bound = np.array([cuts[f][c] if s else 0.0 for f, c, s in zip(feature[at], cut[at], inner, strict=True)])
    return {
        "prediction": prediction[here],
        "impurity": impurity[here],
        "stats": stats[here],
        "raw": raw[here].astype(np.int64),
        "gain": np.where(inner, gain[at], -1.0),
        "left": np.where(inner, number[np.where(inner, 2 * here + 1, 0)], -1).astype(np.int32),
        "right": np.where(inner, number[np.where(inner, 2 * here + 2, 0)], -1).astype(np.int32),
        "feature": np.where(inner, feature[at], -1).astype(np.int32),
        "bound": bound,
    }


_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _stored_model(spark: SparkSession, estimator, kind, trees: list[dict], weights: list[float], d: int, more: dict):
    """A model of Spark ML with these trees, read from its stored form."""
    path = scratch_path(spark, "trees")
    member = "DecisionTreeClassificationModel" if kind is RandomForestClassificationModel else "DecisionTreeRegressionModel"
    package = "org.apache.spark.ml."

    def document(name: str, uid: str, own: set[str] | None = None, **rest) -> str:
        given, default = ({p.name: v for p, v in m.items() if own is None or p.name in own} for m in (estimator._paramMap, estimator._defaultParamMap))
        return json.dumps({"class": name, "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "paramMap": given, "defaultParamMap": default, **rest})

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                tree = shared.value[t]
                n = len(tree["raw"])
                width = tree["stats"].shape[1]
                inner = tree["feature"] >= 0
                split = pa.StructArray.from_arrays(
                    [
                        pa.array(tree["feature"]),
                        pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(inner)).astype(np.int32)), pa.array(tree["bound"][inner])),
                        pa.array(np.full(n, -1, dtype=np.int32)),
                    ],
                    ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
                )
                stats = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(tree["stats"].reshape(-1)))
                plain = [pa.array(tree[c]) for c in ("prediction", "impurity")]
                ends = [pa.array(tree[c]) for c in ("raw", "gain", "left", "right")]
                node = pa.StructArray.from_arrays(
                    [pa.array(np.arange(n, dtype=np.int32)), *plain, stats, *ends, split],
                    ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
                )
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, dtype=np.int32)), node], ["treeID", "nodeData"])

    context = spark.sparkContext
    shared = context.broadcast(trees)
    parts = max(1, min(context.defaultParallelism, len(trees)))
    spark.range(0, len(trees), 1, parts).mapInArrow(lines, _NODE).write.parquet(f"{path}/data")
    owned = {"featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed", "weightCol", "impurity", "cacheNodeIds", "checkpointInterval", "leafCol", "maxMemoryInMB", "minWeightFractionPerNode"}
    part = f"{package}{'classification' if 'Classification' in member else 'regression'}.{member}"
    if "Classification" in member:
        owned |= {"probabilityCol", "rawPredictionCol"}
    listed = [(t, document(part, f"{'dtc' if 'Classification' in member else 'dtr'}_{uuid.uuid4().hex[:12]}", owned), w) for t, w in enumerate(weights)]
    spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = document(f"{package}classification.{kind.__name__}", estimator.uid, numFeatures=d, numTrees=len(trees), **more)
    context.parallelize([whole], 1).saveAsTextFile(f"{path}/metadata")
    # a thread of fits side by side has no session of its own
    model = kind.read().session(spark).load(path)
    shared.destroy()
    return model


# ---- boosting ----------------------------------------------------------------------

#: a residual is kept to 2^-20; a chunk's row count and residual sum share one float, exact below 2^53
CHUNK = 1 << 15
_SCALE, _ONE = float(1 << 20), float(1 << 38)
#: bytes of margins that a worker keeps between passes
_KEPT_BYTES = 1 << 27
_kept: OrderedDict = OrderedDict()


def _margins(fit: str, block: Block, trees: list[tuple], rates: Sequence[float]) -> np.ndarray:
    """Sum of the trees so far for the rows of a block. A worker goes on from what it kept of an earlier round, else from the start."""
    done, margin = _kept.pop((fit, block.number), (0, None))
    d, n = block.x.shape
    if margin is None or done > len(trees):
        done, margin = 0, np.zeros(n)
    x, at = block.x.reshape(-1), np.arange(n)
    for (feature, cut, value), rate in zip(trees[done:], rates[done : len(trees)], strict=True):
        levels = len(value).bit_length() - 1
        margin += rate * value[_walk(x, at, n, (feature, cut), levels, np.zeros(n, dtype=np.int64))]
    _kept[fit, block.number] = (len(trees), margin)
    while len(_kept) > 1 and sum(m.nbytes for _t, m in _kept.values()) > _KEPT_BYTES:
        _kept.popitem(last=False)
    return margin


def _residuals(block: Block, margin: np.ndarray, turn: int, share: float, seed: int) -> np.ndarray:
    """Of the rows drawn in this round: one row and its residual as one number; 0 for the others."""
    n = len(margin)
    y = np.ones(n)
    y[: block.zeros] = -1.0
    r = 4.0 * y / (1.0 + np.exp(np.minimum(2.0 * y * margin, 700.0))) if turn else y
    drawn = np.random.Generator(np.random.SFC64([seed, 2, turn, block.number])).random(n, dtype=np.float32) < share
    return np.where(drawn, _ONE + np.rint(r * _SCALE), 0.0)


def _sum_residuals(block: Block, packed: np.ndarray, node: np.ndarray, level: int, weights: np.ndarray) -> np.ndarray:
    """(weight and weighted residuals, column, node of the level, bin)."""
    d, n = block.x.shape
    cells = (1 << level) * BINS
    out = np.zeros((2, d, cells))
    base = node * BINS
    found = np.empty((d, cells))
    for weight, begin, end in ((weights[0], 0, block.zeros), (weights[1], block.zeros, n)):
        for start in range(begin, end, CHUNK):
            part = slice(start, min(start + CHUNK, end))
            here, what = base[part], packed[part]
            for f in range(d):
                found[f] = np.bincount(here + block.x[f, part], weights=what, minlength=cells)
            rows = np.rint(found / _ONE)
            out[0] += weight * rows
            out[1] += weight / _SCALE * (found - rows * _ONE)
    return out.reshape(2, d, 1 << level, BINS)


def _best_residuals(sums: np.ndarray, opened: np.ndarray) -> tuple:
    """Per open node: gain (0 where there is none), column, bin, (weight, residuals) of the node and of its left child."""
    w, s = (np.moveaxis(x, 1, 0)[opened].cumsum(axis=-1) for x in sums)
    total, every = w[:, :1, -1:], s[:, :1, -1:]
    right, rest = total - w, every - s
    # a weight is a sum of a few different numbers: what is left of no row is rounding
    allowed = (w > 1e-9 * total) & (right > 1e-9 * total)
    w, right = np.where(allowed, w, 1.0), np.where(allowed, right, 1.0)
    safe = np.maximum(total, 1e-300)
    gain = np.where(allowed, (s**2 / w + rest**2 / right - every**2 / safe) / safe, 0.0).reshape(len(opened), -1)
    best, row = gain.argmax(axis=1), np.arange(len(opened))
    both = np.stack([x.reshape(len(opened), -1)[row, best] for x in (w, s)], axis=1)
    return gain[row, best], best // BINS, best % BINS, np.stack([total[:, 0, 0], every[:, 0, 0]], axis=1), both


def _boost(passes, turns: int, depth: int, rate: float) -> list[tuple]:
    """The trees as (column, bin, gain per inner place; (weight, residuals) per place; value per place of the last level).
    ``passes(trees, rates, tree, level)`` gives the sums over all rows."""
    trees, full = [], []
    size = (1 << depth) - 1
    rates = [1.0] + [rate] * (turns - 1)
    for _turn in range(turns):
        feature, cut, gain = np.zeros(size, dtype=np.int64), np.full(size, 255, dtype=np.uint8), np.zeros(size)
        stats = np.zeros((2 * size + 1, 2))
        opened = np.zeros(1, dtype=np.int64)
        for level in range(depth):
            if not len(opened):
                break
            first = (1 << level) - 1
            won, column, at, every, left = _best_residuals(passes(trees, rates, (feature, cut), level), opened)
            here = first + opened
            if not level:
                stats[0] = every[0]
            s = won > 1e-12
            feature[here[s]], cut[here[s]], gain[here[s]] = column[s], at[s], won[s]
            stats[2 * here[s] + 1], stats[2 * here[s] + 2] = left[s], every[s] - left[s]
            opened = np.stack([2 * opened[s], 2 * opened[s] + 1], axis=1).reshape(-1)
        value = np.divide(stats[:, 1], stats[:, 0], out=np.zeros(len(stats)), where=stats[:, 0] > 0)
        for place in range(size):
            # below a leaf all rows go left
            if not gain[place]:
                value[2 * place + 1] = value[place]
        trees.append((feature, cut, value[size:].copy()))
        full.append((feature, cut, gain, stats, value))
    return full


def fit_boosted(rows: DataFrame, cols: Sequence[str], label: str, boosted: GBTClassifier, n: int, tasks: int, one_task_bytes: int = ONE_TASK_BYTES) -> GBTClassificationModel:
    """The boosted trees that ``boosted`` describes. A table that one task can hold is boosted in one: the same passes over the same
    blocks, without a job for each."""
    turns, depth, rate, share, seed = boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize(), boosted.getSubsamplingRate(), boosted.getSeed()
    weights = class_weights(rows, label, boosted.getWeightCol() if boosted.isDefined("weightCol") else None)
    cuts = thresholds(rows, cols)
    data = binned(rows, cols, label, cuts, n, tasks, by_row=False)
    fit = uuid.uuid4().hex

    def sums(blocks: list[Block], trees, rates, tree, level) -> np.ndarray:
        total = 0.0
        for block in blocks:
            packed = _residuals(block, _margins(fit, block, trees, rates), len(trees), share, seed)
            n = block.x.shape[1]
            node = _walk(block.x.reshape(-1), np.arange(n), n, tree, level, np.zeros(n, dtype=np.int64))
            total = total + _sum_residuals(block, packed, node, level, weights)
        return total

    def whole(parts) -> list:
        blocks = sorted((b for blocks in parts for b in blocks), key=lambda b: b.number)
        state = {}

        def passes(trees, rates, tree, level) -> np.ndarray:
            total = 0.0
            for block in blocks:
                n = block.x.shape[1]
                x, at = block.x.reshape(-1), np.arange(n)
                if not level:
                    margin = state[block.number][2] if trees else np.zeros(n)
                    if trees:
                        # the place in the last level is one step from where the last pass left the row
                        feature, cut, value = trees[-1]
                        node = _walk(x, at, n, (feature, cut), len(value).bit_length() - 1, state[block.number][1], state[block.number][3])
                        margin = margin + rates[len(trees) - 1] * value[node]
                    state[block.number] = (_residuals(block, margin, len(trees), share, seed), np.zeros(n, dtype=np.int64), margin, 0)
                packed, node, margin, at_level = state[block.number]
                node = _walk(x, at, n, tree, level, node, at_level)
                state[block.number] = (packed, node, margin, level)
                total = total + _sum_residuals(block, packed, node, level, weights)
            return total

        return [_boost(passes, turns, depth, rate)]

    n_bytes = data.map(lambda blocks: sum(b.x.nbytes for b in blocks)).sum()
    if n_bytes <= one_task_bytes:
        full = data.coalesce(1).mapPartitions(whole).collect()[0]
    else:

        def passes(trees, rates, tree, level) -> np.ndarray:
            found = data.map(lambda blocks: sums(blocks, trees, rates, tree, level)).collect()
            return sum(found[1:], found[0])

        full = _boost(passes, turns, depth, rate)
    data.unpersist()
    listed = []
    for feature, cut, gain, stats, value in full:
        # the squares of residuals are not summed: the stored impurity of a node is not known and not used
        three = np.column_stack([stats, np.zeros(len(stats))])
        listed.append(_listed(feature, cut, gain, cuts, np.divide(stats[:, 1], stats[:, 0], out=np.zeros(len(stats)), where=stats[:, 0] > 0), np.zeros(len(stats)), three, stats[:, 0]))
    return _stored_model(rows.sparkSession, boosted, GBTClassificationModel, listed, [1.0] + [rate] * (turns - 1), len(cols), {})
