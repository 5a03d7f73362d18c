"""Classifiers, class balancing, cross-validation and scoring on ``pyspark.ml``."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.functions.columns import count_if, row_order
from riskengine.operators import metrics as M
from riskengine.operators import trees
from riskengine.operators.ranking import after, rows_at_ranks
from riskengine.session import scratch_path

SEED = 42
FOLDS = 3
SMOTE_RATIO = 0.3
#: a fit alone takes all cores early; of fits side by side each takes few
ROWS_PER_TASK = 25_000
ROWS_PER_TASK_TOGETHER = 200_000
PARALLEL_FITS = 8
#: with as many splits a task, one more or less is no great difference
MOST_SPLITS_DEALT = 8
TIERS = {
    "baseline": ["logistic_regression", "decision_tree", "naive_bayes", "random_forest"],
    "advanced": ["boosted_trees_a", "boosted_trees_b", "mlp"],
}
NEEDS_SMOTE = {"boosted_trees_b", "mlp"}


# ---- balancing ---------------------------------------------------------------


def with_weights(df: DataFrame, kind: str = "balanced", label: str = "Class", out: str = "weight") -> DataFrame:
    """``balanced``: n / (2 n_class); ``positive``: negatives per positive on the fraud side."""
    neg, pos = df.agg(count_if(F.col(label) == 0), count_if(F.col(label) == 1)).first()
    if not neg or not pos:
        raise ValueError("both classes are needed")
    if kind == "balanced":
        w0, w1 = (neg + pos) / (2 * neg), (neg + pos) / (2 * pos)
    elif kind == "positive":
        w0, w1 = 1.0, neg / pos
    else:
        raise ValueError(f"unknown weighting '{kind}'")
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0)))


def smote_neighbours(minority: int, folds: int = FOLDS) -> int:
    """At most five, and always fewer than a fold has minority rows."""
    return max(1, min(5, minority // folds - 1))


#: points searched together in one task
CELL_ROWS = 1 << 14
#: points of a leaf, compared at once
LEAF_ROWS = 256
#: rows that show the planes between cells where to lie; the cells are exact for any planes
PLANE_ROWS = 1 << 16
#: visits written in one turn, per point of the table, and at least
VISITS_AT_ONCE, LEAST_VISITS = 4, 1 << 19


def _planes(table: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree of cuts (column, bound; by level) into a power of two cells: the widest column of a node is cut at its median."""
    levels = max(0, math.ceil(math.log2(max(1, cells))))
    columns, bounds = np.zeros((1 << levels) - 1, dtype=np.int64), np.zeros((1 << levels) - 1)
    parts = [table]
    for place in range(len(columns)):
        part = parts[place]
        if len(part):
            columns[place] = (part.max(axis=0) - part.min(axis=0)).argmax()
            bounds[place] = np.median(part[:, columns[place]])
        left = part[:, columns[place]] <= bounds[place]
        parts += [part[left], part[~left]]
        parts[place] = None
    return columns, bounds


def _cell_of(table: np.ndarray, planes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    columns, bounds = planes
    place, row = np.zeros(len(table), dtype=np.int64), np.arange(len(table))
    while len(columns) and place[0] < len(columns):
        place = 2 * place + 1 + (table[row, columns[place]] > bounds[place])
    return place - len(columns)


def _leaves(table: np.ndarray) -> list[np.ndarray]:
    """The rows of ``table`` in boxes of at most ``LEAF_ROWS``, cut across the widest column."""
    out, waiting = [], [np.arange(len(table))]
    while waiting:
        rows = waiting.pop()
        if len(rows) <= LEAF_ROWS:
            out.append(rows)
            continue
        part = table[rows]
        column = part[:, (part.max(axis=0) - part.min(axis=0)).argmax()]
        order = np.argpartition(column, len(rows) // 2)
        waiting += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def _away(lo: np.ndarray, hi: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    """Squared distance of a box (or a point) from boxes."""
    return (np.maximum(0.0, np.maximum(los - hi, lo - his)) ** 2).sum(axis=-1)


def _nearest(asked: np.ndarray, names: np.ndarray, table: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int, reach: np.ndarray) -> tuple:
    """For each row of ``asked`` its k nearest rows of ``table`` with another id and no farther than the square root of ``reach``: distances
    squared, keys and ids, padded by infinite distances. Exact: boxes are left out only when all of them is farther than the k nearest
    found. Equal distances by key, then id."""
    n = len(asked)
    best_d, best_key, best_id = np.full((n, k), np.inf), np.zeros((n, k), dtype=np.int64), np.zeros((n, k), dtype=np.int64)
    if not n or not len(table):
        return best_d, best_key, best_id
    leaves = _leaves(table)
    los, his = np.stack([table[r].min(axis=0) for r in leaves]), np.stack([table[r].max(axis=0) for r in leaves])
    middle = (los + his) / 2
    for rows in _leaves(asked):
        block, who = asked[rows], names[rows]
        far = _away(block.min(axis=0), block.max(axis=0), los, his)
        near_first = np.lexsort((((middle - block.mean(axis=0)) ** 2).sum(axis=1), far))
        d, key, name, most = best_d[rows], best_key[rows], best_id[rows], reach[rows]
        for leaf in near_first:
            # rounding of the bound must not leave out an equal distance
            limit = np.minimum(most, d[:, -1]) * (1 + 1e-9)
            if far[leaf] > limit.max():
                break
            close = _away(block, block, los[leaf], his[leaf]) <= limit
            if not close.any():
                continue
            here = np.flatnonzero(close)
            other, shift = table[leaves[leaf]], middle[leaf]
            # differences from the middle of the box keep the products small; what they leave open is measured anew
            a, b = block[here] - shift, other - shift
            size_a, size_b = (a**2).sum(axis=1)[:, None], (b**2).sum(axis=1)[None, :]
            rough = size_a + size_b - 2.0 * a @ b.T
            i, j = np.nonzero(rough <= limit[here][:, None] + 1e-12 * (size_a + size_b))
            known = who[here][i] != ids[leaves[leaf]][j]
            i, j = i[known], j[known]
            if not len(i):
                continue
            if len(i) > k * len(here):
                # of many, those that can be among the k nearest of this leaf
                mask = np.full(rough.shape, np.inf)
                mask[i, j] = rough[i, j]
                last = np.partition(mask, k - 1, axis=1)[:, k - 1] if mask.shape[1] > k else np.full(len(here), np.inf)
                slack = 2e-12 * (size_a[:, 0] + size_b.max())
                kept = mask[i, j] <= last[i] + slack[i]
                i, j = i[kept], j[kept]
            exact = ((block[here][i] - other[j]) ** 2).sum(axis=1)
            _merge(d, key, name, here, i, exact, keys[leaves[leaf]][j], ids[leaves[leaf]][j], k)
        best_d[rows], best_key[rows], best_id[rows] = d, key, name
    over = best_d > reach[:, None]
    best_d[over] = np.inf
    return best_d, best_key, best_id


def _merge(d, key, name, here, i, exact, keys, ids, k) -> None:
    """Put found pairs among the k nearest of their rows, in place."""
    rows = here[np.unique(i)]
    who = np.concatenate([np.repeat(rows, k), here[i]])
    every = [np.concatenate([old[rows].reshape(-1), new]) for old, new in ((d, exact), (key, keys), (name, ids))]
    order = np.lexsort((every[2], every[1], every[0], who))
    who = who[order]
    start = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
    rank = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
    kept = rank < k
    for out, values in zip((d, key, name), every, strict=True):
        out[rows] = values[order][kept].reshape(len(rows), k)


def _vectors(column: pa.ChunkedArray, d: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(column) else np.zeros(0)
    return np.ascontiguousarray(flat, dtype=float).reshape(-1, d)


_NEAR = "array<struct<d: double, key: long, id: long>>"


def _as_near(d: np.ndarray, key: np.ndarray, name: np.ndarray) -> pa.Array:
    inside = np.isfinite(d)
    ends = np.append(0, np.cumsum(inside.sum(axis=1))).astype(np.int32)
    struct = pa.StructArray.from_arrays([pa.array(x[inside]) for x in (d, key, name)], ["d", "key", "id"])
    return pa.ListArray.from_arrays(pa.array(ends), struct)


def minority_neighbours(
    minority: DataFrame, key: str, n: int, k: int, leaf_rows: int = CELL_ROWS, seed: int = SEED, cell_rows: int | None = None, asked: Column | None = None
) -> DataFrame:
    """Add ``nb``, the vectors of the k nearest other minority rows, to (key, x); only to rows that are ``asked`` for, where this is given.

    The neighbours are exact for any number of rows. Rows equal in all columns are one point; the nearest neighbours of a copy are
    its copies. Up to ``leaf_rows`` rows are one cell; beyond, points lie in cells of about ``cell_rows``, cut across the widest columns. A point is first searched for in its own
    cell and then visits those whose box is not farther than the k nearest found there. A crowded cell is dealt out by a hash. Visits
    are written in turns, so that points that have to visit many cells need time, not disk. Rows with a missing or infinite value have no
    neighbours."""
    spark = minority.sparkSession
    cell_rows = cell_rows or leaf_rows
    wanted = F.lit(True) if asked is None else asked
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    grouped = minority.groupBy("x").agg(F.count(F.lit(1)).alias("_copies"), F.min(key).alias("_key"), F.max(wanted).alias("_asked"))
    points = grouped.withColumn("_point", F.xxhash64("x", "_key"))
    cells = 1 if n <= leaf_rows else math.ceil(n / cell_rows)
    sample = points.where(finite).select("x", row_order(points, ["_point"], seed).alias("_h"))
    shown = np.zeros((0, 1))
    if cells > 1:
        found = sample.orderBy("_h").limit(min(PLANE_ROWS, 64 * cells)).select("x").toArrow()["x"]
        shown = _vectors(found, len(found[0])) if len(found) else shown
    planes = _planes(shown, cells if len(shown) else 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = _vectors(pa.chunked_array([batch.column("x")]), len(batch.column("x")[0]))
                good = np.isfinite(table).all(axis=1)
                cell = pa.array(np.where(good, _cell_of(np.where(good[:, None], table, 0.0), planes), -1))
                yield pa.RecordBatch.from_arrays([*batch.columns, cell], [*batch.schema.names, "_cell"])

    stored = scratch_path(spark, "points")
    kinds = f"x array<double>, _copies long, _key {minority.schema[key].dataType.simpleString()}, _asked boolean, _point long, _cell long"
    points.mapInArrow(place, kinds).write.parquet(stored)
    points = spark.read.schema(kinds).parquet(stored)
    inside = points.where("_cell >= 0").select("x", F.coalesce(F.col("_key").cast("long"), F.lit(-(1 << 63))).alias("_key"), "_asked", "_point", "_cell")
    sizes = {r["_cell"]: r["n"] for r in inside.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    # cells and their parts, numbered; the box of a part is measured on its points
    parts = {c: math.ceil(size / (2 * cell_rows)) for c, size in sizes.items()}
    firsts = dict(zip(parts, np.cumsum([0, *parts.values()])[:-1].tolist(), strict=True))
    many = spark.createDataFrame([(c, firsts[c], parts[c]) for c in parts], "_cell long, _first long, _parts long")
    numbered = inside.join(F.broadcast(many), "_cell").select("x", "_key", "_asked", "_point", (F.col("_first") + F.pmod("_point", F.col("_parts"))).alias("_box"))

    def measure(table: pa.Table) -> pa.Table:
        x = _vectors(table["x"], len(table["x"][0]))
        return pa.table({"_box": table["_box"][:1], "lo": pa.array([x.min(axis=0)]), "hi": pa.array([x.max(axis=0)])})

    boxes = numbered.groupBy("_box").applyInArrow(measure, "_box long, lo array<double>, hi array<double>").orderBy("_box").toArrow()
    if not len(boxes):
        return minority.where(wanted).select(key, "x", F.array().cast("array<array<double>>").alias("nb"))
    d = len(boxes["lo"][0])
    place_of, los, his = boxes["_box"].to_numpy(), _vectors(boxes["lo"], d), _vectors(boxes["hi"], d)

    def at_home(table: pa.Table) -> pa.Table:
        x, ids, keys = _vectors(table["x"], d), table["_point"].to_numpy(), table["_key"].to_numpy()
        who = table["_asked"].to_numpy(zero_copy_only=False).astype(bool)
        home = table["_box"][0].as_py()
        found = _nearest(x[who], ids[who], x, ids, keys, k, np.full(who.sum(), np.inf))
        reach = found[0][:, -1]
        visits = []
        for row, far in zip(x[who], reach * (1 + 1e-9), strict=True):
            visits.append(place_of[(_away(row, row, los, his) <= far) & (place_of != home)])
        return pa.table({"x": table["x"].filter(pa.array(who)), "_point": ids[who], "_box": np.full(who.sum(), home), "near": _as_near(*found), "reach": reach, "visits": pa.array(visits, pa.list_(pa.int64()))})

    path = scratch_path(spark, "neighbours")
    searched = f"x array<double>, _point long, _box long, near {_NEAR}, reach double, visits array<long>"
    numbered.groupBy("_box").applyInArrow(at_home, searched).write.parquet(path)
    first = spark.read.schema(searched).parquet(path)
    calls = {r["_box"]: r["n"] for r in first.select(F.explode("visits").alias("_box")).groupBy("_box").agg(F.count(F.lit(1)).alias("n")).collect()}
    turns, room = [[]], 0
    for box, number in sorted(calls.items()):
        if turns[-1] and room + number > max(LEAST_VISITS, VISITS_AT_ONCE * n):
            turns, room = [*turns, []], 0
        turns[-1].append(box)
        room += number
    seen, searched = scratch_path(spark, "visits"), f"_point long, near {_NEAR}"
    first.select("_point", "near").write.parquet(seen)
    for turn in turns:
        if not turn:
            continue
        # a box that many points visit is searched by several tasks, each for a share of them
        shares = spark.createDataFrame([(b, math.ceil(calls[b] / (4 * cell_rows))) for b in turn], "_box long, _shares long")
        guests = first.select("x", "_point", "reach", F.explode("visits").alias("_box")).join(F.broadcast(shares), "_box")
        guests = guests.select("x", "_point", F.lit(0).cast("long").alias("_key"), "reach", "_box", F.pmod(F.xxhash64("_point"), F.col("_shares")).alias("_share"))
        hosts = numbered.join(F.broadcast(shares), "_box").select(
            "x", "_point", "_key", F.lit(None).cast("double").alias("reach"), "_box", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shares") - 1)).alias("_share")
        )

        def visit(table: pa.Table) -> pa.Table:
            guest = table["reach"].is_valid().combine_chunks()
            came, here = table.filter(guest), table.filter(pc.invert(guest))
            x, ids, keys = _vectors(here["x"], d), here["_point"].to_numpy(), here["_key"].to_numpy()
            near = _nearest(_vectors(came["x"], d), came["_point"].to_numpy(), x, ids, keys, k, came["reach"].to_numpy())
            return pa.table({"_point": came["_point"], "near": _as_near(*near)})

        guests.unionByName(hosts).groupBy("_box", "_share").applyInArrow(visit, searched).write.mode("append").parquet(seen)
    nearest = spark.read.schema(searched).parquet(seen).groupBy("_point").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    # the planner takes an array for one element and so a table of vectors for a small one: never broadcast it
    links = nearest.select("_point", F.posexplode("near").alias("_place", "_to")).select("_point", "_place", F.col("_to.id").alias("_other"))
    ends = points.select(F.col("_point").alias("_other"), F.col("x").alias("_v"))
    named = links.join(ends.hint("merge"), "_other").groupBy("_point").agg(F.array_sort(F.collect_list(F.struct("_place", "_v"))).alias("_near"))
    every = minority.where(wanted).join(points.select("x", "_copies", "_point").hint("merge"), "x").join(named.hint("merge"), "_point", "left")
    # the copies of the row, then the neighbours of its point
    copies = F.array_repeat("x", F.least(F.col("_copies") - 1, F.lit(k)).cast("int"))
    others = F.coalesce(F.transform("_near", lambda c: c["_v"]), F.array().cast("array<array<double>>"))
    return every.select(*minority.columns, F.slice(F.concat(copies, others), 1, k).alias("nb"))


def smote(
    df: DataFrame,
    cols: Sequence[str],
    label: str = "Class",
    key: str = "txn_id",
    ratio: float = SMOTE_RATIO,
    k: int | None = None,
    seed: int = SEED,
    leaf_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add synthetic minority rows until minority = ratio x majority. Each lies between a
    minority row and one of its near neighbours; every random choice is a hash of the row
    key and copy number, so a retried task makes the same rows. They carry no key."""
    rows = df.select(key, label, *[F.col(c).cast("double").alias(c) for c in cols])
    neg, pos = rows.agg(count_if(F.col(label) == 0), count_if(F.col(label) == 1)).first()
    new = int(ratio * neg) - pos
    if new <= 0 or pos < 2:
        return rows
    minority = rows.where(F.col(label) == 1).select(key, F.array(*cols).alias("x"))
    hashed = minority.withColumn("_h", row_order(minority, [key], seed))
    copies = F.lit(new // pos)
    if new % pos:
        order = ["_h", key]
        cut = rows_at_ranks(hashed.select(key, "_h"), order, [new % pos], at_most=pos)[0]
        copies = copies + (~after(order, cut)).cast("int")
    # only rows that are copied need neighbours
    copied = hashed.withColumn("_times", copies)
    near = minority_neighbours(copied, key, pos, k or smote_neighbours(pos), leaf_rows, seed, asked=F.col("_times") > 0)
    pick = F.pmod(F.xxhash64(F.lit(seed + 1), key, "_copy"), F.size("nb")).cast("int")
    gap = F.pmod(F.xxhash64(F.lit(seed + 2), key, "_copy"), F.lit(1 << 20)) / F.lit(1 << 20)
    made = (
        near.select(key, "x", "nb", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy"))
        .withColumn("_gap", gap)
        .withColumn("_other", F.when(F.size("nb") > 0, F.get("nb", pick)).otherwise(F.col("x")))
        .withColumn("_new", F.zip_with("x", "_other", lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    )
    synthetic = made.select(
        F.lit(None).cast("long").alias(key),
        F.lit(1).cast(df.schema[label].dataType).alias(label),
        *[
            (F.col("_new")[i]["a"] + F.col("_gap") * (F.col("_new")[i]["b"] - F.col("_new")[i]["a"])).alias(c)
            for i, c in enumerate(cols)
        ],
    )
    return rows.unionByName(synthetic)


# ---- models --------------------------------------------------------------------


def make_model(name: str, cols: Sequence[str], rows: int, label: str = "Class", effort: float = 1.0, seed: int = SEED) -> Pipeline:
    """A classifier by name. ``effort`` scales the number of trees, rounds or iterations;
    1.0 is the full setting."""

    def times(n: int) -> int:
        return max(1, round(n * effort))

    common = {"labelCol": label, "featuresCol": "features"}
    weighted = {**common, "weightCol": "weight"}
    scaled = name in ("logistic_regression", "naive_bayes", "mlp")
    if name == "logistic_regression":
        # C = 0.1 on a sum of losses is 1 / (C n) on their mean
        model = LogisticRegression(maxIter=times(5000), regParam=1.0 / (0.1 * rows), elasticNetParam=0.0, **weighted)
    elif name == "decision_tree":
        model = DecisionTreeClassifier(maxDepth=8, minInstancesPerNode=50, seed=seed, **weighted)
    elif name == "naive_bayes":
        model = NaiveBayes(modelType="gaussian", **common)
    elif name == "random_forest":
        model = RandomForestClassifier(
            numTrees=times(200), maxDepth=12, minInstancesPerNode=50, featureSubsetStrategy="sqrt", seed=seed, **weighted
        )
    elif name == "boosted_trees_a":
        model = GBTClassifier(maxIter=times(200), maxDepth=6, stepSize=0.05, subsamplingRate=0.8, seed=seed, **weighted)
    elif name == "boosted_trees_b":
        model = GBTClassifier(maxIter=times(500), maxDepth=5, stepSize=0.03, subsamplingRate=0.7, seed=seed, **common)
    elif name == "mlp":
        model = MultilayerPerceptronClassifier(
            layers=[len(cols), 128, 64, 32, 2], maxIter=times(200), seed=seed, **common
        )
    else:
        raise ValueError(f"unknown model '{name}'")
    stages = [VectorAssembler(inputCols=list(cols), outputCol="raw_features" if scaled else "features", handleInvalid="keep")]
    if scaled:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, model])


def stored_rows(df: DataFrame, label: str, rows_per_task: int = ROWS_PER_TASK, even: bool = False) -> tuple[DataFrame, int]:
    """A training set written once, so that no pass of a fit computes it anew, and its row count. A small one is
    one task per ``rows_per_task`` rows: the many short jobs of a boosted model then have few tasks. ``even``: for rows that are
    read hundreds of times, tasks of equal size that fill the cores to the last wave."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    rows = stored.count()
    return _dealt(stored, rows, rows_per_task, even), rows


def _dealt(stored: DataFrame, rows: int, rows_per_task: int, even: bool = False) -> DataFrame:
    """A stored table in one task per ``rows_per_task`` rows, up to one per core and more only where its files have more. Files
    of few distinct values are small for their rows, so that their splits leave cores idle: then the rows are dealt out. So they are
    with ``even`` where splits do not go evenly into the tasks wanted: every pass would wait for the core that has one more."""
    cores = stored.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, math.ceil(rows / rows_per_task))
    wanted, have = min(tasks, cores), stored.rdd.getNumPartitions()
    if have < wanted:
        return stored.repartition(wanted)
    if even and wanted > 1 and have % wanted and have < MOST_SPLITS_DEALT * wanted:
        return stored.repartition(wanted if tasks < cores else math.ceil(have / cores) * cores)
    return stored.coalesce(tasks) if tasks < cores else stored


def side_by_side(work: Sequence[Callable[[], object]], spark: SparkSession, threads: int = PARALLEL_FITS) -> list:
    """The results of independent pieces of driver work, ``threads`` of them at a time. Spark shares its executors
    among their jobs."""

    def run(piece: Callable[[], object]) -> object:
        # each thread gets the session's local properties
        return inheritable_thread_target(spark)(piece)()

    with ThreadPool(max(1, min(threads, len(work)))) as pool:
        return pool.map(run, work, chunksize=1)


def balanced_rows(
    name: str, train: DataFrame, cols: Sequence[str], label: str = "Class", key: str = "txn_id", rows_per_task: int = ROWS_PER_TASK
) -> tuple[DataFrame, int]:
    """The training rows balanced the way a model needs it, stored."""
    if name in NEEDS_SMOTE:
        ready = smote(train, cols, label, key).withColumn("weight", F.lit(1.0))
    else:
        ready = with_weights(train, "positive" if name == "boosted_trees_a" else "balanced", label)
    return stored_rows(ready.select(*cols, label, "weight"), "balanced", rows_per_task, even=True)


def fit(
    name: str,
    train: DataFrame,
    cols: Sequence[str],
    label: str = "Class",
    key: str = "txn_id",
    effort: float = 1.0,
    ready: tuple[DataFrame, int] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> PipelineModel:
    """Balance the training rows the way the model needs it, then fit on all of them. ``ready``: what
    ``balanced_rows`` gave, where several models share it."""
    rows, n = ready or balanced_rows(name, train, cols, label, key, rows_per_task)
    if name == "mlp":
        return fit_mlp(rows, cols, label, effort, rows_per_task=rows_per_task)[0]
    pipeline = make_model(name, cols, n, label, effort)
    grow = {"random_forest": trees.fit_forest, "boosted_trees_a": trees.fit_boosted, "boosted_trees_b": trees.fit_boosted}.get(name)
    if grow is None:
        return pipeline.fit(rows)
    assembler, learner = pipeline.getStages()
    return PipelineModel([assembler, grow(rows, cols, label, learner, n, trees.tasks_for(rows, n, rows_per_task))])


def fit_mlp(
    rows: DataFrame,
    cols: Sequence[str],
    label: str = "Class",
    effort: float = 1.0,
    seed: int = SEED,
    iterations: int = 10,
    patience: int = 3,
    share: float = 0.1,
    least_gain: float = 1e-4,
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[PipelineModel, list[tuple[int, float]]]:
    """The network fitted in rounds of ``iterations``, each from the weights of the one before, until the loss on a held-out
    share has not fallen by ``least_gain`` for ``patience`` rounds or the full number of iterations is reached. Returns the
    best round's model and (round, held-out loss) of every round. Rows are held out by a hash of their values; without any
    held-out or fitted rows all rounds are run on all rows."""
    assembler, scaler, network = make_model("mlp", cols, 0, label, effort, seed).getStages()
    limit = network.getMaxIter()
    front = Pipeline(stages=[assembler, scaler]).fit(rows)
    held = F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1000)) < int(1000 * share)
    table, _n = stored_rows(front.transform(rows).select("features", label, held.alias("_held")), "mlp", rows_per_task, even=True)
    inner, outer = table.where("not _held"), table.where("_held")
    kinds = [r[0] for r in inner.select(label).distinct().limit(2).collect()]
    if len(kinds) < 2 or outer.isEmpty():
        inner, outer, patience = table, table, math.ceil(limit / iterations)
    network = network.copy().setMaxIter(min(iterations, limit))
    best, history = None, []
    for turn in range(1, math.ceil(limit / iterations) + 1):
        model = network.fit(inner)
        network = network.setInitialWeights(model.weights)
        p = vector_to_array("probability")
        right = F.when(F.col(label) == 1, p[1]).otherwise(p[0])
        loss = model.transform(outer).agg(F.avg(-F.log(F.greatest(right, F.lit(1e-15))))).first()[0]
        history.append((turn, loss))
        if best is None or loss < best[0] - least_gain:
            best = (loss, turn, model)
        elif turn - best[1] >= patience:
            break
    return PipelineModel([*front.stages, best[2]]), history


def score(model: PipelineModel, df: DataFrame, name: str, label: str = "Class", key: str = "txn_id") -> DataFrame:
    """Long score table (model_name, key, label, p)."""
    p = vector_to_array("probability")[1]
    return model.transform(df).select(F.lit(name).alias("model_name"), key, F.col(label).alias("label"), p.alias("p"))


def feature_importance(model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    """(feature, importance), largest first; a linear model gives absolute coefficients."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = np.abs(last.coefficients.toArray())
    else:
        raise ValueError(f"{type(last).__name__} has no importances")
    rows = [(c, float(v)) for c, v in zip(cols, values)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


# ---- cross-validation -------------------------------------------------------------


def stratified_folds(
    df: DataFrame, k: int = FOLDS, label: str = "Class", key: str = "txn_id", seed: int = SEED, out: str = "fold"
) -> DataFrame:
    """Shuffled folds with equal shares of each class. The rows of a class are ordered by
    hash and cut at k - 1 ranks; the cuts are literals, so no class is gathered anywhere."""
    hashed = df.withColumn("_h", row_order(df, [key], seed))
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    fold: Column = F.lit(0)
    order = ["_h", key]
    for value, n in sorted(counts.items()):
        ranks = [n * j // k for j in range(1, k)]
        cuts = rows_at_ranks(hashed.where(F.col(label) == value).select(*order), order, [r for r in ranks if r], at_most=n)
        inside: Column = F.lit(sum(1 for r in ranks if not r))
        for cut in cuts:
            inside = inside + after(order, cut).cast("int")
        fold = F.when(F.col(label) == value, inside).otherwise(fold)
    return hashed.withColumn(out, fold).drop("_h")


FOLD_METRICS = ["roc_auc", "average_precision", "precision", "recall", "f1_score"]


def cross_validate(
    names: str | Sequence[str],
    df: DataFrame,
    cols: Sequence[str],
    k: int = FOLDS,
    label: str = "Class",
    key: str = "txn_id",
    effort: float = 1.0,
    threshold: float = 0.5,
    threads: int = PARALLEL_FITS,
) -> DataFrame:
    """(model_name, fold, metric, value). Balancing happens inside the training folds: each fold's training set is made and
    stored once per way of balancing, and the fits of all models and folds run side by side. A fit leaves five figures."""
    spark = df.sparkSession
    names = [names] if isinstance(names, str) else list(names)
    folded, _n = stored_rows(stratified_folds(df.select(key, label, *cols), k, label, key), "folds", ROWS_PER_TASK_TOGETHER)
    ways = {name: "smote" if name in NEEDS_SMOTE else "positive" if name == "boosted_trees_a" else "balanced" for name in names}
    first = {(way, i): name for name, way in reversed(ways.items()) for i in range(k)}

    def training_set(name: str, i: int) -> Callable[[], tuple[DataFrame, int]]:
        return lambda: balanced_rows(name, folded.where(F.col("fold") != i), cols, label, key, ROWS_PER_TASK_TOGETHER)

    made = side_by_side([training_set(name, i) for (_way, i), name in first.items()], spark, threads)
    sets = dict(zip(first, made, strict=True))

    def one(name: str, i: int) -> Callable[[], list[tuple]]:
        def work() -> list[tuple]:
            model = fit(name, folded, cols, label, key, effort, sets[ways[name], i], ROWS_PER_TASK_TOGETHER)
            scored, _rows = stored_rows(score(model, folded.where(F.col("fold") == i), name, label, key), "fold-scores", ROWS_PER_TASK_TOGETHER)
            areas = M.ranking_metrics(scored, digits=None)
            row = areas.join(M.rates(M.confusion_matrix(scored, threshold), None), "model_name").first()
            return [(name, i, m, float(row[m])) for m in FOLD_METRICS]

        return work

    # the longest fits first
    order = sorted(names, key=_SLOWEST.index)
    rows = side_by_side([one(name, i) for name in order for i in range(k)], spark, threads)
    return spark.createDataFrame([r for part in rows for r in part], "model_name string, fold int, metric string, value double")


#: models from the slowest fit to the fastest
_SLOWEST = ["boosted_trees_b", "boosted_trees_a", "random_forest", "mlp", "logistic_regression", "decision_tree", "naive_bayes"]


def timed_scoring(model: PipelineModel, df: DataFrame, name: str) -> tuple[float, int]:
    """Seconds and rows of a full batch scoring run; nothing is brought to the driver."""
    began = time.perf_counter()
    score(model, df, name).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began, df.count()


def rank_candidates(metrics: DataFrame, primary: str = "pr_auc") -> list[str]:
    """Model names, best first (one row per deployed model)."""
    return [r["model_name"] for r in metrics.orderBy(F.col(primary).desc_nulls_last(), "model_name").collect()]


def first_loadable(names: Sequence[str], folder: str) -> tuple[str, PipelineModel]:
    """The best model that can be read; the next one is tried when reading fails."""
    problems = {}
    for name in names:
        try:
            return name, PipelineModel.load(f"{folder}/{name}")
        except Exception as e:  # any unreadable artifact falls through to the next
            problems[name] = str(e)[:200]
    raise ValueError(f"no loadable model: {problems}")


def save_model(model: PipelineModel, folder: str, name: str, tier: str) -> str:
    path = f"{folder}/{name}_{tier}"
    model.write().overwrite().save(path)
    return path
