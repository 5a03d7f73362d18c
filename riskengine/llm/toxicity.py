"""Toxicity by non-negative positive-unlabelled learning.

Features of a text are the counts, as log(1 + n), of its lower-cased words and word beginnings (4 to 8 bytes), hashed; words
are runs of letters. A linear classifier is trained in numpy from confirmed toxic documents and unlabelled
ones by the non-negative risk

    prior * E_toxic[l(g)] + max(0, E_unlabelled[l(-g)] - prior * E_toxic[l(-g)])

with the logistic loss l; where the second part falls below zero its gradient is turned round (ascent on
the unlabelled part), as it then measures overfitting. The prior is the share of toxic documents among the labelled
ones. The intercept is set so that the mean score of the unlabelled documents is the prior.

Documented bounds: at most about ``MAX_POSITIVE`` toxic and ``MAX_UNLABELLED`` unlabelled documents, drawn by a hash
of the id, are fitted on, and the ``FEATURES`` hashed features that set the two apart best.
Scoring covers every document.

Defined results: a text without features, null included, gets the score of the intercept alone; without any
confirmed toxic document every score is 0. Labels of one id that contradict each other count as toxic. Labels, languages,
sources and ids are no inputs of a score. An empty table gives an empty table. Other columns of the
inputs are ignored by ``score`` and kept by ``without_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.folds import chance, held_out, learnable
from riskengine.llm.store import materialise, small_batches
from riskengine.llm.textbytes import Substrings, U, blocks, string_parts, words

BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6, 7, 8)
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 20_000
FEATURES = 4096
LEAST_DOCS = 3
LEAST_LIFT = 1.5
THRESHOLD = 0.3
STEPS = 400

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[ord("a") : ord("z") + 1] = False
_BETWEEN[0x80:] = False


def text_features(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashed features with repeats) of each text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = string_parts(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    for lo, _hi, raw, offs in blocks(data, offsets):
        starts, ends, at = words(raw, offs, _BETWEEN)
        if not len(starts):
            for i in range(len(offs) - 1):
                yield lo + i, np.zeros(0, dtype=np.int64)
            continue
        subs = Substrings(raw)
        owner = np.repeat(np.arange(len(offs) - 1), np.diff(at))
        found, owners = [subs.hash(starts, ends) ^ U(1)], [owner]
        for n in BEGINNINGS:
            long = np.flatnonzero(ends - starts > n)
            found.append(subs.hash(starts[long], starts[long] + n))
            owners.append(owner[long])
        index = (np.concatenate(found) >> U(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        index, cuts = index[order], np.searchsorted(owner[order], np.arange(len(offs)))
        for i in range(len(offs) - 1):
            yield lo + i, index[cuts[i] : cuts[i + 1]]


@dataclass
class Classifier:
    """Linear weights over chosen hashed features."""

    features: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = -np.inf

    def __post_init__(self):
        self.slot = np.full(BUCKETS, -1, dtype=np.int32)
        self.slot[self.features] = np.arange(len(self.features))

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.intercept)
        for i, found in text_features(column):
            slots = self.slot[found]
            slots = slots[slots >= 0]
            if len(slots):
                kinds, counts = np.unique(slots, return_counts=True)
                out[i] += np.log1p(counts) @ self.weights[kinds]
        return 1 / (1 + np.exp(-np.clip(out, -700, 700))) * np.isfinite(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Sparse:
    """Rows of (feature, value) in numpy arrays."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(r[0]) for r in rows])
        self.col = np.concatenate([r[0] for r in rows]).astype(np.int64) if rows else np.zeros(0, dtype=np.int64)
        self.value = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.col], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=self.value * g[self.row], minlength=self.width)


def fit_nnpu(positive: Sparse, unlabelled: Sparse, prior: float, steps: int = STEPS, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative risk, by Adam on all rows."""
    w, b = np.zeros(positive.width), np.log(prior / (1 - prior))
    m = np.zeros(len(w) + 1)
    v = np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        gp, gu = positive.dot(w) + b, unlabelled.dot(w) + b
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        toward_p = -prior * _sigmoid(-gp) / positive.n  # of prior * l(g)
        away_u, away_p = _sigmoid(gu) / unlabelled.n, -prior * _sigmoid(gp) / positive.n  # of the second part
        if negative >= 0:
            on_p, on_u = toward_p + away_p, away_u
        else:
            on_p, on_u = -away_p, -away_u
        grad = np.append(positive.back(on_p) + unlabelled.back(on_u) + ridge * w, on_p.sum() + on_u.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    # the intercept at which the unlabelled documents are toxic as often as the prior says
    base, low, high = unlabelled.dot(w), -60.0, 60.0
    for _ in range(80):
        b = (low + high) / 2
        low, high = (b, high) if _sigmoid(base + b).mean() < prior else (low, b)
    return w, b


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per hashed feature the toxic and the unlabelled documents of this task that have it."""
    seen = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        positive = batch.column("positive").to_pylist()
        for i, found in text_features(batch.column("text")):
            seen[0 if positive[i] else 1, np.unique(found)] += 1
    kinds = np.flatnonzero(seen.any(axis=0))
    for a in range(0, len(kinds), 50_000):
        part = kinds[a : a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(seen[0, part]), pa.array(seen[1, part])], names=["feature", "p", "u"])


def _rows(features: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Classifier(features, np.zeros(len(features)), 0.0)
        for batch in batches:
            kinds, values = [], []
            for _i, found in text_features(batch.column("text")):
                slots = chosen.slot[found]
                k, c = np.unique(slots[slots >= 0], return_counts=True)
                kinds.append(k.tolist())
                values.append(np.log1p(c).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(kinds, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], names=["positive", "kinds", "values"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit on the documents that may be learned from; labels: (doc_id, toxic)."""
    small_batches(docs.sparkSession)
    marks = labels.where(F.col("toxic").isNotNull() & learnable()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(learnable())
    sizes = ids.join(marks, "doc_id", "left").agg(F.count(F.lit(1)).alias("all"), F.count("toxic").alias("labelled"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not sizes["toxic"] or sizes["toxic"] == sizes["labelled"] == sizes["all"]:
        return Classifier()
    prior = min(max(sizes["toxic"] / sizes["labelled"], 1e-4), 1 - 1e-4)
    positives = marks.where("toxic = 1").where(chance("doc_id", 3) < MAX_POSITIVE / sizes["toxic"]).select("doc_id", F.lit(True).alias("positive"))
    rest = ids.where(chance("doc_id", 4) < MAX_UNLABELLED / sizes["all"]).select("doc_id", F.lit(False).alias("positive"))
    drawn = positives.unionByName(rest.distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # bounded by the two sample sizes
    sample = materialise(texts.join(drawn, "doc_id").select("positive", "text"), "toxicity-sample")
    n = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(True) or not n.get(False):
        return Classifier()
    counts = sample.mapInArrow(_document_counts, "feature long, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share_p, share_u = F.col("p") / n[True], F.col("u") / n[False]
    apart = (share_p - share_u) / F.sqrt((F.col("p") + F.col("u") + 1) / (n[True] + n[False]) / n[True])
    chosen = counts.where((F.col("p") >= min(LEAST_DOCS, n[True])) & (share_p >= LEAST_LIFT * share_u)).orderBy(apart.desc(), "feature").limit(FEATURES).select("feature").toArrow()
    features = np.sort(chosen["feature"].to_numpy())
    table = sample.mapInArrow(_rows(features), "positive boolean, kinds array<int>, values array<double>").toArrow()
    groups: dict[bool, list] = {True: [], False: []}
    for batch in table.to_batches():
        offsets = batch.column("kinds").offsets.to_numpy()
        kinds, values = (batch.column(c).values.to_numpy() for c in ("kinds", "values"))
        for i, positive in enumerate(batch.column("positive").to_pylist()):
            at = slice(offsets[i], offsets[i + 1])
            groups[positive].append((kinds[at].astype(np.int64), values[at].astype(np.float64)))
    del table
    # in one order whatever tasks ended first, so that fits agree
    for rows in groups.values():
        rows.sort(key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes()))
    weights, intercept = fit_nnpu(Sparse(groups[True], len(features)), Sparse(groups[False], len(features)), prior)
    return Classifier(features, weights, float(intercept))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.value.scores(batch.column("_text"))
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))], names=[*names, "score", "predicted"])

    return run


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def text_score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(pa.array(texts, pa.string())))

    return docs.where(text_score(F.col("text").cast("string")) < THRESHOLD)
