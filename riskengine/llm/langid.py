"""Language identification by interpolated Kneser-Ney character models.

Per language a model of order ``ORDER`` over lower-cased letters, everything else being one space. Learned
n-grams and contexts are sorted arrays of 64-bit hashes beside their log probabilities and back-off weights; a text's cross-entropy
is the mean over its characters, and the language with the least is chosen. Each distinct n-gram of a
block of texts is looked up once by binary search.

Learning uses at most about ``MAX_CHARS`` characters of labelled text per language and ``MOST_CHARS`` in all, shared
evenly (documented bounds: whole texts drawn by a hash of the id). Every language that has a learnable text with
a letter is learned, from one text at least. A quarter of the sample serves for calibration, but of a language with fewer than
``SCARCE`` learnable texts all are learned from: the score is a
logistic function of the lead over the second language and the length, and a text is marked as rejected if its cross-entropy is
above what ``REJECT`` of the calibration texts of that language reach.

Defined results: null texts and texts without letters are ``und`` with score 0. With one learned language it
is always chosen; with none, everything is ``und``. Labels, sources and ids are no inputs of a prediction.
An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.folds import chance, held_out, learnable
from riskengine.llm.store import materialise
from riskengine.llm.textbytes import U, mix

ORDER = 4
MAX_CHARS = 4_000_000
MOST_CHARS = 256_000_000
SCARCE = 8
REJECT = 0.999
BLOCK = 1 << 17
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool))
    return _letters[0]


def symbols(text: str) -> np.ndarray:
    """16-bit symbols: letters in lower case, one space for any run of others, three before the text and one
    after it. Letters beyond the first 65,536 code points share symbols. No letters: empty."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letter_table()[points]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of each run of others
    out = np.where(letter, np.where(points < 0x10000, points, 0xE000 + points % 0x1000), 32)[keep]
    first, last = (1 if out[0] == 32 else 0), (len(out) - 1 if out[-1] == 32 else len(out))
    return np.concatenate(([32] * (ORDER - 1), out[first:last], [32])).astype(np.uint64)


def grams(s: np.ndarray) -> np.ndarray:
    """The n-grams of ``ORDER`` symbols, packed."""
    n = len(s) - ORDER + 1
    packed = s[:n].copy()
    for k in range(1, ORDER):
        packed = (packed << U(16)) | s[k : n + k]
    return packed


def _suffix(packed: np.ndarray, n: int) -> np.ndarray:
    return packed & U((1 << 16 * n) - 1) if n < 4 else packed


def _key(packed: np.ndarray, n: int) -> np.ndarray:
    return mix(packed + U(0x9E3779B97F4A7C15 * n % (1 << 64)))


class LanguageModel:
    """Sorted hash arrays of one language: per order the n-grams with log p, the contexts with log weights."""

    def __init__(self, packed: np.ndarray, counts: np.ndarray, alphabet: int):
        levels = [(packed, counts.astype(np.float64))]
        for n in range(ORDER - 1, 0, -1):
            # lower orders count in how many contexts an n-gram is seen, not how often
            kinds, seen = np.unique(_suffix(levels[-1][0], n), return_counts=True)
            levels.append((kinds, seen.astype(np.float64)))
        self.floor = -np.log(alphabet + 1.0)
        self.orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = [None] * (ORDER + 1)
        below = None
        for n in range(1, ORDER + 1):
            kinds, c = levels[ORDER - n]
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = ones / (ones + 2.0 * twos) if ones else 0.5
            discount = min(max(discount, 0.1), 0.9)
            context, at = np.unique(kinds >> U(16), return_inverse=True)
            total = np.bincount(at, weights=c)
            weight = discount * np.bincount(at) / total
            lower = np.full(len(kinds), np.exp(self.floor)) if below is None else below[1][np.searchsorted(below[0], _suffix(kinds, n - 1))]
            p = (c - discount) / total[at] + weight[at] * lower
            below = (kinds, p)
            by_gram, by_context = np.argsort(_key(kinds, n)), np.argsort(_key(context, n))
            self.orders[n] = (_key(kinds, n)[by_gram], np.log(p)[by_gram], _key(context, n)[by_context], np.log(weight)[by_context])

    def log_p(self, packed: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each n-gram after the others."""
        out = np.zeros(len(packed))
        left = np.arange(len(packed))
        for n in range(ORDER, 0, -1):
            g = _suffix(packed[left], n)
            keys, logs, contexts, weights = self.orders[n]
            hit, at = _find(keys, _key(g, n))
            out[left[hit]] += logs[at[hit]]
            left, g = left[~hit], g[~hit]
            if not len(left):
                return out
            hit, at = _find(contexts, _key(g >> U(16), n))
            out[left[hit]] += weights[at[hit]]
        out[left] += self.floor
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def entropies(texts: list[str | None], models: list[LanguageModel]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per text and model, and the number of characters that it is a mean of (0: no letters)."""
    out = np.zeros((len(texts), len(models)))
    sizes = np.zeros(len(texts), dtype=np.int64)
    held, rows, size = [], [], 0

    def flush() -> None:
        nonlocal held, rows, size
        kinds, back = np.unique(np.concatenate(held), return_inverse=True)
        starts = np.concatenate(([0], np.cumsum([len(h) for h in held])))[:-1]
        for k, model in enumerate(models):
            out[rows, k] = -np.add.reduceat(model.log_p(kinds)[back], starts) / sizes[rows]
        held, rows, size = [], [], 0

    for i, text in enumerate(texts):
        s = symbols(text) if text else ()
        if not len(s):
            continue
        g = grams(s)
        sizes[i] = len(g)
        held.append(g)
        rows.append(i)
        size += len(g)
        if size > BLOCK:
            flush()
    if held:
        flush()
    return out, sizes


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def pack() -> pa.RecordBatch:
        nonlocal held, size
        langs, kinds, counts = [], [], []
        for lang, parts in held.items():
            k, c = np.unique(np.concatenate(parts), return_counts=True)
            langs += [lang] * len(k)
            kinds.append(k.view(np.int64))
            counts.append(c)
        held, size = {}, 0
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(kinds), pa.int64()), pa.array(np.concatenate(counts), pa.int64())], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            s = symbols(text or "")
            if len(s):
                held.setdefault(lang, []).append(grams(s))
                size += len(s)
                if size > 4 * BLOCK:
                    yield pack()
    if held:
        yield pack()


class Identifier:
    """Models of all learned languages with their calibration."""

    def __init__(self, names: list[str], models: list[LanguageModel]):
        self.names, self.models = names, models
        self.limits = np.full(len(names), np.inf)
        self.weights = np.array([0.0, 4.0, 0.0])

    def _features(self, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        two = np.partition(h, 1, axis=1)[:, :2] if h.shape[1] > 1 else np.column_stack((h[:, 0], h[:, 0] + 1))
        return np.column_stack((np.ones(len(h)), two[:, 1] - two[:, 0], np.log1p(n) / 10))

    def calibrate(self, h: np.ndarray, n: np.ndarray, truth: list[str]) -> None:
        """Fit the score to how often the choice is right, and the limits to the languages' own texts."""
        filled = n > 0
        h, n, truth = h[filled], n[filled], np.array(truth, dtype=object)[filled]
        if not len(h):
            return
        best = h.argmin(axis=1)
        right = np.array([self.names[b] == t for b, t in zip(best, truth, strict=True)])
        x = self._features(h, n)
        goal = np.where(right, (right.sum() + 1) / (right.sum() + 2), 1 / ((~right).sum() + 2))
        w = self.weights.copy()
        for _ in range(200):  # a few damped Newton steps suffice; ridge keeps them finite
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), x.T @ (goal - p) - 1e-2 * w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        self.weights = w
        for k, name in enumerate(self.names):
            own = h[truth == name, k]
            if len(own):
                self.limits[k] = np.quantile(own, REJECT)
        # languages without calibration texts take the widest limit of the others
        told = np.isfinite(self.limits)
        if told.any():
            self.limits[~told] = self.limits[told].max()

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores, and whether the text is unlike all that was learned."""
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        h, n = entropies(texts, self.models)
        best = h.argmin(axis=1)
        score = 1 / (1 + np.exp(-np.clip(self._features(h, n) @ self.weights, -30, 30)))
        known = n > 0
        names = [self.names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, np.where(known, score, 0.0), ~known | (h[np.arange(len(h)), best] > self.limits[best])


def learn(docs: DataFrame, max_chars: int = MAX_CHARS, most_chars: int = MOST_CHARS) -> Identifier:
    """Fit models and calibration on documents (doc_id, text, lang) that may be learned from. What is gathered
    is bounded by ``most_chars`` and one text per language."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(learnable() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("draw", chance("doc_id", 1))
    # one row per language; the text with the least draw is always learned from
    sizes = materialise(rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n"), F.count(F.lit(1)).alias("texts"), F.min("draw").alias("least")), "lang-sizes")
    languages = sizes.count()
    if not languages:
        return Identifier([], [])
    share = F.lit(float(min(max_chars, most_chars / languages))) / F.col("n")
    first = F.col("draw") == F.col("least")
    fit = first | (F.col("texts") < SCARCE) | (chance("doc_id", 2) < 0.75)
    drawn = materialise(rows.join(sizes, "lang").where(first | (F.col("draw") < share)).select("doc_id", "lang", "text", fit.alias("fit")), "lang-sample")
    # bounded by most_chars
    table = drawn.where("fit").select("lang", "text").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(table["lang"].to_pylist(), dtype=object)
    packed, counts = table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy()
    names = sorted(set(langs))
    alphabet = len(np.unique(packed & U(0xFFFF)))
    models = []
    for name in names:
        own = np.flatnonzero(langs == name)
        own = own[np.argsort(packed[own])]
        models.append(LanguageModel(packed[own], counts[own], alphabet))
    out = Identifier(names, models)
    seen = drawn.where("not fit").select("lang", "text").mapInArrow(_entropy_rows(docs.sparkSession.sparkContext.broadcast(models)), "lang string, h array<double>, n long").toArrow()
    if len(seen) and names:
        out.calibrate(np.array(seen["h"].to_pylist()).reshape(len(seen), -1), seen["n"].to_numpy(), seen["lang"].to_pylist())
    return out


def _entropy_rows(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = entropies(batch.column("text").to_pylist(), models.value)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(list(h), pa.list_(pa.float64())), pa.array(n, pa.int64())], names=["lang", "h", "n"])

    return run


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rejected = model.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: Identifier) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
