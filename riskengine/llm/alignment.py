"""Alignment of two tokenizers' tokens by their byte ends, with merge-path partitioning.

A text's tokens of a byte-level vocabulary (A) and of a piece vocabulary (B) cover the same bytes. Merging the two
sorted lists of token ends gives one link (A token, B token) per distinct end, and one group per end that both share.
The merge of all texts of a block is one long path; diagonals at equal distances cut it into pieces
of ``PIECE`` steps, and a binary search on each diagonal finds how many ends of either list lie before it.
Each piece is merged by itself and emits its overlaps; where equal ends fall to both sides of a diagonal
the two pieces are stitched there. A very long text is so merged in many pieces of the same size.

Tokens are found word by word: a space after a character that is no white space ends a token in both
vocabularies, so a text is cut there and each distinct stretch of a task is encoded once. That stands on two facts,
tested against whole texts: the pre-tokenizer of A ends a piece at such a gap, and no piece of B has its space mark after another character.

How many documents hold an id pair linked is counted over all documents in Spark: each document's distinct
pairs are stored as a list, exploded, counted with map-side combine and joined back. The table of counts is bounded by the
product of the vocabularies and grows slowly; it is broadcast below ``BROADCAST_PAIRS`` rows, else joined by a shuffle, where the adaptive
skew join splits the most common pairs.

Defined results: a null or empty text, or one whose joined A or B bytes differ from space+text (a text with
the character U+2581), has no tokens: zeros and an empty ``groups_sha256``. Special tokens' strings are plain text. Equal rows are documents of
their own, also in the counts. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.store import materialise, small_batches

PIECE = 1 << 16
BLOCK_CHARS = 1 << 19
CACHE_TOKENS = 8_000_000
BROADCAST_PAIRS = 4_000_000
_GAP = re.compile(r"(?<=\S) ")


def vocabularies() -> tuple[str, str]:
    """The public vocabularies of this machine; give their paths on others."""
    import sys

    if "/opt/tokenizers" not in sys.path:
        sys.path.append("/opt/tokenizers")
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Ragged:
    """Lists of ids, appended to and gathered by number."""

    def __init__(self):
        self.values, self.starts, self.n, self.used = np.zeros(1 << 12, np.int32), np.zeros(1 << 10, np.int64), 0, 0

    def extend(self, lists: list) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.concatenate([np.asarray(x, np.int32) for x in lists]) if len(lists) else np.zeros(0, np.int32)
        while self.used + len(flat) > len(self.values):
            self.values = np.concatenate((self.values, np.zeros_like(self.values)))
        while self.n + len(lists) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        self.values[self.used : self.used + len(flat)] = flat
        self.starts[self.n + 1 : self.n + 1 + len(lists)] = self.used + np.cumsum(sizes)
        self.used += len(flat)
        self.n += len(lists)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists numbered ``at`` in a row, and their sizes."""
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        index = np.arange(ends[-1] if len(ends) else 0)
        index += np.repeat(self.starts[at] - ends + sizes, sizes)
        return self.values[index], sizes


def _figures(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..size-1, one spare place behind each, and how many digits each has."""
    width = len(str(size - 1)) + 1
    text = [str(i).encode() for i in range(size)]
    return np.array([np.frombuffer(t.ljust(width), np.uint8) for t in text]), np.array([len(t) for t in text])


class Encoders:
    """Both vocabularies in one Python worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        told = json.loads(self.a.to_str())
        # the printable stand-ins of bytes in a byte-level vocabulary
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, i in told["model"]["vocab"].items():
            self.bytes_a[i] = bytes(byte_of[c] for c in entry if c in byte_of)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(size)
        ]
        self.space = [self.b.piece_to_id("▁")]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.figures = _figures(max(len(self.bytes_a), size))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids_a, self.ids_b, self.whole = Ragged(), Ragged(), np.zeros(0, bool)

    def encode(self, texts: list[str]) -> tuple[list, list, list]:
        """A ids of space+text, B ids of text, and whether both give the text's bytes back."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        # an empty stretch is the space before it alone, which B does not write for an empty text
        b = [ids if t else self.space for ids, t in zip(self.b.encode(texts, num_threads=1), texts, strict=True)]
        same = []
        for t, x, y in zip(texts, a, b, strict=True):
            raw = (" " + t).encode()
            same.append(b"".join([self.bytes_a[i] for i in x]) == raw and b"".join([self.bytes_b[i] for i in y]) == raw)
        return a, b, same

    def _add(self, texts: list[str]) -> None:
        a, b, same = self.encode(texts)
        self.ids_a.extend(a)
        self.ids_b.extend(b)
        self.whole = np.concatenate((self.whole, same))

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids, tokens per text, B ids, tokens per text; a text that does not come back has none."""
        if self.ids_a.used > CACHE_TOKENS:
            self.forget()
        known, numbers, new = self.known, [], []
        for t in texts:
            cut = _GAP.split(t) if t else []
            for s in cut:
                if s not in known:
                    known[s] = len(known)
                    new.append(s)
            numbers.append(np.fromiter(map(known.__getitem__, cut), np.int64, len(cut)))
        self._add(new)
        apart = [i for i, at in enumerate(numbers) if not self.whole[at].all()]
        if apart:
            # a stretch did not come back: the whole text decides
            for i, a, b, same in zip(apart, *self.encode([texts[i] for i in apart]), strict=True):
                numbers[i] = np.zeros(0, np.int64)
                if same:
                    numbers[i] = np.array([len(known)])
                    known[f"\0{len(known)}\0 whole text"] = len(known)
                    self.ids_a.extend([a])
                    self.ids_b.extend([b])
                    self.whole = np.append(self.whole, True)
        sizes = np.array([len(at) for at in numbers])
        flat = np.concatenate([np.zeros(0, np.int64), *numbers])
        out = []
        for table in (self.ids_a, self.ids_b):
            ids, counts = table.take(flat)
            upto = np.concatenate(([0], np.cumsum(counts)))
            edges = np.concatenate(([0], np.cumsum(sizes)))
            out += [ids, np.diff(upto[edges])]
        return tuple(out)


@lru_cache(maxsize=2)
def encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


def diagonals(a: np.ndarray, b: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first ``steps`` of the merge of two ascending lists, equal ones of ``a``
    first: a binary search on each diagonal, all at once."""
    lo, hi = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        early = np.zeros(len(steps), bool)
        early[open_] = a[mid[open_]] <= b[steps[open_] - 1 - mid[open_]]
        lo = np.where(open_ & early, mid + 1, lo)
        hi = np.where(open_ & ~early, mid, hi)


def merged(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ends (distinct, ascending), the A and the B token that each link joins, and whether both tokens end there.

    ``a`` and ``b``: strictly ascending token ends with the same last one."""
    total = len(a) + len(b)
    steps = np.append(np.arange(0, total, piece), total)
    taken = diagonals(a, b, steps)
    ends, links_a, links_b, cuts = [], [], [], []
    for d0, d1, i0, i1 in zip(steps[:-1].tolist(), steps[1:].tolist(), taken[:-1].tolist(), taken[1:].tolist(), strict=True):
        j0, j1 = d0 - i0, d1 - i1
        mine_a, mine_b = a[i0:i1], b[j0:j1]
        if i0 and j0 < j1 and a[i0 - 1] == b[j0]:
            # the stitch: this end was emitted by the piece before, where only the A token was seen to end
            cuts[-1][-1] = True
            mine_b = mine_b[1:]
            j0 += 1
        both = np.concatenate((mine_a, mine_b))
        both.sort(kind="stable")
        if len(both):
            both = both[np.append(True, both[1:] != both[:-1])]
        at_a, at_b = np.searchsorted(mine_a, both), np.searchsorted(mine_b, both)
        cut = np.zeros(len(both), bool)
        here = (at_a < len(mine_a)) & (at_b < len(mine_b))
        cut[here] = mine_a[at_a[here]] == mine_b[at_b[here]]
        if len(both):
            ends.append(both)
            links_a.append(at_a + i0)
            links_b.append(at_b + j0)
            cuts.append(cut)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(ends or none), np.concatenate(links_a or none), np.concatenate(links_b or none), np.concatenate(cuts or [np.zeros(0, bool)])


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, cuts: np.ndarray, figures) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all texts in a row as bytes, and where the part of each token begins (A tokens
    of a group, then its B tokens); ``cuts`` are the ends of the groups."""
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    upto_a, upto_b = np.searchsorted(ends_a, cuts, side="right"), np.searchsorted(ends_b, cuts, side="right")
    before_b = np.concatenate(([0], upto_b))
    at_a = np.arange(len(ids_a)) + before_b[group_a]
    at_b = np.arange(len(ids_b)) + upto_a[group_b]
    n = len(ids_a) + len(ids_b)
    ids, marks = np.zeros(n, np.int64), np.zeros(n, np.uint8)
    ids[at_a], ids[at_b] = ids_a, ids_b
    marks[at_a] = np.where(ends_a == cuts[group_a], ord("|"), ord(","))
    marks[at_b] = np.where(ends_b == cuts[group_b], ord(";"), ord(","))
    digits, sizes = figures
    wide, size = digits[ids], sizes[ids]
    wide[np.arange(n), size] = marks
    starts = np.concatenate(([0], np.cumsum(size + 1)))
    return wide[np.arange(digits.shape[1])[None, :] <= size[:, None]], starts


def align(coder: Encoders, texts: list[str]) -> dict[str, list]:
    """Per text n_a, n_b, n_groups, n_links, groups_sha256, pairs (distinct, ascending), times."""
    ids_a, count_a, ids_b, count_b = coder.tokens(texts)
    ends_a, ends_b = np.cumsum(coder.length_a[ids_a]), np.cumsum(coder.length_b[ids_b])
    ends, link_a, link_b, is_cut = merged(ends_a, ends_b)
    cuts = ends[is_cut]
    written, starts = group_texts(ids_a, ids_b, ends_a, ends_b, cuts, coder.figures)
    pair = ids_a[link_a].astype(np.int64) * len(coder.bytes_b) + ids_b[link_b]
    upto_a = np.concatenate(([0], np.cumsum(count_a)))
    upto_b = np.concatenate(([0], np.cumsum(count_b)))
    # the last byte of each text, which every list of ends has
    edge = np.concatenate(([0], ends_a))[upto_a]
    upto_link, upto_cut = np.searchsorted(ends, edge, side="right"), np.searchsorted(cuts, edge, side="right")
    out = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")}
    out["n_a"], out["n_b"] = count_a.tolist(), count_b.tolist()
    out["n_groups"], out["n_links"] = np.diff(upto_cut).tolist(), np.diff(upto_link).tolist()
    at = starts[upto_a + upto_b]
    for i in range(len(texts)):
        found, times = np.unique(pair[upto_link[i] : upto_link[i + 1]], return_counts=True)
        out["pairs"].append(found)
        out["times"].append(times)
        out["groups_sha256"].append(hashlib.sha256(written[at[i] : at[i + 1] - 1].tobytes()).hexdigest() if count_a[i] else "")
    return out


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def _lists(parts: list[np.ndarray], dtype) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype), *parts]).astype(dtype)))


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoders(path_a, path_b)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BLOCK_CHARS):
                    size += len(texts[hi])
                    hi += 1
                got = align(coder, texts[lo:hi])
                columns = [batch.column("doc_id").slice(lo, hi - lo), *[pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]]
                columns += [pa.array(got["groups_sha256"], pa.string()), _lists(got["pairs"], np.int64), _lists(got["times"], np.int32)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                lo = hi

    return run


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document, stored: its alignment and its distinct linked id pairs (A id * size of B + B id)."""
    small_batches(docs.sparkSession)
    own = vocabularies() if path_a is None or path_b is None else (None, None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_aligned(path_a or own[0], path_b or own[1]), _ALIGNED)
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "align-documents")


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(pair, k: documents that hold it linked, best: whether k is the largest of its A id)."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("k"))
    counts = materialise(counts.withColumn("a", F.expr(f"pair div {size_b}")), "align-pairs")
    most = counts.groupBy("a").agg(F.max("k").alias("most"))
    return counts.join(most, "a").select("pair", "k", (F.col("k") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    path_b = path_b or vocabularies()[1]
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    found = aligned(docs, path_a, path_b)
    counts = materialise(pair_counts(found, size_b), "align-counts")
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    links = found.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "pair"}).join(counts, "pair")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"), F.sum(F.col("times") * F.col("k")).alias("count_sum"))
    # every document has a row of its own, so the keys are even
    none = F.lit(0).cast("long")
    return found.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256"
    )
