"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over 32 bytes cuts every text into chunks of about a kilobyte, at the same places in
equal passages wherever they stand. Documents are dealt to tasks by their smallest chunk hash, so that copies
and near copies meet; within a task a chunk is encoded once and its tokens are reused. Each chunk join is then repaired: the
stretch around it, from a few word gaps before to a few after, is encoded anew; where the new tokens agree with the
chunks' own tokens on both margins they replace those in between, else the stretch is widened, at
last to the whole text. A gap between a character that is no white space and an ASCII white space always
ends a piece of the byte-level pre-tokenizer, so agreement at such gaps is agreement with the encoding
of the whole text.

Defined results: a null text is an empty text; it has no tokens. Special tokens' strings inside a text get
their special ids, as the library does by default. Equal rows give equal rows; an empty table gives
an empty table. Other columns, also ones named like those used here, pass untouched.

A very common smallest chunk is salted: of the documents of an input task that share it, each further
64 go to another task.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.store import small_batches
from riskengine.llm.textbytes import Substrings, U, blocks, string_parts

WINDOW = 32
MASK = U(1023)
LONGEST = 1 << 14
CACHE_TOKENS = 16_000_000
SALT = 64
MARGINS = (2, 8, 1 << 40)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def default_vocabulary() -> str:
    """The public byte-level vocabulary of this machine; give its path on others."""
    import sys

    if "/opt/tokenizers" not in sys.path:
        sys.path.append("/opt/tokenizers")
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def chunk_bounds(raw: np.ndarray, offs: np.ndarray, subs: Substrings) -> list[np.ndarray]:
    """Per text the byte positions where its chunks begin and end."""
    n = len(raw)
    cut = np.zeros(n + 1, dtype=bool)
    if n > WINDOW:
        at = np.arange(WINDOW, n)
        rolled = subs.sums[at] - subs.sums[at - WINDOW]
        rolled *= subs.inverse[at - WINDOW]
        rolled *= U(0x9E3779B97F4A7C15)
        cut[at] = ((rolled >> U(40)) & MASK) == 0
        cut[at] &= (raw[at] & 0xC0) != 0x80
    cuts = np.flatnonzero(cut)
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        inner = cuts[np.searchsorted(cuts, a + WINDOW, side="left") : np.searchsorted(cuts, b, side="left")]
        ends = np.concatenate(([a], inner, [b])) if b > a else np.array([a])
        if len(ends) > 1 and np.diff(ends).max() > LONGEST:
            more = []
            for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                more.append(x)
                while y - x > LONGEST:
                    x += LONGEST
                    while (raw[x] & 0xC0) == 0x80:
                        x -= 1
                    more.append(x)
            ends = np.array([*more, b])
        out.append(ends)
    return out


def _route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        data, offsets = string_parts(batch.column("_text"))
        routes, salts = [], []
        for _lo, _hi, raw, offs in blocks(data, offsets):
            subs = Substrings(raw)
            for ends in chunk_bounds(raw, offs, subs):
                key = int(subs.hash(ends[:-1], ends[1:]).min().view(np.int64)) if len(ends) > 1 else 0
                routes.append(key)
                salts.append(seen[key] // SALT)
                seen[key] += 1
        if len(seen) > 1_000_000:
            seen = Counter({k: v for k, v in seen.items() if v > 1})
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(routes, pa.int64()), pa.array(salts, pa.int64())], names=[*batch.schema.names, "_route", "_salt"])


class Codec:
    """One vocabulary in one Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        told = json.loads(self.tokenizer.to_str())
        # the printable stand-ins of bytes in a byte-level vocabulary
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        pieces = [b""] * size
        for piece, i in told["model"]["vocab"].items():
            pieces[i] = bytes(byte_of[c] for c in piece)
        for added in told["added_tokens"]:
            pieces[added["id"]] = added["content"].encode()
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        figures = [f"{i},".encode() for i in range(size)]
        width = max(map(len, figures))
        self.figures = np.array([np.frombuffer(f.ljust(width), dtype=np.uint8) for f in figures])
        self.figure_mask = np.arange(width)[None, :] < np.array([len(f) for f in figures])[:, None]
        self.cache: dict[tuple[int, int], np.ndarray] = {}
        self.cached = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_text(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return self.figures[ids][self.figure_mask[ids]].tobytes()[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def chunk_tokens(self, keys: list[tuple[int, int]], texts: dict) -> dict[tuple[int, int], np.ndarray]:
        new = [k for k in texts if k not in self.cache]
        if new:
            if self.cached > CACHE_TOKENS:
                self.cache, self.cached, new = {}, 0, list(texts)
            for k, ids in zip(new, self.encode([texts[k]() for k in new]), strict=True):
                self.cache[k] = ids
                self.cached += len(ids)
        return {k: self.cache[k] for k in keys}


def gaps(raw: np.ndarray) -> np.ndarray:
    """Positions of ASCII white space after a character that is surely none, within one text."""
    n = len(raw)
    if n < 2:
        return np.zeros(0, dtype=np.int64)
    before = raw[:-1]
    sure = (before > 0x20) & (before < 0x7F)
    wide = before >= 0x80
    if wide.any():
        # the code points above 0x7F that are white space start with one of these bytes
        wide[1:] &= before[:-1] != 0xC2
        wide[2:] &= ~np.isin(before[:-2], (0xE1, 0xE2, 0xE3))
        sure |= wide
    return np.flatnonzero(sure & _SPACE[raw[1:]]) + 1


def _windows(joins: np.ndarray, stops: np.ndarray, margin: int) -> list[tuple[int, int, int, int]]:
    """(from, inner from, inner to, to) around joins, overlapping ones as one."""
    k = np.searchsorted(stops, joins, side="left")
    last = len(stops) - 1
    cols = (stops[np.maximum(k - margin, 0)], stops[np.maximum(k - 1, 0)], stops[np.minimum(k, last)], stops[np.minimum(k + margin - 1, last)])
    out: list[tuple[int, int, int, int]] = []
    for a, x, y, b in zip(*(c.tolist() for c in cols), strict=True):
        if out and a <= out[-1][3]:
            out[-1] = (out[-1][0], out[-1][1], max(out[-1][2], y), max(out[-1][3], b))
        else:
            out.append((a, x, y, b))
    return out


class _Doc:
    """A text whose chunk joins are under repair."""

    def __init__(self, raw: np.ndarray, joins: np.ndarray, ids: np.ndarray, codec: Codec):
        self.raw, self.joins, self.ids = raw, joins, ids
        self.ends = np.concatenate(([0], np.cumsum(codec.lengths[ids])))
        self.stops = np.concatenate(([0], gaps(raw), [len(raw)])) if len(joins) else None
        self.margin = 0

    def windows(self) -> list[tuple[int, int, int, int]]:
        return _windows(self.joins, self.stops, MARGINS[self.margin])

    def index(self, at: int) -> int:
        """Number of tokens before a byte position; -1 if it lies inside one."""
        k = int(np.searchsorted(self.ends, at))
        return k if k < len(self.ends) and self.ends[k] == at else -1

    def repair(self, windows: list[tuple[int, int, int, int]], new: list[np.ndarray], codec: Codec) -> bool:
        """Put the new stretches in, if each agrees with the chunks' tokens on its margins."""
        parts, done = [], 0
        for (a, x, y, b), ids in zip(windows, new, strict=True):
            ia, ib = self.index(a), self.index(b)
            if ia < 0 or ib < 0:
                return False
            left, right = self.index(x) - ia, ib - self.index(y)
            if a > 0 and (left < 0 or not np.array_equal(ids[:left], self.ids[ia : ia + left])):
                return False
            if b < len(self.raw) and (self.index(y) < 0 or not np.array_equal(ids[len(ids) - right :], self.ids[ib - right : ib])):
                return False
            parts += [self.ids[done:ia], ids]
            done = ib
        self.ids = np.concatenate([*parts, self.ids[done:]])
        return True


def encode_texts(raw: np.ndarray, offs: np.ndarray, codec: Codec) -> list[np.ndarray]:
    """Token ids of each text of a buffer."""
    subs = Substrings(raw)
    bounds = chunk_bounds(raw, offs, subs)
    text_at = lambda a, b: raw[a:b].tobytes().decode("utf-8", "replace")
    keys, texts, flat = [], {}, []
    for ends in bounds:
        own = [(h, b - a) for h, a, b in zip(subs.hash(ends[:-1], ends[1:]).tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for k, a, b in zip(own, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            texts.setdefault(k, lambda a=a, b=b: text_at(a, b))
        keys.append(own)
        flat += own
    found = codec.chunk_tokens(flat, texts)
    docs = []
    for own, ends in zip(keys, bounds, strict=True):
        ids = np.concatenate([found[k] for k in own]) if own else np.zeros(0, dtype=np.int32)
        docs.append(_Doc(raw[ends[0] : ends[-1]], ends[1:-1] - ends[0], ids, codec))
    open_ = [d for d in docs if len(d.joins)]
    while open_:
        plans = [d.windows() for d in open_]
        got = codec.encode([d.raw[a:b].tobytes().decode("utf-8", "replace") for d, w in zip(open_, plans, strict=True) for a, _x, _y, b in w])
        left, k = [], 0
        for d, w in zip(open_, plans, strict=True):
            if not d.repair(w, got[k : k + len(w)], codec):
                d.margin += 1
                left.append(d)
            k += len(w)
        open_ = left
    return [d.ids for d in docs]


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            data, offsets = string_parts(batch.column("_text"))
            count, ids_sha, text_sha, packed = [], [], [], []
            for _lo, _hi, raw, offs in blocks(data, offsets):
                for ids in encode_texts(raw, offs, codec):
                    count.append(len(ids))
                    ids_sha.append(hashlib.sha256(codec.ids_text(ids)).hexdigest())
                    text_sha.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                    packed.append(ids.astype("<i4").tobytes())
            rest = [batch.column(n) for n in batch.schema.names if n != "_text"]
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(packed, pa.binary())],
                names=[*names, "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
            )

    return run


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids): ``ids`` as little-endian 32-bit integers."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"))
    dealt = rows.mapInArrow(_route, "doc_id long, _text string, _route long, _salt long").repartition("_route", "_salt")
    return dealt.select("doc_id", "_text").mapInArrow(_encode(vocabulary or default_vocabulary()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            texts = [None if x is None else codec.decode(np.frombuffer(x, dtype="<i4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text); null ids give a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(vocabulary or default_vocabulary()), "doc_id long, text string")
