"""Document fingerprints by Order MinHash.

A text's k-mers of code points are numbered by occurrence, so that repeats differ. Each of ``SKETCHES``
hash functions selects the ``TUPLE`` smallest of them; they are put back in the order in which they stand in the text
and the tuple is hashed. Moving a passage changes tuples though no k-mer changes, which makes the
share of equal tuples follow edit distance.

The likeness of two fingerprints is the share of equal tuples to the power 1 / ``TUPLE``: 1 for equal
texts, about the share of common k-mers where these keep their order, 0 where nothing is shared.

Defined results: a null text is an empty text; a text shorter than k is one k-mer; the empty text has a
fingerprint of its own, alike only to itself. Documents follow each other by falling ``doc_id``, a null one last,
equal ids by a hash of the text, so a repeated row may be followed by its copy. A table with one row has
itself as its next document. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskengine.llm.neighbours import in_slots
from riskengine.llm.textbytes import Substrings, U, mix, string_parts

K = 8
TUPLE = 2
SKETCHES = 32
BLOCK = 1 << 17

_FACTORS = np.random.default_rng(33).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | U(1)
_NONE = ~U(0)
EMPTY = "0" * (8 * SKETCHES)


def code_points(raw: np.ndarray) -> np.ndarray:
    """Byte positions of the code points, and the end."""
    return np.concatenate((np.flatnonzero((raw & 0xC0) != 0x80), [len(raw)]))


def numbered_kmers(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers of a text in order, each mixed with the number of its earlier occurrences."""
    n = len(at) - 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    subs = Substrings(raw)
    base = subs.hash(at[: n - K + 1], at[K:]) if n >= K else subs.hash(at[:1], at[-1:])
    m = len(base)
    bits = U(max(1, int(m).bit_length()))
    low = (U(1) << bits) - U(1)
    packed = np.sort((base & ~low) | np.arange(m, dtype=np.uint64))
    place = (packed & low).astype(np.int64)
    new = np.concatenate(([True], (packed[1:] & ~low) != (packed[:-1] & ~low)))
    if new.all():
        return mix(base)
    run = np.arange(m)
    earlier = np.empty(m, dtype=np.uint64)
    earlier[place] = (run - np.maximum.accumulate(np.where(new, run, 0))).astype(np.uint64)
    return mix(base + earlier * U(0x9E3779B97F4A7C15))


def _two_least(values: np.ndarray, starts: np.ndarray, low: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The two smallest of each segment; ``values`` is spoilt. Segments end with a filler."""
    one = np.minimum.reduceat(values, starts)
    hit = one[one != _NONE]
    values[(hit & low).astype(np.int64)] = _NONE
    return one, np.minimum.reduceat(values, starts)


def signatures(pairs: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (rows of 32-bit numbers) of texts and of their edited texts, given as (k-mers, edited
    k-mers, number of leading k-mers that both share). The shared part is hashed once."""
    filler = np.full(1, _NONE, dtype=np.uint64)
    parts, lengths = [], []
    for own, edited, shared in pairs:
        for piece in (own[:shared], own[shared:], edited[shared:]):
            parts += [piece, filler]
            lengths.append(len(piece) + 1)
    base = np.concatenate(parts)
    ends = np.cumsum(lengths)
    starts = ends - np.array(lengths)
    fill = ends - 1
    low = (U(1) << U(int(len(base)).bit_length())) - U(1)
    place = np.arange(len(base), dtype=np.uint64)
    high = ~low
    work = np.empty_like(base)
    own_out = np.zeros((len(pairs), SKETCHES), dtype=np.uint32)
    edited_out = np.zeros_like(own_out)
    for i, factor in enumerate(_FACTORS):
        np.multiply(base, factor, out=work)
        work &= high
        work |= place
        work[fill] = _NONE
        one, two = (x.reshape(-1, 3) for x in _two_least(work, starts, low))
        for out, cols in ((own_out, (0, 1)), (edited_out, (0, 2))):
            four = np.sort(np.stack([one[:, cols[0]], two[:, cols[0]], one[:, cols[1]], two[:, cols[1]]], axis=1), axis=1)
            at = np.sort(np.where(four[:, :2] == _NONE, _NONE, four[:, :2] & low), axis=1)
            x, y = (np.where(a == _NONE, U(0), base[np.where(a == _NONE, U(0), a).astype(np.int64)]) for a in (at[:, 0], at[:, 1]))
            out[:, i] = (mix(x * U(3) + mix(y + U(i))) >> U(32)).astype(np.uint32)
    return own_out, edited_out


def _hex(rows: np.ndarray, empty: list[bool]) -> list[str]:
    return [EMPTY if e else row.astype(">u4").tobytes().hex() for row, e in zip(rows, empty, strict=True)]


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    same = np.frombuffer(bytes.fromhex(a), dtype=">u4") == np.frombuffer(bytes.fromhex(b), dtype=">u4")
    return float(same.mean() ** (1 / TUPLE))


def _flush(held: list[dict]) -> pa.RecordBatch:
    own, edited = signatures([h["kmers"] for h in held])
    one = _hex(own, [h["n"] == 0 for h in held])
    two = _hex(edited, [h["edited_n"] == 0 for h in held])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([h["slot"] for h in held], pa.int32()),
            pa.array([h["seat"] for h in held], pa.int32()),
            pa.array([h["doc_id"] for h in held], pa.int64()),
            pa.array([h["n"] for h in held], pa.int64()),
            pa.array([h["sha"] for h in held], pa.string()),
            pa.array(one, pa.string()),
            pa.array(two, pa.string()),
        ],
        names=["slot", "seat", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"],
    )


def _prepare(row: tuple, following: np.ndarray | None) -> dict:
    """Sizes, digest and k-mers of one row; ``following``: bytes of the next text (none for a guest)."""
    slot, seat, doc_id, raw = row
    at = code_points(raw)
    n = len(at) - 1
    keep = n - n // 3
    if following is None:
        edited, edited_at, sha = raw, at, None
    else:
        # the head of the next text that is as long as what it replaces
        ahead = code_points(following[: 4 * (n // 3)])
        taken = min(n // 3, len(ahead) - 1)
        edited = np.concatenate((raw[: at[keep]], following[: ahead[taken]]))
        edited_at = code_points(edited)
        sha = hashlib.sha256(edited.tobytes()).hexdigest()
    own = numbered_kmers(raw, at)
    if following is None:
        return {"slot": slot, "seat": seat, "doc_id": doc_id, "n": n, "edited_n": n, "sha": sha, "kmers": (own, own, len(own))}
    other = numbered_kmers(edited, edited_at)
    shared = max(0, min(keep - K + 1, len(own), len(other)))
    return {"slot": slot, "seat": seat, "doc_id": doc_id, "n": n, "edited_n": len(edited_at) - 1, "sha": sha, "kmers": (own, other, shared)}


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in their order in; each with its fingerprints out. A guest row gets its own fingerprint only."""
    waiting, held, size = None, [], 0
    for batch in batches:
        data, offsets = string_parts(batch.column("text"))
        slots, seats, ids = (batch.column(c).to_pylist() for c in ("slot", "seat", "doc_id"))
        for i in range(len(ids)):
            row = (slots[i], seats[i], ids[i], data[offsets[i] : offsets[i + 1]].copy())
            if waiting is not None and waiting[1] == 0:
                held.append(_prepare(waiting, row[3]))
                size += sum(map(len, held[-1]["kmers"][:2]))
            if row[1] == 1 and (waiting is None or waiting[1] == 0):
                held.append(_prepare(row, None))
                size += 2 * len(held[-1]["kmers"][0])
            waiting = row
            if size > BLOCK:
                yield _flush(held)
                held, size = [], 0
    if held:
        yield _flush(held)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: dict | None = None

    def rows() -> Iterator[dict]:
        nonlocal last
        for batch in _fingerprints(batches):
            for row in batch.to_pylist():
                if last is not None and last["seat"] == 0:
                    yield last | {"next": row["fingerprint"]}
                last = row

    kinds = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string())]

    def pack(part: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([r[n] for r in part], k) for n, k in kinds]
        near = [pa.array([likeness(r["fingerprint"], r[c]) for r in part], pa.float64()) for c in ("edited_fingerprint", "next")]
        return pa.RecordBatch.from_arrays([*arrays, *near], names=[*(n for n, _k in kinds), "near_edited", "near_next"])

    part: list[dict] = []
    for row in rows():
        part.append(row)
        if len(part) >= 2000:
            yield pack(part)
            part = []
    if part:
        yield pack(part)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, the last third of which is replaced by the
    head of the next document, and their likenesses."""
    return in_slots(docs).select("slot", "seat", "doc_id", "text").mapInArrow(_with_next, SCHEMA)
