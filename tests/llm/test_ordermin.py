import hashlib
import random
from collections import Counter

import pytest

from riskengine.llm import neighbours, ordermin


def edited(rows):
    """(doc_id, n_chars, sha256 of the edited text) by falling id; equal ids only with equal texts."""
    order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - third] + n[:third]).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("slot_bytes", [1000, 16_000_000])
def test_edited_texts(docs, clashing, slot_bytes, monkeypatch):
    monkeypatch.setattr(neighbours, "SLOT_BYTES", slot_bytes)
    df = docs.where("doc_id is not null or text like 'unnamed%'")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = ordermin.fingerprints(df).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == edited(rows)
    assert len(ordermin.fingerprints(clashing).collect()) == clashing.count()
    by_text = {}
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == ordermin.likeness(r.fingerprint, r.edited_fingerprint)


def test_order_matters_and_share_follows(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for i in range(40):
        a, b = " ".join(word() for _ in range(100)), " ".join(word() for _ in range(100))
        rows += [(4 * i, a + " " + b), (4 * i + 1, b + " " + a), (4 * i + 2, a + " " + " ".join(word() for _ in range(100)))]
    got = {r.doc_id: r for r in ordermin.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = lambda x: sum(ordermin.likeness(got[4 * i].fingerprint, got[4 * i + x].fingerprint) ** 2 for i in range(40)) / 40
    # the same k-mers with halves exchanged keep about half of their pairs; half of the k-mers keep a ninth
    assert 0.35 < near(1) < 0.65
    assert 0.05 < near(2) < 0.2
    # a third replaced, by text that is in part alike: shares lie somewhat above (1/2)**2
    share = sum(r.near_edited**2 for r in got.values()) / len(got)
    assert 0.2 < share < 0.4


def test_repeated_kmers_are_numbered():
    import numpy as np

    raw = np.frombuffer(b"a" * 50, dtype=np.uint8)
    assert len(set(ordermin.numbered_kmers(raw, ordermin.code_points(raw)).tolist())) == 50 - ordermin.K + 1


def test_single_row_and_empty_table(spark, empty):
    assert ordermin.fingerprints(empty).collect() == []
    one = ordermin.fingerprints(spark.createDataFrame([(5, "abcdefghijkl")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(12, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefghabcd").hexdigest()


def test_rows_without_id_share_out(spark, monkeypatch):
    """Ten thousand rows without an id stand in many slots, in the one order."""
    monkeypatch.setattr(neighbours, "SLOT_BYTES", 4000)
    rows = [(None, f"text number {i} of many") for i in range(10_000)] + [(i, f"text {i}") for i in range(300)] + [(9, f"nine {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    slots = neighbours.in_slots(docs)
    sizes = [r["count"] for r in slots.where("seat = 0").groupBy("slot").count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 40 and max(sizes) < 1500
    hashes = {(r.doc_id, r.text): r.th for r in slots.where("seat = 0").collect()}
    order = sorted(rows, key=lambda r: (-r[0] if r[0] is not None else 1 << 63, hashes[r]))
    want = Counter()
    for k, (i, t) in enumerate(order):
        third = len(t) // 3
        want[(i, hashlib.sha256((t[: len(t) - third] + order[(k + 1) % len(order)][1][:third]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in ordermin.fingerprints(docs).collect()) == want
