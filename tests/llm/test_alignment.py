import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import words

from riskengine.llm import alignment as L


@pytest.fixture(scope="module")
def coder():
    return L.Encoders(*L.vocabularies())


def whole(coder, text):
    """Tokens of the whole text at once, or none where they do not give its bytes back."""
    if not text:
        return [], []
    a, b = coder.a.encode(" " + text, add_special_tokens=False).ids, coder.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(coder.bytes_a[i] for i in a) != raw or b"".join(coder.bytes_b[i] for i in b) != raw:
        return [], []
    return a, b


def brute(coder, text):
    a, b = whole(coder, text)
    spans = []
    for ids, table in ((a, coder.bytes_a), (b, coder.bytes_b)):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i]), i))
            at += len(table[i])
        spans.append(out)
    links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
    cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
    groups, low = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in spans))
        low = cut
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""


def awkward(rng, n):
    parts = ["a", "th", "ing", " ", "  ", "\n", " \n", "\n ", "é", "ß", "’s", "'ll", "23", "\t", " ", " ", "　", "<s>", "<|endoftext|>", "▁", "日本", "😀", "\0", "\x1c", "\x85", "ﬁ", "é"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_words_give_the_tokens_of_whole_texts(coder):
    rng = random.Random(11)
    texts = awkward(rng, 3000) + [words(rng, 50), "x" * 3000, " ", "word ", " word", "\n"]
    ids_a, count_a, ids_b, count_b = coder.tokens(texts)
    at_a, at_b = (np.concatenate(([0], np.cumsum(c))) for c in (count_a, count_b))
    for i, t in enumerate(texts):
        a, b = whole(coder, t)
        assert ids_a[at_a[i] : at_a[i + 1]].tolist() == a and ids_b[at_b[i] : at_b[i + 1]].tolist() == b, repr(t)


def test_no_piece_has_its_space_inside(coder):
    assert not [p for p in map(coder.b.id_to_piece, range(coder.b.get_piece_size())) if "▁" in p.lstrip("▁")]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_merge_as_the_whole(piece):
    rng = random.Random(piece)
    for _ in range(200):
        last = rng.randint(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, last + 1), rng.randint(0, last)), last})) for _ in range(2))
        ends, link_a, link_b, cut = L.merged(a, b, piece)
        assert ends.tolist() == sorted({*a.tolist(), *b.tolist()})
        assert ends[cut].tolist() == sorted({*a.tolist()} & {*b.tolist()})
        low_a, low_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if low_a[i] < b[j] and low_b[j] < a[i]]
        assert sorted(zip(link_a.tolist(), link_b.tolist(), strict=True)) == want
        # a diagonal takes the first steps of the merge
        steps = np.arange(len(a) + len(b) + 1)
        order = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
        assert L.diagonals(a, b, steps).tolist() == [sum(side == 0 for _v, side in order[:d]) for d in steps]


def test_nothing_to_merge():
    none = np.zeros(0, np.int64)
    assert [len(x) for x in L.merged(none, none)] == [0, 0, 0, 0]


def test_equals_brute_force(spark, coder, monkeypatch):
    rng = random.Random(12)
    rows = list(enumerate([words(rng, rng.randint(1, 40)) for _ in range(30)] + awkward(rng, 60) + [None, "", "▁", "x" * 5000, words(rng, 3000)]))
    rows += [rows[0], rows[0], (None, rows[1][1]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_a", "'x' AS pairs", "2 AS pair", "3 AS k", "4 AS row")
    found = [(i, *brute(coder, t)) for i, t in rows]
    counts = Counter(p for f in found for p in set(f[4]))
    best = defaultdict(int)
    for (a, _b), k in counts.items():
        best[a] = max(best[a], k)
    want = [(i, n_a, n_b, g, len(ls), sum(counts[p] == best[p[0]] for p in ls), sum(counts[p] for p in ls), text) for i, n_a, n_b, g, ls, text in found]
    assert sorted(map(tuple, L.alignments(docs.repartition(3)).collect()), key=repr) == sorted(want, key=repr)
    # a table of counts that is not broadcast
    monkeypatch.setattr(L, "BROADCAST_PAIRS", 0)
    assert sorted(map(tuple, L.alignments(docs).collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_small_cache(spark, coder, monkeypatch):
    assert L.alignments(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    monkeypatch.setattr(L, "CACHE_TOKENS", 5)
    rng = random.Random(13)
    texts = [words(rng, 20) for _ in range(4)]
    first = L.align(coder, texts)
    again = L.align(coder, texts)
    assert first["groups_sha256"] == again["groups_sha256"] == [brute(coder, t)[4] for t in texts]
