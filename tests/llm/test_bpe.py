import hashlib
import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from riskengine.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def wanted(library, rows):
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        told = library.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(told.encode()).hexdigest()))
    return Counter(out)


def hard_texts():
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "ß", " ", "  ", "\n", "\r\n", "\t", "'s", "'ll", "7", "42", "!", "...", "<|endoftext|>", " ", "　", " ", "漢字", "😀", "the ", " of", "́", "\x1c", "\x00", "­"]
    for n in (1, 5, 300, 4000):
        for _ in range(6):
            yield "".join(rng.choice(alphabet) for _ in range(n))
    yield "a" * 40000
    yield "é" * 30000
    yield " " * 40000
    yield "漢字かな" * 9000
    yield "<|endoftext|>" * 2000
    base = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(9000))
    yield base
    yield "x" + base
    yield base[5:20000] + base[9000:]


def test_equals_the_library(spark, library, docs, clashing):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + i, t) for i, t in enumerate(hard_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.encode(df.repartition(3))
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == wanted(library, rows)
    back = Counter((r.doc_id, r.text) for r in bpe.decode(got).collect())
    assert back == Counter((i, t or "") for i, t in rows)
    assert len(bpe.encode(clashing).collect()) == clashing.count()


def test_copies_are_encoded_once(library, monkeypatch):
    import numpy as np

    codec = bpe.Codec(bpe.default_vocabulary())
    seen = []
    encode = codec.encode
    monkeypatch.setattr(codec, "encode", lambda texts: seen.append(sum(map(len, texts))) or encode(texts))
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(8000)).encode()
    raw = np.frombuffer(text * 3, dtype=np.uint8)
    got = bpe.encode_texts(raw, np.array([0, len(text), 2 * len(text), 3 * len(text)]), codec)
    assert np.array_equal(got[0], got[1]) and np.array_equal(got[0], got[2])
    assert sum(seen) < 1.3 * len(text)


def test_hot_copies_go_to_several_tasks(spark):
    df = spark.createDataFrame([(i, "same text for all of these rows") for i in range(1000)], "doc_id long, text string").coalesce(1)
    dealt = df.selectExpr("doc_id", "text as _text").mapInArrow(bpe._route, "doc_id long, _text string, _route long, _salt long")
    assert dealt.select("_route").distinct().count() == 1
    assert dealt.select("_salt").distinct().count() == 16


def test_empty_table(empty):
    assert bpe.encode(empty).collect() == []
