import gzip
import hashlib
import io
import random
import zlib
from collections import Counter

import pytest

from riskengine.llm import warc


def rows():
    rng = random.Random(6)
    big = "ä" * 700
    body = lambda n: "".join(rng.choice("abc <>é") for _ in range(n))
    out = [(i, f"http://h/{i}", body(rng.choice([5, 900, 3000]))) for i in range(40)]
    return out + [(50, "u", big), (51, "u\r\nx", big), (52, None, big), (53, "s", "short"), (54, "s", "short"), (55, "n", None), (56, "n", ""), (None, "z", big), (57, "r", body(5000)), (52, None, big)]


def wanted(pages):
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    top = {}
    for i, _u, t in pages:
        if len((t or "").encode()) >= 1000 and i is not None:
            top[sha(t)] = max(i, top.get(sha(t), i))
    out = []
    for i, _u, t in pages:
        to = top.get(sha(t))
        out.append((i, len((t or "").encode()), sha(t), "response" if to is None or to == i else "revisit", None if to == i else to))
    return Counter(out)


def read(spark, pages, **how):
    manifest = warc.write_archives(pages, **how)
    return warc.read_archives(spark, manifest)


def test_round_trip(spark):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    found = read(spark, pages, archive_bytes=4000)
    got = warc.records(found)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()) == wanted(rows())
    html = {r[0]: r[2] or "" for r in rows()}
    for r in got.where("record_type = 'response' and page_id is not null").collect():
        assert bytes(r.payload).decode() == html[r.page_id]
    assert warc.quarantined(found).collect() == []


def test_clashing_names_and_empty_table(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    more = pages.withColumns({n: F.lit("x") for n in "payload digest top n refers_to path".split()})
    got = warc.records(read(spark, more))
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()) == wanted(rows())
    assert read(spark, pages.where("false")).collect() == []


def archive(n=12):
    return [warc.record_bytes(i, f"http://x/{i}", (f"<p>{i}</p>" * (40 * i + 1)).encode(), None) for i in range(n)]


def salvaged(data):
    found = list(warc.salvage(io.BytesIO(data)))
    # records and gaps cover the file without overlap
    at = 0
    for f in found:
        assert f["offset"] == at
        at += f["length"]
    assert at == len(data)
    return [f["page_id"] for f in found if f["reason"] is None], [f for f in found if f["reason"] is not None]


def test_undamaged_plain_and_gzip():
    parts = archive()
    assert salvaged(b"".join(parts)) == (list(range(12)), [])
    assert salvaged(b"".join(map(gzip.compress, parts))) == (list(range(12)), [])
    assert salvaged(b"") == ([], [])


def test_salvage_gzip():
    members = [warc.member(p) for p in archive()]
    spoilt = bytearray(members[4])
    spoilt[len(spoilt) // 2] ^= 0xFF
    data = b"junk at start" + b"".join(members[:4]) + bytes(spoilt) + members[5] + members[6][:-9] + b"".join(members[7:]) + members[3][:20]
    ids, gaps = salvaged(data)
    assert ids == [0, 1, 2, 3, 5, 7, 8, 9, 10, 11]
    assert [g["length"] for g in gaps] == [13, len(members[4]), len(members[6]) - 9, 20]


def test_salvage_plain():
    parts = archive()
    wrong = parts[3].replace(b"<p>3</p>", b"<p>4</p>", 1)  # the digest tells
    data = b"".join(parts[:3]) + wrong + parts[4] + parts[5][:-30] + b"".join(parts[6:]) + b"\x1f\x8b\x08 WARC/1.1\r\n nothing"
    ids, gaps = salvaged(data)
    assert ids == [0, 1, 2, 4, 6, 7, 8, 9, 10, 11]
    assert len(gaps) == 3


def test_random_damage_never_invents_records():
    rng = random.Random(9)
    parts = archive(20)
    packed = b"".join(warc.member(p) for p in parts)
    good = set(range(20))
    for _ in range(60):
        data = bytearray(packed)
        for _ in range(rng.randint(1, 4)):
            a = rng.randrange(len(data))
            if rng.random() < 0.5:
                data[a] ^= 1 << rng.randrange(8)
            else:
                del data[a : a + rng.randint(1, 300)]
        ids, gaps = salvaged(bytes(data))
        assert set(ids) <= good and len(ids) == len(set(ids)) and len(ids) >= 6


def inner(data):
    found = list(warc.salvage(io.BytesIO(data)))
    return [f["page_id"] for f in found if f["reason"] is None], [f for f in found if f["reason"] is not None], found


def test_archive_compressed_as_a_whole():
    parts = archive(30)
    whole = b"".join(parts)
    ids, gaps, found = inner(gzip.compress(whole))
    assert (ids, gaps) == (list(range(30)), [])
    for f in found:
        assert whole[f["inner_offset"] : f["inner_offset"] + f["length"]] == parts[f["page_id"]]
    # two such members, a single one between them
    ids, gaps, found = inner(gzip.compress(b"".join(parts[:9])) + warc.member(parts[9]) + gzip.compress(b"".join(parts[10:])))
    assert (ids, gaps) == (list(range(30)), [])
    assert [f["page_id"] for f in found if f["inner_offset"] is None] == [9]


def test_failed_record_inside_a_member():
    parts = archive(12)
    parts[3] = parts[3].replace(b"<p>3</p>", b"<p>4</p>", 1)
    parts[7] = parts[7].replace(b"WARC/1.1", b"WARC/9.1", 1)
    ids, gaps, _found = inner(gzip.compress(b"junk" + b"".join(parts) + b"more junk"))
    assert ids == [0, 1, 2, 4, 5, 6, 8, 9, 10, 11]
    assert [g["length"] for g in gaps] == [4, len(parts[3]), len(parts[7]), 9]
    assert all(g["offset"] == 0 and g["inner_offset"] is not None for g in gaps)


@pytest.mark.parametrize("chunk", [64, 1 << 16])
def test_member_that_breaks_off(chunk, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(warc, "READ_BYTES", 4096)
    rng = random.Random(4)
    noise = lambda i: bytes(rng.randrange(32, 127) for _ in range(3000 + i))
    parts = [warc.record_bytes(i, "http://x", noise(i), None) for i in range(40)]
    packed = gzip.compress(b"".join(parts[:30]))
    after = b"".join(warc.member(p) for p in parts[30:])
    # cut off: the records before stay, so do all later members
    ids, gaps, _found = inner(packed[: len(packed) * 2 // 3] + after)
    assert ids[-10:] == list(range(30, 40)) and ids[:-10] == list(range(len(ids) - 10)) and 18 <= len(ids) - 10 <= 20
    assert len(gaps) == 1 and gaps[0]["offset"] + gaps[0]["length"] == len(packed) * 2 // 3
    # a false checksum at the end: only the last record is unconfirmed
    spoilt = packed[:-8] + bytes(4) + packed[-4:]
    ids, gaps, _found = inner(spoilt + after)
    assert ids == [*range(29), *range(30, 40)] and len(gaps) == 1


def test_inflated_bytes_are_not_held_whole(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 4096)
    most = 0
    drop = warc._Input.drop

    def watched(self, before):
        nonlocal most
        drop(self, before)
        most = max(most, len(self.data))

    monkeypatch.setattr(warc._Input, "drop", watched)
    data = gzip.compress(b"".join(warc.record_bytes(i, "http://x", random.Random(i).randbytes(2000), None) for i in range(500)))
    assert inner(data)[0] == list(range(500))
    assert most < 200_000 < len(data)


def test_members_are_standard_gzip():
    part = archive(2)[1]
    assert gzip.decompress(warc.member(part)) == part
    assert zlib.decompress(warc.member(part), 31) == part
