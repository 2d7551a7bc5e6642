import hashlib
import random
from collections import Counter

import numpy as np

from corvane.llm import suffix_dedup as sd

from . import helpers


def brute(texts, length=200):
    """[(removed bytes, runs, sha256 of the rest)]"""
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, np.int8)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = 1
        rest = bytes(np.frombuffer(b, np.uint8)[gone[:-1] == 0]) if b else b""
        out.append((int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def check(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in sd.query(spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(repr((r.doc_id, *x)) for r, x in zip(rows, brute([r.text for r in rows])))
    return got


def pieces(rng, n, letters):
    base = [bytes(rng.choice(letters) for _ in range(rng.randrange(50, 500))) for _ in range(6)]
    for _ in range(n):
        p = b"".join(rng.choice(base)[rng.randrange(40) :] for _ in range(rng.randrange(1, 4)))
        yield p + bytes(rng.choice(letters) for _ in range(max(0, 200 - len(p))))


def test_starts_in_pieces_equal_brute_force():
    rng = random.Random(2)
    for letters in (b"abcdefghijklmnopqrstuvwxyz ", b"ab", b"a", b"a" * 30 + b"b"):
        for _ in range(6):
            some = list(pieces(rng, 12, letters))
            counts = Counter(p[i : i + 200] for p in some for i in range(len(p) - 199))
            for p, flags in zip(some, sd.repeated_starts(some)):
                assert [counts[p[i : i + 200]] > 1 for i in range(len(p) - 199)] == flags.tolist()
            often = [1 + (i == 3) for i in range(len(some))]
            for p, flags in zip(some, sd.repeated_starts(some, counts=often)):
                assert [counts[p[i : i + 200]] > 1 or p[i : i + 200] in some[3] for i in range(len(p) - 199)] == flags.tolist()


def test_runs_cover_every_start_once_and_ids_follow_the_string(monkeypatch):
    rng = random.Random(3)
    ids = {}
    for block in (1 << 20, 700):
        monkeypatch.setattr(sd, "BLOCK", block)
        for letters in (b"abcdefgh", b"ab", b"a"):
            text = bytes(rng.choice(letters) for _ in range(3000)) * 2
            starts = []
            for h, s, e in sd.runs(text):
                for p in range(s, e - 199):
                    starts.append(p)
                    assert ids.setdefault(text[p : p + 200], h) == h
            assert starts == list(range(len(text) - 199))
    assert list(sd.runs(b"x" * 199)) == [] and list(sd.runs(b"")) == []


def test_equals_brute_force(spark, sf):
    assert any(r[1] for r in check(spark, sf))


def fixture():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh é") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    out = []
    for i in range(60):
        own = " ".join(word() for _ in range(40))
        out.append(own + passage[rng.randrange(60) : len(passage) - rng.randrange(60)] + (own if i % 7 == 0 else ""))
    return [*out, "A " * 400, "A " * 130, "xyz" * 300, "aaaa" * 100, out[3], out[3], passage[:199], passage[100:301]]


def test_awkward_rows(spark, tmp_path):
    more = [(100 + i, t, None, None, None, 1, "", 1) for i, t in enumerate(fixture())]
    check(spark, helpers.write(helpers.table(spark, [*helpers.ROWS, *more]), tmp_path))


def test_ids_with_many_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sd, "MOST_PIECES", 3)
    more = [(100 + i, t, None, None, None, 1, "", 1) for i, t in enumerate(fixture())]
    check(spark, helpers.write(helpers.table(spark, more), tmp_path))


def test_empty_table(spark, tmp_path):
    assert check(spark, helpers.write(helpers.empty(spark), tmp_path)) == []


def test_a_claim_that_is_wrong_fails(spark, monkeypatch):
    """A digest that takes two texts for one gives no result."""
    import pytest

    docs = helpers.table(spark, [(i, x * 300, None, None, None, 1, "", 1) for i, x in enumerate("ab")])
    numbered = docs.withColumn("__cv_uid", docs.doc_id)
    wrong = spark.createDataFrame([(1, 0, 250, b"a" * 250)], "uid long, s long, e long, original binary")
    monkeypatch.setattr(sd, "numbered", lambda d: numbered.select(*d.columns, "__cv_uid"))
    monkeypatch.setattr(sd, "repeated_spans", lambda *_: wrong)
    with pytest.raises(Exception, match="128-bit digest"):
        sd.deduplicate(docs).collect()


def test_claims_at_one_distance_are_joined():
    import pyarrow as pa

    claims = [dict(s=s, e=s + 300, ruid=r, rs=s + d) for r, d in ((7, 50), (7, -3), (8, 50)) for s in (10, 200, 400, 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([claims])], names=["uid", "claims"])
    got = {tuple(x.values()) for b in sd.joined_claims([batch]) for x in b.to_pylist()}
    assert got == {(1, s, e, r, s + d) for r, d in ((7, 50), (7, -3), (8, 50)) for s, e in ((10, 700), (1000, 1300))}


def test_strings_of_one_key_are_told_apart(monkeypatch):
    """With a hash that tells next to nothing apart, the bytes decide."""
    rng = random.Random(4)
    some = list(pieces(rng, 8, b"abcdefgh "))
    counts = Counter(p[i : i + 200] for p in some for i in range(len(p) - 199))
    monkeypatch.setattr(sd.Rolling, "of", lambda self, starts, ends: np.ones(len(starts), np.uint64))
    monkeypatch.setattr(sd, "BASE", 0)
    for p, flags in zip(some, sd.repeated_starts(some)):
        assert [counts[p[i : i + 200]] > 1 for i in range(len(p) - 199)] == flags.tolist()
