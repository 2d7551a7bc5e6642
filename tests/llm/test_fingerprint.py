import hashlib
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from corvane.llm import fingerprint as fp

from . import helpers


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed)
    return seed


def brute_marks(text, size=fp.SIZE):
    """[(hash, first position)] of the sketch, of all anchors with size None"""
    if not text:
        return []
    t = fp.PAD * (fp.K - fp.S) + text + fp.PAD * (fp.K - 1)
    h = [signed(xxhash.xxh64_intdigest(t[i : i + fp.S].encode(), seed=42)) for i in range(len(t) - fp.S + 1)]
    out, last = {}, fp.K - fp.S
    for i in range(len(h) - last):
        w = h[i : i + last + 1]
        if min(w) in (w[0], w[-1]):
            out.setdefault(chain((h[i], h[i + fp.S], h[i + 2 * fp.S])) & 0xFFFFFFFF, i)
    return [x for i, x in enumerate(sorted(out.items())) if size is None or i < size or x[0] < 2**32 // fp.ONE_IN]


def brute_likeness(a, b):
    if not a and not b:
        return 1.0
    to = min(2**32 - 1 if len(x) < fp.SIZE else max(x[fp.SIZE - 1][0], 2**32 // fp.ONE_IN - 1) for x in (a, b))
    a, b = ({h for h, _ in x if h <= to} for x in (a, b))
    return len(a & b) / len(a | b)


def brute_aligned(a, b):
    """(distance, number)"""
    places = dict(b)
    found = Counter(places[h] - p for h, p in a if h in places)
    return min((-n, d) for d, n in found.items())[::-1] if found else (0, 0)


def brute(rows):
    """rows of (doc_id, text) -> the query's rows"""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest(r[1].encode(), seed=42)), r[1]))
    text = lambda x: "".join(f"{h << 31 | p:016x}" for h, p in x)
    out = []
    for i, (k, t) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        part = len(t) // 3
        edited = t[: len(t) - part] + other[:part]
        a, b, c = brute_marks(t), brute_marks(edited), brute_marks(other)
        near, far = brute_aligned(a, b), brute_aligned(a, c)
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), brute_likeness(a, b), brute_likeness(a, c), abs(near[1]), abs(far[1]), far[0]))
    return out


def check(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in fp.query(spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))
    return got


def test_equals_brute_force(spark, sf):
    got = check(spark, sf)
    long = [r for r in got if r[1] > 300]
    assert sum(r[5] for r in long) / len(long) > 0.4 and sum(r[6] for r in long) / len(long) < 0.1


def test_many_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 7)
    rows = [(i * i % 101 if i % 9 else None, f"text {i} " * (i % 13), None, None, None, 1, "", 1) for i in range(150)]
    check(spark, helpers.write(helpers.table(spark, rows), tmp_path))


def test_awkward_rows(spark, tmp_path):
    more = [(40, "😀" * 40, None, None, None, 1, "", 1), (41, "a😀é日" * 3000, None, None, None, 1, "", 1), (42, "x" * 9000, None, None, None, 1, "", 1)]
    check(spark, helpers.write(helpers.table(spark, [*helpers.ROWS, *more]), tmp_path))


def test_one_row_and_empty_table(spark, tmp_path):
    check(spark, helpers.write(helpers.table(spark, helpers.ROWS[3:4]), tmp_path))
    assert check(spark, helpers.write(helpers.empty(spark), tmp_path)) == []


def test_anchors_do_not_depend_on_the_context(spark):
    passage = helpers.LONG[:3000]
    rows = spark.createDataFrame([("x" + passage,), (passage + "yz",)], "t string").select(fp.anchors(F.col("t"), None).alias("m")).collect()
    a, b = ({x >> 31: x & (2**31 - 1) for x in r.m} for r in rows)
    same = set(a) & set(b)
    assert len(same) > 0.9 * len(a) and sum(a[h] == b[h] + 1 for h in same) > 0.95 * len(same)


def test_unbounded_anchors_are_exact_and_matched_by_position(spark):
    one, other = helpers.LONG[:40_000], "other words first " * 3 + helpers.LONG[20_000:60_000]
    c = lambda n: F.col(n)
    marks = spark.createDataFrame([(one, other)], "a string, b string").select(fp.anchors(c("a"), None).alias("a"), fp.anchors(c("b"), None).alias("b"))
    r = marks.select("a", "b", fp.likeness(c("a"), c("b"), None).alias("l"), fp.aligned(c("a"), c("b")).alias("m")).first()
    a, b = brute_marks(one, None), brute_marks(other, None)
    assert [x >> 31 for x in r.a] == [h for h, _ in a] and [x & (2**31 - 1) for x in r.b] == [p for _, p in b]
    assert r.l == len({h for h, _ in a} & {h for h, _ in b}) / len({h for h, _ in a} | {h for h, _ in b})
    assert r.m.distance == len("other words first ") * 3 - 20_000 and r.m.n > 0.9 * r.l * len(a)
