import math
import re

from corvane.llm import mixing

from . import helpers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """sizes by source -> targets, filling up and sharing again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        if not rest:
            return full
        share = {s: (total - sum(full.values())) * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        full |= {s: cap * sizes[s] for s in over}


def check(spark, folder, near=None):
    """taken of each source within the share near of its target, else within half of the source's largest document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()
    sizes, largest = {}, {}
    for r in docs:
        n = len(WORD.findall(r.text or ""))
        sizes[r.source], largest[r.source] = sizes.get(r.source, 0) + n, max(largest.get(r.source, 0), n)
    want = brute_targets(sizes)
    got = mixing.query(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in docs)
    by_target = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.size >= 0 and r.taken == r.copies * r.size and abs(r.copies - r.rate) < 1 + 1e-6
        by_target.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    assert sorted({(sizes[s], round(want[s], 6)) for s in sizes}) == sorted(by_target)
    for (size, target), taken in by_target.items():
        of = [s for s in sizes if (sizes[s], round(want[s], 6)) == (size, target)]
        assert abs(sum(taken) - len(of) * target) <= sum((near * target if near else largest[s] / 2) + 0.01 for s in of)
    return got


def test_targets_and_taken(spark, sf):
    check(spark, "/root/testdata/sf0.01", 0.01)
    got = check(spark, sf)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.query(spark, sf).collect()))


def test_reruns_agree_whatever_the_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = [sorted(map(repr, mixing.mix(d).select("doc_id", "__cv_rate", "__cv_copies").collect())) for d in (docs, docs.repartition(7, "lang"))]
    assert some[0] == some[1]


def test_rates_solve_the_constraints_and_differ_inside_a_source(spark, sf):
    rows = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet")).select("source", "__cv_size", "__cv_rate", "__cv_target", "__cv_source_size", "__cv_lambda", "__cv_mu", "__cv_mean").collect()
    by = {}
    for r in rows:
        if r["__cv_size"]:
            by.setdefault(r.source, []).append(r)
    whole = [(r["__cv_size"], math.log2(r["__cv_size"])) for of in by.values() for r in of]
    mean = sum(n * z for n, z in whole) / sum(n for n, _ in whole)
    differ = 0
    for of in by.values():
        target, mu = of[0]["__cv_target"], of[0]["__cv_mu"]
        total = sum(r["__cv_size"] * r["__cv_rate"] for r in of)
        assert abs(total - target) < 1e-6 * target and abs(of[0]["__cv_mean"] - mean) < 1e-6
        if mu is None:
            assert abs(target - 3 * of[0]["__cv_source_size"]) < 1e-6 * target and all(r["__cv_rate"] == 3 for r in of)
            continue
        drift = sum(r["__cv_size"] * r["__cv_rate"] * (math.log2(r["__cv_size"]) - mean) for r in of)
        assert abs(drift + mixing.RIDGE * target * mu) < 1e-6 * target
        before = sum(r["__cv_size"] * (math.log2(r["__cv_size"]) - mean) for r in of) / of[0]["__cv_source_size"]
        assert abs(drift / target) <= abs(before) + 1e-9
        differ += max(r["__cv_rate"] for r in of) - min(r["__cv_rate"] for r in of) > 1e-3
        for r in of:
            x = r["__cv_lambda"] + mu * (math.log2(r["__cv_size"]) - mean)
            assert abs(r["__cv_rate"] - 3 / (1 + 2 * math.exp(-x))) < 1e-9
    assert differ > len(by) / 2


def test_capped_sources_pass_their_excess_on(spark, tmp_path):
    rows = [(i, "w " * (1 + i % 7), None, s, 1, 1, "", 1) for i in range(600) for s in (["a"] if i < 20 else ["b"] if i < 50 else ["c", None])]
    check(spark, helpers.write(helpers.table(spark, rows), tmp_path), 0.005)


def test_many_sources(spark, tmp_path):
    rows = [(i, "w " * (1 + i % 50), None, f"host{i % 300}" if i % 300 else None, 1, 1, "", 1) for i in range(2400)]
    check(spark, helpers.write(helpers.table(spark, rows), tmp_path))


def test_awkward_rows(spark, tmp_path):
    check(spark, helpers.write(helpers.table(spark), tmp_path))


def test_empty_table(spark, tmp_path):
    assert check(spark, helpers.write(helpers.empty(spark), tmp_path)) == []


def test_mixed_keeps_the_columns_and_repeats_rows(spark):
    docs = helpers.table(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r["__cv_copies"] for r in mixing.mix(docs).collect())
