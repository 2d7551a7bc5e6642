import random

import numpy as np

from corvane.llm import near_dedup as nd

from . import helpers


def bag(text):
    return nd.shingles(nd.word_hashes(text.encode()))


def brute(rows):
    """{position: positions of its class} by comparing all pairs."""
    bags = [bag(t or "") for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(bags[i]) and len(bags[j]) and min(len(bags[i]), len(bags[j])) >= 0.8 * max(len(bags[i]), len(bags[j])) and nd.similarity(bags[i], bags[j]) >= 0.8:
                up[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return sorted(sorted(map(str, g)) for g in groups.values() for _ in g)


def check(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = nd.query(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    sizes = sorted((str(r.class_id), r.class_size) for r in got)
    want = sorted((min(g, key=lambda x: (x == "None", int(x) if x != "None" else 0)), len(g)) for g in brute(rows))
    assert sorted(sizes) == want
    assert sum(r.stays for r in got) == sum(1 / r.class_size for r in got).__round__()
    return got


def test_equals_all_pairs(spark, sf):
    assert any(r.class_size > 1 for r in check(spark, sf))


def variants(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        yield " ".join(w)


def test_awkward_rows_and_a_large_group(spark, tmp_path):
    texts = [*variants(150, 200, 4, 1), *variants(40, 60, 4, 2), *variants(60, 300, 14, 3)]
    more = [(100 + i, t, None, None, None, 1, "", 1) for i, t in enumerate(texts)]
    check(spark, helpers.write(helpers.table(spark, [*helpers.ROWS, *more]), tmp_path))


def test_empty_table(spark, tmp_path):
    assert check(spark, helpers.write(helpers.empty(spark), tmp_path)) == []


def test_agreement_is_the_weighted_jaccard():
    rng = np.random.default_rng(3)
    found, want = [], []
    for _ in range(300):
        ids = rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64)
        a, b = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
        x, y = np.sort(np.repeat(ids, a)), np.sort(np.repeat(ids, b))
        least = nd.bag_minhash([x, y])
        found.append((least[0] == least[1]).mean())
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(nd.similarity(x, y) - want[-1]) < 1e-12
    assert abs(np.mean(found) - np.mean(want)) < 0.01


def test_signatures_do_not_depend_on_the_batch():
    bags = [bag(" ".join(f"w{i % 7} v{j}" for j in range(i))) for i in range(1, 60)]
    together = nd.bag_minhash(bags)
    assert all((nd.bag_minhash([b])[0] == together[i]).all() for i, b in enumerate(bags))


def test_chains_are_one_component(spark):
    from corvane.operators.graph import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (7, 7)], "a long, b long")
    labels = {r.node: r.label for r in components(edges).collect()}
    assert {labels[i] for i in range(101)} == {0} and labels[201] == 200


def test_pairs_of_a_large_group_without_a_hub(spark):
    """Members of a group whose hubs are like none of them are compared in blocks, each pair once, and only links between components come out."""
    from pyspark.sql import functions as F

    texts = list(variants(40, 200, 1, 5))
    pairs = [" ".join(f"g{i // 2} {i // 2}t{j}" for j in range(150)) + (" tail" if i % 2 else "") for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts[:1], *pairs])], "__cv_uid long, text string")
    live = docs.select(F.lit(9).cast("long").alias("bucket"), F.lit(3).alias("i"), F.col("__cv_uid").alias("uid"), F.length("text").cast("long").alias("chars"))
    signed = [nd.bag_minhash([bag(t)]) for t in [texts[0], *pairs]]
    shared = [[-i if k < 3 else 7 for k in range(nd.BANDS)] for i in range(61)]
    reps = spark.createDataFrame([(i, nd.one_byte(s)[0].view(np.int8).tolist(), b) for i, (s, b) in enumerate(zip(signed, shared))], "uid long, bytes array<tinyint>, bands array<long>")
    hubs = spark.createDataFrame([(9, 0)], "bucket long, hub long")
    labels = spark.createDataFrame([], "node long, label long")
    for size in (1024, 7):
        nd.BLOCK, was = size, nd.BLOCK
        try:
            got = nd._rest_of_groups(docs, "text", live, hubs, labels, reps, 0.8).collect()
        finally:
            nd.BLOCK = was
        assert sorted(sorted((r.a, r.b)) for r in got) == [[2 * i + 1, 2 * i + 2] for i in range(30)]


def test_elements_overlap_as_bags_do():
    rng = np.random.default_rng(4)
    for _ in range(100):
        x, y = (np.sort(rng.integers(0, 30, n).astype(np.uint64)) for n in rng.integers(1, 80, 2))
        ex, ey = nd.elements(x), nd.elements(y)
        common = len(np.intersect1d(ex, ey))
        assert abs(common / (len(ex) + len(ey) - common) - nd.similarity(x, y)) < 1e-12


def test_groups_whose_links_lie_near_the_threshold(spark, tmp_path):
    """No member is close to the text that all were made from, so links are few and hubs join little."""
    rng, texts = random.Random(11), []
    for lo, hi, n in ((2, 7, 200), (3, 8, 300)):
        base = [f"v{lo}{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(n):
            w = list(base)
            for _ in range(rng.randint(lo, hi)):
                w[rng.randrange(200)] = f"y{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    got = check(spark, helpers.write(helpers.table(spark, [(i, t, None, None, None, 1, "", 1) for i, t in enumerate(texts)]), tmp_path))
    assert sum(not r.stays for r in got) > 60


def test_columns_pass_through(spark):
    docs = helpers.table(spark)
    out = nd.deduplicate(docs)
    assert sorted(map(repr, out.select(docs.columns).collect())) == sorted(map(repr, docs.collect()))
