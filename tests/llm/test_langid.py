import zlib

import numpy as np

from corvane.llm import langid

from . import helpers


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = langid.Network(3, hidden=4, seed=2)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.integers(97, 105, (5, 6))
    x[0, 4:] = langid.PAD
    y = rng.integers(0, 3, 5)
    _, g = net.gradients(x, y)
    for k in net.w:
        for _ in range(12):
            i = tuple(rng.integers(0, n) for n in net.w[k].shape)
            if k == "E":
                i = (i[0], int(rng.integers(97, 105)), i[2])
            old = net.w[k][i]
            values = []
            for d in (1e-3, -1e-3):
                net.w[k][i] = old + d
                values.append(net.gradients(x, y)[0])
            net.w[k][i] = old
            assert abs((values[0] - values[1]) / 2e-3 - g[k][i]) < 2e-4


def test_labels_equal_the_training_pass_and_padding_changes_nothing():
    net = langid.Network(3)
    x, _ = langid.windows([b"some text", b"x" * 48])
    p = net.label(x)
    assert p.shape == (langid.WINDOW, 2, 3) and np.allclose(p.sum(-1), 1, atol=1e-5)
    short = net.label(x[:1, :9])
    assert np.allclose(short[:, 0], p[:9, 0], atol=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = langid.query(spark, sf).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    tested = [r for r in rows if r.held_out and len(langs[r.doc_id][1]) > 100]
    assert sum(r.lang_pred == langs[r.doc_id][0] for r in tested) >= 0.97 * len(tested)


def test_awkward_rows(spark, tmp_path):
    folder = helpers.write(helpers.table(spark, [*helpers.ROWS, (30, "12 34 !?", "en", "a", 1, 1, "", 1)]), tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.query(spark, folder).collect()}
    assert set(model.langs) <= {"en", "fr", "de"} and len(got) == len({r[0] for r in helpers.ROWS}) + 1
    for k in (1, 2, 3, 8, 30):
        assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
    assert got[6].lang_pred in model.langs and got[None].lang_pred in model.langs
    out = langid.identify(docs, model)
    assert sorted(map(repr, out.select(docs.columns).collect())) == sorted(map(repr, docs.collect())) and set(docs.columns) < set(out.columns)


def test_copies_of_one_text_are_learned_once_and_few_reach_the_ranking(spark, monkeypatch):
    copies = [(i, "the same text " * 9, "en", "a", 1, 1, "", 1) for i in range(400)]
    others = [(1000 + i, f"own words {i} " * 9, "en", "a", 1, 1, "", 1) for i in range(400)]
    seen = []
    monkeypatch.setattr(langid.Network, "train", lambda self, x, y: seen.append(len(x)))
    langid.fit(helpers.table(spark, [*copies, *others]), per_lang=20)
    one = sum(langid.windows([t.encode()])[1][0] for t in ["own words 100 " * 9])
    assert len(seen) == 1 and abs(seen[0] - 20 * one) <= 20


def test_empty_table(spark, tmp_path):
    assert langid.query(spark, helpers.write(helpers.empty(spark), tmp_path)).collect() == []
