import hashlib

import pytest
from tokenizers import Tokenizer

from corvane.llm import bpe, langid
from corvane.llm.common import materialise

from . import helpers, test_chunk_dedup, test_mixing, test_near_dedup

pipeline = pytest.importorskip("corpus_pipeline")


def by_rank(rows):
    return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))


def stagewise(spark, folder):
    """Runs each stage on the one before it and holds it against brute force. Returns the last stage's rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    model = langid.fit(docs)
    rows = docs.collect()
    kept = [(r, p) for r, p in zip(rows, model.predict([r.text for r in rows])) if p[0] != "und" and p[1] >= pipeline.MIN_SCORE]
    out = materialise(pipeline.language_id(spark, docs, folder), "t1")
    assert out.columns == columns
    assert sorted((str(r.doc_id), r.text, r.lang) for r in out.collect()) == sorted((str(r.doc_id), r.text, r.lang or p[0]) for r, p in kept)

    rows = by_rank(out.collect())
    want = []
    for r, (_, gone, text) in zip(rows, test_chunk_dedup.brute([(r.doc_id, r.text) for r in rows])):
        want.append((str(r.doc_id), text, len(text) if gone else r.n_chars))
    out = materialise(pipeline.line_dedup(spark, out, folder), "t2")
    assert out.columns == columns
    assert sorted(map(repr, ((str(r.doc_id), r.text, r.n_chars) for r in out.collect()))) == sorted(map(repr, want))

    rows = by_rank(out.collect())
    groups = {tuple(g) for g in test_near_dedup.brute([(i, r.text) for i, r in enumerate(rows)])}
    firsts = sorted(min(map(int, g)) for g in groups)
    out = materialise(pipeline.near_dups(spark, out, folder), "t3")
    assert out.columns == columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted((str(rows[i].doc_id), rows[i].text) for i in firsts)

    rows = out.collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(test_mixing.WORD.findall(r.text or ""))
    out = materialise(pipeline.mix_sources(spark, out, folder), "t4")
    assert out.columns == columns
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + len(test_mixing.WORD.findall(r.text))
        assert (r.doc_id, r.text) in {(x.doc_id, x.text) for x in rows}
    return out, sizes, taken, rows


def test_stages(spark, sf):
    out, sizes, taken, rows = stagewise(spark, sf)
    for s, t in test_mixing.brute_targets(sizes).items():
        largest = max(len((r.text or "").split()) for r in rows if r.source == s)
        assert abs(taken.get(s, 0) - t) <= largest / 2

    library = Tokenizer.from_file(bpe.vocabulary())
    want = []
    for r in out.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = pipeline.byte_bpe(spark, out, sf).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256) for r in got) == sorted(want)
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)


def test_run_on_awkward_rows(spark, tmp_path):
    folder = helpers.write(helpers.table(spark), tmp_path)
    stagewise(spark, folder)
    assert pipeline.run(spark, folder).count() > 0


def test_run_on_an_empty_table(spark, tmp_path):
    assert pipeline.run(spark, helpers.write(helpers.empty(spark), tmp_path)).collect() == []


def test_stages_are_the_five(spark):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mix_sources", "byte_bpe"]
