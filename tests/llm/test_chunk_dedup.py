import hashlib

from corvane.llm import chunk_dedup

from . import helpers

SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """rows (id, text) in order -> (id, removed lines, remaining text): neighbouring lines that an earlier place has, by comparing lines themselves."""
    seen, out = {}, []
    for at, (doc_id, text) in enumerate(rows):
        lines, gone = [] if text is None else text.split("\n"), set()
        for i, (a, b) in enumerate(zip(lines, lines[1:])):
            if a.strip(SPACES) or b.strip(SPACES):
                first = seen.setdefault((a, b), (at, i))
                if first[0] != at or i >= first[1] + 2:
                    gone |= {i, i + 1}
        kept = "".join(x + "\n" * (i < len(lines) - 1) for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, len(gone), None if text is None else kept))
    return out


def by_rank(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def check(spark, folder):
    rows = by_rank(spark, folder)
    got = chunk_dedup.query(spark, folder).collect()
    want = [(d, len((t or "").split("\n")) if t is not None else 0, len(t or ""), len(k or ""), hashlib.sha256((k or "").encode()).hexdigest()) for (d, _, k), (_, t) in zip(brute(rows), rows)]
    assert sorted(map(repr, ((r.doc_id, r.n_lines, r.n_chars, r.n_kept_chars, r.kept_sha256) for r in got))) == sorted(map(repr, want))
    for r in got:
        spans = [tuple(map(int, x.split("-"))) for x in r.removed_spans.split()]
        assert len(spans) == r.n_removed_runs and all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and r.n_chars - r.n_kept_chars == sum(e - s for s, e in spans)
    return got


def test_equals_brute_force(spark, sf):
    assert any(r.n_removed_runs for r in check(spark, sf))


def test_chunks_cover_the_text_and_resist_shifts():
    lines = [f"line {i * i % 1009} with words" for i in range(400)]
    cs = chunk_dedup.chunks(lines)
    assert [i for a, b in cs for i in range(a, b)] == list(range(400))
    other = ["new first line", *lines[:200], "new middle line", *lines[200:]]
    a, b = ({tuple(x[s:e]) for s, e in chunk_dedup.chunks(x)} for x in (lines, other))
    assert len(a & b) >= len(a) - 4


def test_awkward_rows(spark, tmp_path):
    block = "\n".join(f"shared line {i}" for i in range(40))
    more = [(20 + i, f"own {i}\n{block}\nend {i}", None, None, None, 1, "", 1) for i in range(200)]
    got = check(spark, helpers.write(helpers.table(spark, [*helpers.ROWS, *more]), tmp_path))
    assert sum(bool(r.n_removed_runs) for r in got) >= 199


def test_empty_table(spark, tmp_path):
    assert check(spark, helpers.write(helpers.empty(spark), tmp_path)) == []


def test_no_run_is_missed(spark, tmp_path):
    """Runs of two lines and more between own lines, at each place in a text, go whole."""
    runs = [[f"run {i} line {j} says something" for j in range(2 + i % 4)] for i in range(40)]
    texts = ["\n".join([f"own {i} {k}", *r, f"end {i} {k}"]) for k in range(2) for i, r in enumerate(runs)]
    texts += ["again\nagain\nagain\nagain\nagain", "x\ny\nx\ny\nx\ny", "\n".join(runs[3]) + "\n", "\n".join(runs[3]), "x\n\n\n\ny", "x\n\n\n\ny\n", "\n\n\n", "\n\n\n"]
    folder = helpers.write(helpers.table(spark, [*helpers.ROWS, *((20 + i, t, None, None, None, 1, "", 1) for i, t in enumerate(texts))]), tmp_path)
    got = {r.doc_id: r for r in check(spark, folder)}
    assert all(got[60 + i].n_kept_chars == len(f"own {i} 1\nend {i} 1") for i in range(40))


def test_blank_lines_at_the_end_tell_pieces_apart(spark, tmp_path):
    texts = ["l3 a\nm3 b", "l3 a\nm3 b\n\n", "q\nl3 a\nm3 b\nr"]
    folder = helpers.write(helpers.table(spark, [(i, t, None, None, None, 1, "", 1) for i, t in enumerate(texts)]), tmp_path)
    check(spark, folder)


def test_chunks_alone_are_found_and_hold_their_pairs():
    text = "\n".join(f"line {i} of a passage" for i in range(60))
    found = [(k, s, e) for k, s, e in chunk_dedup.pieces(text) if k == chunk_dedup.CHUNK]
    rows = [{"kind": k, "s": s, "e": e, "original": text[s:e]} for k, s, e in found]
    kept, starts, ends = chunk_dedup.cut_lines(text, rows)
    assert sum(e - s for s, e in zip(starts, ends)) == len(text) - len(kept) > len(text) / 2
    changed = [dict(r, original=r["original"].replace("passage", "message")) for r in rows]
    assert chunk_dedup.cut_lines(text, changed)[0] == text


def test_columns_pass_through(spark):
    docs = helpers.table(spark)
    out = chunk_dedup.deduplicate(docs)
    others = [c for c in docs.columns if c != "text"]
    assert sorted(map(repr, out.select(others).collect())) == sorted(map(repr, docs.select(others).collect()))
