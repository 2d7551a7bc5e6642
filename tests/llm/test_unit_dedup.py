import json

from corvane.llm import unit_dedup

from . import helpers


def brute(rows):
    """rows of (doc_id, text) in rank order -> [(doc_id, spans, kept)]"""
    seen, out = set(), []
    for doc_id, text in rows:
        spans, kept = [], []
        for s, e in unit_dedup.split_units(text or ""):
            u = unit_dedup.normalise(text[s:e])
            if len(u.split()) >= unit_dedup.MIN_WORDS and u in seen:
                spans.append({"start": s, "end": e})
            else:
                kept.append(text[s:e])
                if len(u.split()) >= unit_dedup.MIN_WORDS:
                    seen.add(u)
        out.append((doc_id, spans, None if text is None else "".join(kept)))
    return out


def check(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    got = [(r.doc_id, json.loads(r.removed_spans), r.kept_text) for r in unit_dedup.query(spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))
    return got


def test_equals_brute_force(spark, sf):
    assert any(s for _, s, _ in check(spark, sf))


def test_awkward_rows(spark, tmp_path):
    line = "This line of more than eight words comes back, in other forms, again."
    more = [(20 + i, f"own {i}\n{line if i % 2 else line.upper().replace(' ', '  ')}\n\nshort\n{line}", None, None, None, 1, "", 1) for i in range(300)]
    check(spark, helpers.write(helpers.table(spark, [*helpers.ROWS, *more]), tmp_path))


def test_empty_table(spark, tmp_path):
    assert check(spark, helpers.write(helpers.empty(spark), tmp_path)) == []


def test_columns_pass_through(spark, tmp_path):
    docs = spark.read.parquet(f"{helpers.write(helpers.table(spark), tmp_path)}/documents.parquet")
    assert set(docs.columns) < set(unit_dedup.deduplicate(docs).columns)


def test_short_lines_and_unspaced_scripts_go(spark, tmp_path):
    verse = "\n".join(f"short line {i}" for i in range(30))
    texts = [f"first\n{verse}\n", f"second\n{verse}\n", "甲\n日本語の長い一行には空白がありません\n", "乙\n日本語の長い一行には空白がありません\n", "-\n- -\n\n", "-\n- -\n\n"]
    rows = [(20 + i, t, None, None, None, 1, "", 1) for i, t in enumerate(texts)]
    got = {r[0]: r[2] for r in check(spark, helpers.write(helpers.table(spark, rows), tmp_path))}
    assert [got[20 + i] for i in range(6)] == [texts[0], "second\n", texts[2], "乙\n", texts[4], texts[5]]


def test_passages_inside_long_lines_go(spark, tmp_path):
    words = lambda k, n: " ".join(f"{'aeiou'[i * k % 5]}{i * k * k * 7919 % 100_003}" for i in range(1, n + 1))
    passage, unspaced = words(17, 60), "".join(chr(0x4E00 + i * i * 31 % 9000) for i in range(1, 61))
    apart = [f"{words(29, 40)} {passage} {words(31, 30)}", f"{words(37, 11)} {passage.upper()} {words(41, 70)}\nend", f"{words(43, 40)}\n{words(47, 5)} {passage}", f"甲乙丙{unspaced}丁", f"{unspaced[::-1]}{unspaced}"]
    rows = [(20 + i, t, None, None, None, 1, "", 1) for i, t in enumerate(apart)]
    got = {r[0] - 20: r for r in check(spark, helpers.write(helpers.table(spark, rows), tmp_path)) if r[0] and r[0] >= 20}
    assert got[0][1] == [] and got[3][1] == []
    for i, inside in ((1, passage.upper()), (2, passage), (4, unspaced)):
        a = apart[i].rindex(inside)
        gone = sum(max(0, min(s["end"], a + len(inside)) - max(s["start"], a)) for s in got[i][1])
        assert all(a <= s["start"] and s["end"] <= a + len(inside) + 1 for s in got[i][1]) and gone >= len(inside) // 3


def test_cuts_depend_on_what_is_near():
    words = [f"w{i * i * 7919 % 100_003}" for i in range(3000)]
    whole, part = " ".join(words), " ".join(words[1000:2000])
    at, edge = whole.index(part), 80
    assert [c for c in unit_dedup.cuts(part) if edge < c < len(part) - edge] == [c - at for c in unit_dedup.cuts(whole) if edge < c - at < len(part) - edge] != []
    assert unit_dedup.cuts(" ".join(words[:25])) == [] and unit_dedup.cuts("the same words " * 50) == []
