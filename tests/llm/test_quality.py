import re
from collections import Counter

import regex

from corvane.llm import quality

from . import helpers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def passes(text, n, chars, symbols, dup_lines):
    """The cascade's rules, read from their names."""
    text = text or ""
    lines = text.split("\n")
    lettered = sum(bool(regex.search(r"\p{L}", w)) for w in WORD.findall(text))
    ends = sum(x.rstrip(" \t\r").endswith(("...", "…")) for x in lines)
    rejected = (
        chars < 1.5 * n or chars > 40 * n, 2 * symbols > 3 * n, 2 * dup_lines > len(lines), 10 * lettered < 3 * n, any(len(x) >= 1000 for x in re.split("[ \t-\r]", text)),
        10 * len(re.findall("[0-9]", text)) > 7 * chars, 10 * ends > 6 * len(lines),
    )
    return not any(rejected)


def check(spark, folder):
    got = [tuple(r) for r in quality.query(spark, folder).collect()]
    want = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        b = brute(r.text)
        want.append((r.doc_id, *b, not b[-1] and passes(r.text, b[0], b[1], b[2], b[3])))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


def test_statistics_equal_brute_force(spark, sf):
    got = check(spark, sf)
    assert sum(x[7] for x in got) > 0.6 * len(got)


def test_awkward_rows(spark, tmp_path):
    words = "some plain words that pass all of the base rules but not another rule as they go on and on to the end of it".split()
    one = " ".join(words)
    odd = [one, " ".join("a" for _ in words[:3]) + " " + " ".join(chr(97 + i) for i in range(20)), one + " x#" * 3 + " ####" * 9, "\n".join(words[:24]) + "\nsame" * 40, " ".join(f"{i}%" for i in range(30)), one + " " + "y" * 1000, " ".join(str(i) for i in range(30)) + " abc" * 9, "...\n".join(words) + "…", one.replace(" ", "\t\r\n"), one + "\u00a0" * 30]
    more = [(50 + i, t, None, None, None, 1, "", 1) for i, t in enumerate(odd)]
    got = {r[0]: r[7] for r in check(spark, helpers.write(helpers.table(spark, [*helpers.ROWS, *more]), tmp_path))}
    assert got[50] and not any(got[50 + i] for i in (1, 3, 4, 5, 6, 7)), got


def test_empty_table(spark, tmp_path):
    assert check(spark, helpers.write(helpers.empty(spark), tmp_path)) == []


def test_order_changes_no_verdict(spark):
    docs = helpers.table(spark)
    one = quality.judge(docs, rules=quality.RULES, sample_rows=1).select("doc_id", "__cv_kept").collect()
    other = quality.judge(docs, rules=quality.RULES[::-1], sample_rows=100).select("doc_id", "__cv_kept").collect()
    assert Counter(one) == Counter(other)


def test_rejections_per_cost_come_first(spark):
    local = quality.judged(helpers.table(spark), "text").cache()
    never, always = quality.Rule("never", "__cv_text = 'no such text'"), quality.Rule("always", "true")
    assert quality.order(local, (never, always))[0][0] is always
    dear = quality.Rule("dear", "size(regexp_extract_all(repeat(__cv_text, 3), '(\\\\w)', 1)) >= 0")
    found = {r.name: (cost, share) for r, cost, share in quality.order(local, (dear, always))}
    assert found["dear"][1] == found["always"][1] == 1.0 and found["dear"][0] > found["always"][0]


def test_the_sample_leaves_out_what_the_cascade_never_sees(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "order", lambda sample, rules: seen.append(sample.collect()) or [(r, 0, 0) for r in rules])
    quality.judge(helpers.table(spark))
    assert seen[0] and not any(r["__cv_base_failed"] for r in seen[0])
