"""Quality rules as a short-circuit cascade, in SQL functions only.

Statistics of a text, its words being runs of anything but ASCII white space: number of words, their code points,
symbol characters, lines that repeat an earlier one, and words that lie in an 8-word window found twice or more.
The base rules (too few words, too many repeated words) fail first. Documents that pass them go through the
cascade: a chain of CASE branches, so that a rejected document never reaches the dearer rules. The five statistics are what the operator returns, so
they are there for every document; rules that need more of the text compute it in their own branch.

Cost and selectivity. A random sample of about `SAMPLE_ROWS` documents of the whole table, less those that fail the base rules (the cascade never sees them), is
kept in memory. A rule's cost is the time of evaluating it `REPEAT` times on each of them in one task, warmed up, less the time of the same job without a
rule. Its selectivity is the share that it rejects. Rules are ordered by rejections per cost. The order changes only the cost: the verdict is the
same in any order.

Windows are compared by a 64-bit hash of their words' hashes, inside one text.

Defined cases: a null or empty text has no words and fails the base; a text is read whole at any length;
repeated rows are judged one by one; an empty table, or one whose sample holds nothing, leaves the rules in their given order;
other columns are never read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import P, WORD, documents, let, materialise, scratch, text_of

#: The symbols counted, ASCII white space.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

#: The sample for costs and selectivities: about so many rows, each evaluated so often.
SAMPLE_ROWS = 512
REPEAT = 8
SEED = 20


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows that occur twice or more among the text's windows."""

    def from_windows(hashes: Column) -> Column:
        def covered(starts: Column) -> Column:
            # starts in order: each adds what the one before it has not covered
            return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("at")), lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["at"])).alias("n"), p.alias("at")), lambda a: a["n"])

        def again(ordered: Column) -> Column:
            same = lambda x, i: F.when(i > 0, F.get(ordered, i - 1)["h"] == x["h"]).otherwise(False) | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(ordered, same), lambda x: x["p"]))

        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(let(ordered, again), covered))

    def from_hashes(h: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, window))), from_windows)

    return F.when(F.size(words) < window + 1, F.lit(0).cast("long")).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), from_hashes))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with __cv_n_words, __cv_word_chars, __cv_n_symbols, __cv_n_dup_lines and __cv_n_repeat_words."""
    t = text_of(text)
    lines = let(F.filter(F.split(t, "\n"), lambda x: F.length(_without(x, SPACES)) > 0), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counts = let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    squeezed = let(_without(t, SPACES), lambda x: F.struct(F.length(x).cast("long").alias("c"), (F.length(x) - F.length(_without(x, SYMBOLS))).cast("long").alias("s")))
    return docs.withColumn(f"{P}counts", counts).withColumn(f"{P}chars", squeezed).withColumns({
        f"{P}n_words": F.col(f"{P}counts.n"), f"{P}word_chars": F.col(f"{P}chars.c"), f"{P}n_symbols": F.col(f"{P}chars.s"),
        f"{P}n_dup_lines": lines.cast("long"), f"{P}n_repeat_words": F.col(f"{P}counts.r"),
    }).drop(f"{P}counts", f"{P}chars")


@dataclass(frozen=True)
class Rule:
    """Rejects where `rejects` (SQL over the statistics and __cv_text) is true."""

    name: str
    rejects: str


#: Loose enough for clean prose, lists and code in any alphabet with spaces.
RULES = (
    Rule("word_length", f"{P}word_chars < 1.5 * {P}n_words or {P}word_chars > 40 * {P}n_words"),
    Rule("symbols", f"2 * {P}n_symbols > 3 * {P}n_words"),
    Rule("dup_lines", f"2 * {P}n_dup_lines > size(split({P}text, '\\n'))"),
    Rule("letters", f"10 * regexp_count({P}text, '[^ \\\\t-\\\\r]*\\\\p{{L}}[^ \\\\t-\\\\r]*') < 3 * {P}n_words"),
    Rule("long_run", f"regexp_like({P}text, '[^ \\\\t-\\\\r]{{1000}}')"),
    Rule("digits", f"10 * regexp_count({P}text, '[0-9]') > 7 * {P}word_chars"),
    Rule("ellipsis", f"10 * regexp_count({P}text, '(\\\\.\\\\.\\\\.|…)[ \\\\t\\\\r]*(\\\\n|\\\\z)') > 6 * size(split({P}text, '\\\\n'))"),
)


def order(sample: DataFrame, rules: tuple[Rule, ...], repeat: int = REPEAT) -> list[tuple[Rule, float, float]]:
    """Rules with (cost in seconds a document, selectivity) by falling rejections per cost. sample: in memory, bounded."""
    rejected = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.expr(r.rejects).cast("int")).alias(r.name) for r in rules]).first()
    n = rejected["n"]
    if not n:
        return [(r, 0.0, 0.0) for r in rules]
    again = sample.withColumn(f"{P}i", F.explode(F.sequence(F.lit(1), F.lit(repeat))))

    def seconds(condition: str) -> float:
        found = []
        for _ in range(3):  # the first run compiles
            began = time.perf_counter()
            again.agg(F.count_if(F.expr(condition) & (F.col(f"{P}i") > 0))).collect()
            found.append(time.perf_counter() - began)
        return min(found[1:])

    empty = seconds("true")
    cost = {r.name: max(seconds(r.rejects) - empty, 1e-6) / (n * repeat) for r in rules}
    return sorted(((r, cost[r.name], (rejected[r.name] or 0) / n) for r in rules), key=lambda x: -x[2] / x[1])


def cascade(rules: list[Rule]) -> Column:
    """True where no rule rejects; a later rule is evaluated only where the earlier ones did not reject."""
    verdict = F.lit(True)
    for r in reversed(rules):
        verdict = F.when(F.coalesce(F.expr(r.rejects), F.lit(False)), F.lit(False)).otherwise(verdict)
    return verdict


def judged(docs: DataFrame, text: str) -> DataFrame:
    """docs with the statistics, __cv_text and __cv_base_failed."""
    n, again = F.col(f"{P}n_words"), F.col(f"{P}n_repeat_words")
    return statistics(docs, text).withColumn(f"{P}text", text_of(text)).withColumn(f"{P}base_failed", (n < MIN_WORDS) | (100 * again > MAX_REPEATED_PERCENT * n))


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with the statistics, __cv_base_failed and __cv_kept."""
    n = docs.count()
    with scratch(docs.sparkSession):
        # The limit only guards the memory against an unlikely draw.
        some = docs.select(F.col(text).alias(f"{P}t")).sample(min(1.0, sample_rows / max(n, 1)), SEED).limit(4 * sample_rows)
        few = judged(materialise(some, "rule-rows"), f"{P}t").filter(f"not {P}base_failed")
        sample = materialise(few.coalesce(1), "rule-sample").coalesce(1).cache()
        ordered = [r for r, _, _ in order(sample, rules)]
        sample.unpersist()
    out = judged(docs, text)
    return out.withColumn(f"{P}kept", F.when(F.col(f"{P}base_failed"), F.lit(False)).otherwise(cascade(ordered))).drop(f"{P}text")


def query(spark, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", *[F.col(P + x).alias(x) for x in names])
