"""Substring dedup by line or paragraph hashing.

A text is split into units (lines by default, paragraphs by another separator; long ones are cut further where their words say so, so that a
passage inside a long line gives the same pieces wherever it stands). A unit is normalised (compatibility
form, lower case, white space collapsed, punctuation at its edges dropped) and hashed to 128 bits. Digests are grouped over all
documents with partial sums in each task; the occurrence with the least (id, row, offset) stays, all others are
removed, and their original character offsets [start, end) are kept beside the remaining text.

Units of fewer than `min_words` words always stay; by default these are only the units without a word, such as blank lines. Short lines
(verse, lists, code, scripts without spaces, which count as one word) take part like all others.

Defined cases: null and empty texts have no units and stay as they are; texts are read whole at any length;
repeated rows count as two documents, of which the first keeps its units; null ids rank last; an empty table gives
no rows; other columns pass through. A stretch that repeats a few words over and over is not cut.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import P, documents, materialise, scratch
from .spans import numbered, rows_of, with_spans, without_spans

MIN_WORDS = 1
#: Units of more words than this are cut; a cut is the least of the pairs of words up to so many places away on either side.
LONG, REACH = 25, 6
#: Letters of scripts without spaces between words, each of which counts as a word where long units are cut.
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")


def normalise(unit: str) -> str:
    return " ".join((unit if unit.isascii() else unicodedata.normalize("NFKC", unit)).lower().split()).strip(".,;:!?\"'()-")


@lru_cache(1 << 16)
def _token_hash(token: str) -> int:
    return zlib.crc32(normalise(token).encode("utf-8", "surrogatepass"))


def cuts(unit: str) -> list[int]:
    """Where a long unit is cut: before the second word of each pair whose hash is below those of the REACH pairs before and after it. Nothing further away matters."""
    import numpy as np

    tokens = list(_TOKEN.finditer(unit)) if len(unit) > LONG else []
    if len(tokens) <= LONG:
        return []
    h = np.array([_token_hash(x.group()) for x in tokens], np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93)
    pairs ^= pairs >> np.uint64(32)
    near = np.lib.stride_tricks.sliding_window_view(pairs, 2 * REACH + 1)
    here = near[:, REACH]
    least = (here < near[:, :REACH].min(1)) & (here < near[:, REACH + 1 :].min(1))
    return [tokens[i + REACH + 1].start() for i in np.flatnonzero(least)]


def split_units(text: str, separator: str = "\n") -> list[tuple[int, int]]:
    """[start, end) of each unit with its separator, long ones in pieces, so that nothing but what is removed changes."""
    out, at, n = [], 0, len(separator)
    while at < len(text):
        e = text.find(separator, at)
        e = len(text) if e < 0 else e + n
        ends = [*(at + c for c in cuts(text[at:e])), e]
        out += zip([at, *ends], ends)
        at = e
    return out


def units(docs: DataFrame, key: str, text: str, separator: str, min_words: int) -> DataFrame:
    """(of, rank, start, end, digest) of every unit of min_words words or more; rank is the document's id."""
    schema = T.StructType([T.StructField("of", T.LongType()), T.StructField("rank", docs.schema[key].dataType), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("digest", T.BinaryType())])

    def each(uid, k, t):
        out = []
        for s, e in split_units(t, separator):
            u = normalise(t[s:e])
            if len(u.split()) >= min_words:
                out.append((uid, k, s, e, hashlib.blake2b(u.encode("utf-8", "surrogatepass"), digest_size=16).digest()))
        return out

    return rows_of(docs, key, text, schema, each)


def removed_spans(docs: DataFrame, key: str, text: str, separator: str = "\n", min_words: int = MIN_WORDS) -> DataFrame:
    """(__cv_of, __cv_start, __cv_end) of all occurrences but the first. docs has __cv_uid."""
    found = materialise(units(docs, key, text, separator, min_words), "units")  # read twice
    place = F.struct(F.col("rank").isNull().alias("a"), F.col("rank").alias("b"), F.col("of").alias("c"), F.col("start").alias("d"))
    first = found.groupBy(F.col("digest").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    # Written too, so that the join's own shuffles carry nothing but the join and Spark splits the partitions of frequent units.
    first = materialise(first.select("d", F.col("first.c").alias("fo"), F.col("first.d").alias("fs")), "repeated-units")
    again = found.join(first.hint("merge"), F.col("digest") == F.col("d")).filter("of <> fo or start <> fs")
    return again.select(F.col("of").alias(f"{P}of"), F.col("start").alias(f"{P}start"), F.col("end").alias(f"{P}end"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the remaining text in `text` and the removed spans in __cv_starts and __cv_ends (null: none)."""
    docs = numbered(docs)
    with scratch(docs.sparkSession):
        spans = materialise(removed_spans(docs, key, text, separator, min_words), "unit-spans", keep=True)
    return with_spans(docs, spans).withColumn(f"{P}chars", F.length(text)).withColumn(text, F.when(F.col(f"{P}starts").isNull(), F.col(text)).otherwise(without_spans(F.col(text), F.col(f"{P}starts"), F.col(f"{P}ends")))).drop(f"{P}uid")


def query(spark, sf_dir: str) -> DataFrame:
    d = deduplicate(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.coalesce(F.arrays_zip(F.col(f"{P}starts").alias("start"), F.col(f"{P}ends").alias("end")), F.array().cast("array<struct<start:int,end:int>>"))
    return d.select("doc_id", F.coalesce(f"{P}chars", F.lit(0)).cast("long").alias("n_chars"), F.coalesce(F.size(f"{P}starts"), F.lit(0)).cast("long").alias("n_removed"), (F.coalesce(f"{P}chars", F.lit(0)) - F.length(F.coalesce("text", F.lit("")))).cast("long").alias("removed_chars"), F.to_json(spans).alias("removed_spans"), F.col("text").alias("kept_text"))
