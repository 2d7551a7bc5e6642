"""Line dedup over content-defined chunks of lines.

Each line is hashed. A rolling hash over the hashes of the last `WINDOW` lines chooses the chunk boundaries (one in
`ONE_IN`), so lines inserted or deleted anywhere move only the boundaries near them. Chunks of two lines or more are
grouped by a 128-bit digest over all documents; an occurrence of a chunk that is not its first one (least id, row, place) goes, if its bytes are
those of the first one.

Boundaries fall anywhere in a passage, so its first and last lines, and passages too short to hold a chunk, are left by this. A second set of pieces
finds them: each two neighbouring lines. They are grouped like chunks; those inside a repeated chunk are done, and of the rest
the bytes are compared too. So no run of two lines or more that an earlier place has stays. A piece that overlaps its first occurrence
(a line repeated in a row) stays. Lines with no word are pieces only together with a neighbour that has one.

Counts are summed in each task before they are shuffled; digests alone decide what is looked at, and only the first occurrences' texts are moved to the
documents that repeat them. The written rows of an operator are what all its jobs read (see spans.numbered).

Defined cases: null and empty texts stay as they are; single lines that repeat without a neighbour always stay;
texts are read whole at any length; repeated rows count as two documents, of which the first keeps its lines; null ids
rank last; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import P, documents, materialise, scratch
from .spans import numbered, rows_of, slices

WINDOW = 2
ONE_IN = 3
MASK = (1 << 64) - 1
#: The multiplier of the rolling hash and of the choice.
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Kinds of pieces.
CHUNK, PAIR = 0, 1
#: White space of lines without a word.
SPACES = " \t\n\x0b\x0c\r"


def chunks(lines: list[str], window: int = WINDOW, one_in: int = ONE_IN) -> list[tuple[int, int]]:
    """[first, end) of the lines of each chunk; a chunk ends after a line whose last `window` lines' rolling hash says so."""
    import xxhash

    h = [xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines]
    power = pow(BASE, window, 1 << 64)
    out, rolling, first = [], 0, 0
    for i in range(len(lines)):
        rolling = (rolling * BASE + h[i] - (h[i - window] * power if i >= window else 0)) & MASK
        if i == len(lines) - 1 or (((rolling * MIX) & MASK) >> 40) % one_in == 0:
            out.append((first, i + 1))
            first = i + 1
    return out


def _starts(lines: list[str]) -> list[int]:
    out, at = [], 0
    for x in lines:
        out.append(at)
        at += len(x) + 1
    return out


def pieces(text: str, window: int = WINDOW, one_in: int = ONE_IN) -> list[tuple[int, int, int]]:
    """(kind, start, end) of each chunk of two lines or more and of each two neighbouring lines, without the end of their last line."""
    lines = text.split("\n")
    if len(lines) < 2:
        return []
    at, worded = _starts(lines), [bool(x.strip(SPACES)) for x in lines]
    out = [(CHUNK, a, b) for a, b in chunks(lines, window, one_in) if b - a > 1 and any(worded[a:b])]
    out += [(PAIR, i, i + 2) for i in range(len(lines) - 1) if worded[i] or worded[i + 1]]
    return [(kind, at[a], at[b - 1] + len(lines[b - 1])) for kind, a, b in out]


def _rows(docs: DataFrame, key: str, text: str, window: int, one_in: int) -> DataFrame:
    schema = T.StructType([T.StructField("of", T.LongType()), T.StructField("rank", docs.schema[key].dataType), T.StructField("kind", T.IntegerType()), T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType()), T.StructField("digest", T.BinaryType())])

    def each(uid, k, t):
        import xxhash

        return [(uid, k, kind, s, e, xxhash.xxh3_128_digest(t[s:e].encode("utf-8", "surrogatepass"), kind)) for kind, s, e in pieces(t, window, one_in)]

    return rows_of(docs, key, text, schema, each)


_FOUND = T.StructType([T.StructField(n, T.LongType() if n in ("of", "fo") else T.IntegerType()) for n in ("of", "kind", "s", "e", "fo", "fs", "fe")])
_TEXT = T.StructType([T.StructField("fo", T.LongType()), T.StructField("fs", T.IntegerType()), T.StructField("fe", T.IntegerType()), T.StructField("original", T.StringType())])


def _batch(rows: list[tuple], schema: T.StructType):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    to = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), to)], schema=to)


def _outside_chunks(batches: Iterator) -> Iterator:
    """Of each document's repeated pieces (of, found), the chunks and the pairs that no chunk holds."""
    for part in slices(batches):
        out = []
        for of, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            found.sort(key=lambda p: (p["s"], p["kind"]))
            end = -1
            for p in found:  # chunks don't overlap, and the one that holds a pair starts at or before it
                if p["kind"] == CHUNK:
                    end = p["e"]
                elif p["e"] <= end:
                    continue
                out.append((of, p["kind"], p["s"], p["e"], p["fo"], p["fs"], p["fe"]))
        yield _batch(out, _FOUND)


def _texts(batches: Iterator) -> Iterator:
    for part in slices(batches):
        yield _batch([(fo, w["fs"], w["fe"], t[w["fs"] : w["fe"]]) for fo, t, wanted in zip(*(c.to_pylist() for c in part.columns)) for w in wanted], _TEXT)


def repeated(docs: DataFrame, key: str, text: str, window: int, one_in: int) -> DataFrame:
    """(of, found): each document's pieces that an earlier place seems to have, with the text there. docs has __cv_uid."""
    rows = _rows(docs, key, text, window, one_in)
    place = F.struct(F.col("rank").isNull().alias("a"), F.col("rank").alias("b"), F.col("of").alias("c"), F.col("s").alias("d"), F.col("e").alias("e"))
    first = rows.groupBy(F.col("digest").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    first = materialise(first.select("d", F.col("first.c").alias("fo"), F.col("first.d").alias("fs"), F.col("first.e").alias("fe")), "first-pieces")
    again = rows.join(first.hint("merge"), F.col("digest") == F.col("d")).filter("of <> fo or s > fe")
    lists = again.groupBy("of").agg(F.collect_list(F.struct("kind", "s", "e", "fo", "fs", "fe")).alias("found"))
    again = materialise(lists.mapInArrow(_outside_chunks, _FOUND), "repeated-pieces")
    wanted = again.select("fo", "fs", "fe").distinct().groupBy("fo").agg(F.collect_list(F.struct("fs", "fe")).alias("wanted"))
    texts = materialise(docs.select(F.col(f"{P}uid"), F.col(text).alias("t")).join(wanted.hint("merge"), F.col(f"{P}uid") == F.col("fo")).select("fo", "t", "wanted").mapInArrow(_texts, _TEXT), "first-texts")
    both = again.join(texts.hint("merge"), ["fo", "fs", "fe"])
    return materialise(both.groupBy("of").agg(F.collect_list(F.struct("kind", "s", "e", "original")).alias("found")), "line-repeats", keep=True)


def cut_lines(text: str, found: list[dict]) -> tuple[str, list[int], list[int]]:
    """The remaining text and the removed spans, of pieces whose bytes are those of their first occurrence."""
    lines = text.split("\n")
    at = _starts(lines)
    index, gone = {s: i for i, s in enumerate(at)}, bytearray(len(lines))
    for p in found:
        if text[p["s"] : p["e"]] == p["original"]:
            a = index[p["s"]]
            b = a + p["original"].count("\n") + 1
            worded = [bool(x.strip(SPACES)) for x in lines[a:b]]
            for i in range(a, b):
                k = i - a
                if any(worded[max(0, k - 1) : k + 2]):
                    gone[i] = 1
    kept, starts, ends = [], [], []
    for i, x in enumerate(lines):
        end = at[i] + len(x) + (i < len(lines) - 1)
        if not gone[i]:
            kept.append(text[at[i] : end])
        elif i and gone[i - 1]:
            ends[-1] = end
        else:
            starts.append(at[i])
            ends.append(end)
    return "".join(kept), starts, ends


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """docs with the remaining text in `text`, the text as it was in __cv_was, and the removed spans in __cv_starts and __cv_ends (null: none)."""
    docs = numbered(docs)
    with scratch(docs.sparkSession):
        found = repeated(docs, key, text, window, one_in).select(F.col("of").alias(f"{P}of"), F.col("found").alias(f"{P}found"))
    joined = docs.join(found.hint("merge"), F.col(f"{P}uid") == F.col(f"{P}of"), "left").drop(f"{P}uid", f"{P}of")
    spans = T.ArrayType(T.IntegerType())
    columns = [*joined.schema.fields[:-1], T.StructField(f"{P}was", T.StringType()), T.StructField(f"{P}starts", spans), T.StructField(f"{P}ends", spans)]
    column, schema = joined.columns.index(text), T.StructType(columns)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        for part in slices(batches):
            texts, found = part.column(column), part.column(part.num_columns - 1).to_pylist()
            done = [cut_lines(t, f) if f else (t, None, None) for t, f in zip(texts.to_pylist(), found)]
            done = [(t, s or None, e or None) for t, s, e in done]
            own = [pa.array([d[0] for d in done], f.type) if i == column else part.column(i).cast(f.type) for i, f in zip(range(part.num_columns - 1), to)]
            n = len(own)
            yield pa.RecordBatch.from_arrays([*own, texts.cast(to.field(n).type), *(pa.array([d[k] for d in done], to.field(n + k).type) for k in (1, 2))], schema=to)

    return joined.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    d = deduplicate(documents(spark, sf_dir).select("doc_id", "text"))
    lines = lambda c: F.coalesce(F.regexp_count(c, F.lit("\n")) + 1, F.lit(0)).cast("long")
    return d.select(
        "doc_id", lines(F.col(f"{P}was")).alias("n_lines"), F.coalesce(F.size(f"{P}starts"), F.lit(0)).cast("long").alias("n_removed_runs"), F.coalesce(F.length(f"{P}was"), F.lit(0)).cast("long").alias("n_chars"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
        F.coalesce(F.array_join(F.transform(F.arrays_zip(f"{P}starts", f"{P}ends"), lambda x: F.concat_ws("-", x[f"{P}starts"].cast("string"), x[f"{P}ends"].cast("string"))), " "), F.lit("")).alias("removed_spans"),
    )
