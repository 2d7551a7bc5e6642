"""Suffix-array dedup of byte strings of a fixed length, exact, over all documents.

A byte goes if a string of `length` bytes that covers it starts anywhere else too, in the same document or another.

Candidates. Every start p of such a string takes the least hash of the grams of `GRAM` bytes inside the string as its id (winnowing), so equal
strings have equal ids. Consecutive starts with one id form a run; its piece is all bytes its strings cover. Runs whose id occurs
once are done. Of the rest, runs of equal pieces (by id and 128-bit digest) are one piece with a count, so a passage copied thousands of times goes on once.

Suffix arrays. An id under which there is one piece only, with a count, is done: all strings of the piece go. Other pieces are gathered by id, some ids at a time, parsed into
chunks at anchors that depend only on the bytes that follow (a gram hash, and every position of a longer gap), and the chunks are
numbered in byte order. An extended chunk is no prefix of another one, so sequences of numbers compare as the bytes do, and the suffix array of
the numbers (see suffix.py) is a sparse suffix array of the bytes. With the longest common prefixes of its neighbours, a string's
class is (bytes before its first anchor, interval of the suffix array that shares the rest): strings are equal if and only
if their classes are. Classes are looked up by hash, and strings of one hash are compared byte by byte. A string goes if its
class holds a count of two or more in all, in the same piece, in others, or by the copies that a piece stands for.

An id with more than `MOST_PIECES` different pieces (a frequent line in ever other surroundings) is not brought together: its strings are grouped by a 128-bit
digest, with partial sums, which needs no group in one task.

Bytes. What a digest took for a copy is compared with the bytes of what it is a copy of, before anything is cut: neighbouring claims on one
text are joined, the claimed stretches are cut once each and brought to the documents that claim them. A difference (two texts with one digest) fails the
job instead of giving a wrong result.

Defined cases: null is the empty text; a text shorter than `length` loses nothing; texts are read whole, long ones in blocks; repeated
rows are two documents, both of which lose all their long strings; null ids are ids like others; an empty table gives no
rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import P, documents, materialise, scratch
from .spans import numbered, slices
from .suffix import suffix_array

LENGTH = 200
GRAM = 72
#: Bytes of a text worked on at a time.
BLOCK = 1 << 20
#: Bytes of pieces in one suffix array, unless one id has more.
ARRAY_BYTES = 1 << 20
MOST_PIECES = 10_000
#: Chunks: grams of so many bytes, one in so many an anchor, and all positions after so many without one.
CHUNK_GRAM, ONE_IN, GAP = 8, 64, 180

U = np.uint64
#: Multipliers of the finaliser, base of the rolling hash.
M1, M2, BASE = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53), 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(33))
    x *= M1
    x ^= x >> U(33)
    x *= M2
    x ^= x >> U(33)
    return x


_CODES = mix(np.arange(1, 257, dtype=U))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, 1 << 16), U)
        k = 1
        while k < len(have):
            m = min(k, len(have) - k)
            have[k : k + m] = have[:m] * U(pow(base, k, 1 << 64))
            k += m
        _powers[base] = have
    return have[:n]


class Rolling:
    """Hashes of any substrings of a buffer, comparable between places and buffers."""

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(_CODES[buffer] * powers(BASE, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def grams(self, k: int) -> np.ndarray:
        return mix((self.sums[k:] - self.sums[:-k]) * self.back[: len(self.sums) - k])


def runs(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int]]:
    """(id, start, end) of each run of starts with one id; end is that of its piece, start + number of starts - 1 + length."""
    for at in range(0, max(1, len(text) - length + 1), BLOCK):
        part = text[at : at + BLOCK + length - 1]
        if len(part) < length:
            return
        h = Rolling(np.frombuffer(part, np.uint8)).grams(gram)
        width = length - gram + 1
        least, w = h, 1
        while 2 * w <= width:
            least = np.minimum(least[:-w], least[w:])
            w *= 2
        if w < width:
            least = np.minimum(least[: len(h) - width + 1], least[width - w : width - w + len(h) - width + 1])
        # A run ends where the least gram is left behind or a lesser one comes in.
        new = np.ones(len(least), bool)
        new[1:] = (h[: len(least) - 1] == least[:-1]) | (least[1:] != least[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(least)) - 1
        yield from zip(least[first].view(np.int64).tolist(), (first + at).tolist(), (last + at + length).tolist())


def repeated_starts(pieces: list[bytes], length: int = LENGTH, counts: list[int] | None = None) -> list[np.ndarray]:
    """For each piece, which of its strings of `length` bytes start more than once in all pieces, each as often as its count says. Pieces: length bytes at least."""
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    joined = b"".join(pieces)
    n = len(joined)
    buffer = np.frombuffer(joined + bytes(length), np.uint8)
    where = np.arange(n)
    end_of, begin_of = np.repeat(ends, sizes), np.repeat(begins, sizes)

    words = np.ndarray((n,), "<u8", joined + bytes(CHUNK_GRAM), strides=(1,))
    seen = where + CHUNK_GRAM <= end_of
    regular = seen & (mix(words.astype(U)) % U(ONE_IN) == 0)
    last = np.maximum(np.maximum.accumulate(np.where(regular, where, -1)), begin_of - 1)
    gap = seen & (where - last > GAP)
    anchors = np.flatnonzero(regular | gap)

    following = np.append(anchors[1:], n)
    owner_end = end_of[anchors]
    inner = following < owner_end
    stops = np.where(inner, following + CHUNK_GRAM, owner_end)
    chunk = [joined[a:b] for a, b in zip(anchors.tolist(), stops.tolist())]
    rank = {c: i + 1 for i, c in enumerate(sorted(set(chunk)))}
    symbols: list[int] = []
    for c, goes_on in zip(chunk, inner.tolist()):
        symbols.append(rank[c])
        if not goes_on:
            symbols.append(0)
    index = np.cumsum(np.append(0, 1 + ~inner[:-1])) if len(anchors) else np.zeros(0, int)
    of_symbol = np.full(len(symbols), -1)
    of_symbol[index] = np.arange(len(anchors))

    order = of_symbol[np.array(suffix_array(symbols), dtype=np.int64)]
    order = order[order >= 0]
    rows = np.lib.stride_tricks.sliding_window_view(buffer, length)
    at, room = anchors[order], (owner_end - anchors)[order]
    common = np.zeros(len(order), np.int64)
    for i in range(1, len(order), 4096):
        a, b = rows[at[i - 1 : i + 4095][: len(at[i : i + 4096])]], rows[at[i : i + 4096]]
        differ = a != b
        common[i : i + 4096] = np.where(differ.any(1), differ.argmax(1), length)
    common[1:] = np.minimum(common[1:], np.minimum(room[1:], room[:-1]))

    before = np.maximum(np.where(at > 0, last[at - 1], -1), begin_of[at] - 1)
    reach, is_regular, limit = at - before - 1, regular[at], end_of[at] - length
    rolling = Rolling(buffer[:n])
    flagged = np.zeros(n, bool)
    several = np.repeat(np.array(counts or [1] * len(pieces)) > 1, sizes)
    for o in range(GAP + 1):
        ok = np.flatnonzero(((is_regular & (reach >= o)) | (~is_regular & (o == GAP))) & (at - o <= limit))
        if not len(ok):
            continue
        interval = np.cumsum(common < length - o)[ok]
        p = at[ok] - o
        keys = mix(mix(rolling.of(p, at[ok])) + interval.astype(U) * U(BASE))
        by = np.argsort(keys)
        flagged[p] |= several[p]
        pairs = np.flatnonzero(keys[by][1:] == keys[by][:-1])
        for k in range(0, len(pairs), 8192):
            one, other = p[by[pairs[k : k + 8192]]], p[by[pairs[k : k + 8192] + 1]]
            equal = (rows[one] == rows[other]).all(1)
            flagged[one[equal]] = flagged[other[equal]] = True
            if not equal.all():  # different strings with one key, between which equal ones may stand apart
                among: dict[bytes, list[int]] = {}
                for x in p[np.isin(keys, keys[by[pairs[k : k + 8192][~equal]]])].tolist():
                    among.setdefault(rows[x].tobytes(), []).append(x)
                for x in among.values():
                    flagged[x] |= len(x) > 1
    return [flagged[b : e - length + 1] for b, e in zip(begins.tolist(), ends.tolist())]


_RUN = "id long, piece binary, uid long, start long, end long"
_PIECE = T.StructType([T.StructField("id", T.LongType()), T.StructField("uid", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n", T.LongType()), T.StructField("bytes", T.BinaryType())])
#: A flagged stretch [s, e) of a piece that starts at base of uid and stands for n.
_FLAGGED = "uid long, base long, n long, s long, e long"
#: A stretch of uid that repeats the one at rs of ruid.
_CLAIM = "uid long, s long, e long, ruid long, rs long"


def _bytes(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _emit(rows: list[tuple], names: list[str], kinds: list):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _runs(length: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                uid, b = batch.column(0)[i].as_py(), _bytes(batch.column(1)[i].as_py())
                out += [(h, xxhash.xxh3_128_digest(b[s:e]), uid, s, e) for h, s, e in runs(b, length)]
                if len(out) > 50_000:
                    yield _emit(out, ["id", "piece", "uid", "start", "end"], kinds)
                    out = []
            if out:
                yield _emit(out, ["id", "piece", "uid", "start", "end"], kinds)

    return run


def _cut_pieces(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for part in slices(batches, 32):
        out = []
        for t, wanted in zip(*(c.to_pylist() for c in part.columns)):
            b = _bytes(t)
            out += [(w["id"], w["uid"], w["start"], w["n"], b[w["start"] : w["end"]]) for w in wanted]
        yield _emit(out, ["id", "uid", "start", "n", "bytes"], [pa.int64()] * 4 + [pa.binary()])


def merged(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal spans that strings at these sorted starts cover."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, breaks + 1)].tolist(), (starts[np.append(breaks, len(starts) - 1)] + length).tolist()))


def _arrays(length: int):
    """Rows sorted by id in, flagged stretches of their pieces out."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, size, last = [], 0, None

        def flush():
            out = []
            for (uid, start, n, _), flags in zip(held, repeated_starts([h[3] for h in held], length, [h[2] for h in held])):
                out += [(uid, start, n, s, e) for s, e in merged(np.flatnonzero(flags), length)]
            return out

        names, kinds = ["uid", "base", "n", "s", "e"], [pa.int64()] * 5
        for batch in batches:
            for i in range(batch.num_rows):
                key, uid, start, n, b = (batch.column(j)[i].as_py() for j in range(5))
                if key != last and size > ARRAY_BYTES:
                    if out := flush():
                        yield _emit(out, names, kinds)
                    held, size = [], 0
                held.append((uid, start, n, b))
                size += len(b)
                last = key
        if held and (out := flush()):
            yield _emit(out, names, kinds)

    return run


def _strings(length: int):
    """Every string of the pieces as a 128-bit digest, for ids with too many pieces to bring together."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for i in range(batch.num_rows):
                _, uid, start, n, b = (batch.column(j)[i].as_py() for j in range(5))
                yield _emit([(xxhash.xxh3_128_digest(b[p : p + length]), uid, start, n, p) for p in range(len(b) - length + 1)], ["digest", "uid", "base", "n", "s"], [pa.binary()] + [pa.int64()] * 4)

    return run


def joined_claims(batches: Iterator) -> Iterator:
    """(uid, claims of (s, e, ruid, rs)): claims on one text at one distance that touch are one."""
    import pyarrow as pa

    for part in slices(batches):
        out: list[tuple] = []
        for uid, claims in zip(*(c.to_pylist() for c in part.columns)):
            now = None
            for r, d, s, e in sorted((c["ruid"], c["s"] - c["rs"], c["s"], c["e"]) for c in claims):
                if now and now[0] == r and now[1] == d and s <= now[3]:
                    now[3] = max(now[3], e)
                else:
                    if now:
                        out.append((uid, now[2], now[3], now[0], now[2] - now[1]))
                    now = [r, d, s, e]
            out.append((uid, now[2], now[3], now[0], now[2] - now[1]))
        if out:
            yield _emit(out, ["uid", "s", "e", "ruid", "rs"], [pa.int64()] * 5)


def _claimed(batches: Iterator) -> Iterator:
    """The bytes of the stretches (at, end) that other documents claim to repeat."""
    import pyarrow as pa

    for part in slices(batches, 32):
        out = []
        for ruid, t, wanted in zip(*(c.to_pylist() for c in part.columns)):
            b = _bytes(t)
            out += [(ruid, w["rs"], w["re"], b[w["rs"] : w["re"]]) for w in wanted]
        yield _emit(out, ["ruid", "rs", "re", "original"], [pa.int64()] * 3 + [pa.binary()])


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(uid, s, e, original): byte spans, overlapping, that cover what is to be removed; original, where not null, is what must stand there. docs has __cv_uid."""
    plain = docs.select(F.col(f"{P}uid").alias("uid"), F.col(text).alias("text"))
    found = lambda: plain.mapInArrow(_runs(length), _RUN)
    # Tables that others are joined with are written first, so that the joins have shuffles of their own and Spark splits partitions of frequent ids.
    often = materialise(found().groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "repeated-ids")
    some = materialise(found().join(often.hint("merge"), "id"), "repeated-runs")
    one = F.min(F.struct("uid", "start", "end"))
    pieces = materialise(some.groupBy("id", "piece").agg(F.count(F.lit(1)).alias("n"), one.alias("first")).select("id", "piece", "n", "first.*"), "pieces")
    counts = materialise(pieces.groupBy("id").agg(F.count(F.lit(1)).alias("k")), "piece-counts")
    marked = materialise(pieces.join(counts.hint("merge"), "id"), "marked-pieces")
    wanted = marked.filter("k > 1").groupBy(F.col("uid").alias("of")).agg(F.collect_list(F.struct("id", "uid", "start", "n", "end", (F.col("k") > MOST_PIECES).alias("many"))).alias("wanted"))
    cut = plain.join(wanted.hint("merge"), F.col("uid") == F.col("of"))
    in_arrays = cut.select("text", F.filter("wanted", lambda w: ~w["many"]).alias("wanted")).filter("size(wanted) > 0")
    flagged = materialise(in_arrays.mapInArrow(_cut_pieces, _PIECE).repartition(F.col("id")).sortWithinPartitions("id").mapInArrow(_arrays(length), _FLAGGED), "flagged")
    # A piece that is alone under its id is there twice at least, as a whole: there is nothing to build an array of.
    flagged = flagged.unionByName(marked.filter("k = 1").select("uid", F.col("start").alias("base"), "n", F.lit(0).cast("long").alias("s"), (F.col("end") - F.col("start")).alias("e")))
    claims = None
    if not marked.filter(F.col("k") > MOST_PIECES).isEmpty():
        large = cut.select("text", F.filter("wanted", lambda w: w["many"]).alias("wanted")).filter("size(wanted) > 0")
        strings = materialise(large.mapInArrow(_cut_pieces, _PIECE).mapInArrow(_strings(length), "digest binary, uid long, base long, n long, s long"), "strings")
        twice = strings.groupBy(F.col("digest").alias("d")).agg(F.sum("n").alias("total"), F.min(F.struct("uid", (F.col("base") + F.col("s")).alias("at"))).alias("first")).filter("total > 1")
        twice = materialise(twice.select("d", F.col("first.uid").alias("ruid"), F.col("first.at").alias("rs")), "repeated-strings")
        again = materialise(strings.join(twice.hint("merge"), F.col("digest") == F.col("d")).select("uid", "base", "n", "s", (F.col("s") + length).alias("e"), "ruid", "rs"), "flagged-strings")
        flagged = flagged.unionByName(again.select("uid", "base", "n", "s", "e"))
        claims = again.select("uid", (F.col("base") + F.col("s")).alias("s"), (F.col("base") + F.col("e")).alias("e"), "ruid", "rs").filter("uid <> ruid or s <> rs")
    # The copies that a piece stands for repeat what is flagged in it.
    stands = pieces.filter("n > 1").select("id", "piece", F.col("uid").alias("ruid"), F.col("start").alias("base"))
    copies = some.join(stands.hint("merge"), ["id", "piece"]).filter("uid <> ruid or start <> base").select("uid", "start", "ruid", "base")
    marks = flagged.filter("n > 1").select(F.col("uid").alias("ruid"), "base", "s", "e")
    copied = materialise(copies, "copies").join(marks.hint("merge"), ["ruid", "base"]).select("uid", (F.col("start") + F.col("s")).alias("s"), (F.col("start") + F.col("e")).alias("e"), "ruid", (F.col("base") + F.col("s")).alias("rs"))
    claims = copied if claims is None else claims.unionByName(copied)
    claims = materialise(claims.groupBy("uid").agg(F.collect_list(F.struct("s", "e", "ruid", "rs")).alias("claims")).mapInArrow(joined_claims, _CLAIM), "claims").withColumn("re", F.col("rs") + F.col("e") - F.col("s"))
    asked = claims.select("ruid", "rs", "re").distinct().groupBy("ruid").agg(F.collect_list(F.struct("rs", "re")).alias("asked"))
    originals = materialise(asked.join(plain.hint("merge"), F.col("ruid") == F.col("uid")).select("ruid", "text", "asked").mapInArrow(_claimed, "ruid long, rs long, re long, original binary"), "originals")
    checked = claims.join(originals.hint("merge"), ["ruid", "rs", "re"]).select("uid", "s", "e", "original")
    return flagged.select("uid", (F.col("base") + F.col("s")).alias("s"), (F.col("base") + F.col("e")).alias("e"), F.lit(None).cast("binary").alias("original")).unionByName(checked)


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """key, starts and ends of the removed byte runs, remaining bytes and number of removed ones, for every document."""
    docs = numbered(docs.select(key, text))
    with scratch(docs.sparkSession):
        spans = repeated_spans(docs, text, length)
        lists = spans.groupBy(F.col("uid").alias(f"{P}of")).agg(F.collect_list(F.struct("s", "e", "original")).alias(f"{P}spans"))
        lists = materialise(lists, "removed-bytes", keep=True)
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        for part in slices(batches):
            rows = []
            for t, spans in zip(*(part.column(i).to_pylist() for i in (1, 2))):
                b, spans = _bytes(t), spans or ()
                if any(x["original"] is not None and b[x["s"] : x["e"]] != x["original"] for x in spans):
                    raise ValueError("two texts share a 128-bit digest")
                gone = union([(x["s"], x["e"]) for x in spans])
                edges = [0, *(x for s in gone for x in s), len(b)]
                rows.append(([s for s, _ in gone], [e for _, e in gone], b"".join(b[s:e] for s, e in zip(edges[::2], edges[1::2])), sum(e - s for s, e in gone)))
            yield pa.RecordBatch.from_arrays([part.column(0).cast(to.field(0).type), *(pa.array(x, to.field(i + 1).type) for i, x in enumerate(zip(*rows)))], schema=to)

    joined = docs.join(lists.hint("merge"), F.col(f"{P}uid") == F.col(f"{P}of"), "left")
    return joined.select(key, text, f"{P}spans").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    d = deduplicate(documents(spark, sf_dir))
    return d.select("doc_id", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
