"""Document fingerprints from closed syncmers, in SQL functions only.

Of a text's overlapping k-mers of characters (`K` = 15), those are chosen whose least inner s-mer (`S` = 5, by hash) is the first or
the last. The choice depends on the k-mer alone, so the same passage gives the same anchors in any context, and 10 k-mers in a row
hold at least one. A text is padded at both ends, so that short ones have anchors too.

An anchor is a long: 32 bits of the k-mer's hash, then its position. `anchors` gives a text's, ordered by hash, the first
position of each: all of them (`size` None), or a sketch, which is every anchor whose hash is below `1 / ONE_IN` of the range and at least the `SIZE` least. So the
sketch of a long text grows with it, and the sketch of a short one is all it has. A fingerprint is the sketch as text, 16 hexadecimal digits an
anchor.

`likeness` estimates the Jaccard similarity of two texts' anchors from the hashes up to which both sketches are whole; it is exact for unbounded ones. `aligned` matches by
position: shared anchors are joined by hash, and of the distances between their positions in the two texts the most frequent one is returned with its number of
anchors, which is the longest passage in common that moved as one.

s-mers come from one regular expression with a look-ahead group, which costs the same at any place in a text. Long texts are worked on in
pieces of `PIECE` characters (overlapping by k - 1), each reduced to its own sketch, so memory does not grow with the square of a text.

As the choice is free of context, the edited text's anchors are those of the text inside the part that stays, and those from the seam onwards; only the latter are
looked for anew, and sketches of the two parts make up the sketch of the whole.

Documents follow each other by descending id. Ids are cut into buckets at quantiles that are ids of the table; each bucket
also gets a copy of the first document of the next one, and the last one of the first document of all. So the successor is
found by a window inside a bucket, and no task sees more than a bucket.

Defined cases: a null or empty text has an empty fingerprint, like another empty one by 1 and any other by 0; ties of ids are ordered by
hash of the text, then text; null ids come last; a single document is followed by itself; an empty table gives no rows;
other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import P, documents, let, text_of

S = 5
K = 15
SIZE = 64
#: Share of the range of hashes below which every anchor stays in a sketch.
ONE_IN = 16
PIECE = 8192
PAD = "\x01"
#: Bits of a position, and of a hash.
PLACE, HASH = 31, 32
#: Documents in a bucket, and buckets at most (their bounds are part of the plan).
BUCKET_ROWS = 2048
MOST_BUCKETS = 20_000

#: Every s-mer of characters; none starts inside a pair of surrogates, as which the expression sees characters beyond the basic plane.
SMERS = rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{S}}}))"


def hash_of(anchor: Column) -> Column:
    return F.shiftright(anchor, PLACE)


def place_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << PLACE) - 1))


def _sketch(found: Column, size: int | None) -> Column:
    """Of unordered anchors the first of each hash, in order, as many as the sketch has."""

    def firsts(some: Column) -> Column:
        return let(F.sort_array(some), lambda x: F.filter(x, lambda a, i: (i == 0) | (hash_of(F.get(x, i - 1)) < hash_of(a))))

    def cut(some: Column) -> Column:
        return let(firsts(some), lambda x: F.filter(x, lambda a, i: (i < size) | (a < F.lit((1 << (PLACE + HASH)) // ONE_IN))))

    if size is None:
        return firsts(found)
    # The least quarter of the range mostly has all that a sketch takes; else everything is ordered.
    least = lambda x: cut(F.filter(x, lambda a: a < F.lit((1 << (PLACE + HASH)) // 4)))
    return let(found, lambda x: F.when(F.size(x) < 3 * size, cut(x)).otherwise(let(least(x), lambda y: F.when(F.size(y) >= size, y).otherwise(cut(x)))))


def _raw(piece: Column, at: Column) -> Column:
    """All closed syncmers of one piece as anchors, unordered; at is the piece's place in the text."""
    last = K - S

    def chosen(h: Column) -> Column:
        def mark(first: Column, i: Column) -> Column:
            final = F.get(h, i + last)
            no_edge = final.isNull()  # the last s-mers start no k-mer
            for j in range(last - 1, 0, -1):
                inner = F.get(h, i + j)
                no_edge = ((inner < first) & (inner < final)) | no_edge
            kmer = F.xxhash64(first, F.get(h, i + S), F.get(h, i + 2 * S)).bitwiseAND(F.lit((1 << HASH) - 1))
            return F.when(~no_edge, F.shiftleft(kmer, PLACE).bitwiseOR((at + i).cast("long")))

        return F.array_compact(F.transform(h, mark))

    smers = F.transform(F.regexp_extract_all(piece, F.lit(SMERS), F.lit(1)), lambda x: F.xxhash64(x))
    return let(smers, lambda h: F.when(F.size(h) > last, chosen(h)).otherwise(_none()))


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _padded(text: Column) -> Column:
    return F.concat(F.lit(PAD * (K - S)), text, F.lit(PAD * (K - 1)))


def _in_pieces(padded: Column, offset: Column, reduced, joined) -> Column:
    """joined(array of reduced(anchors) of each piece) of a padded text that starts at offset."""

    def whole(t: Column) -> Column:
        starts = F.when(F.length(t) < K, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(F.length(t) - K, F.lit(0)), F.lit(PIECE)))
        return let(F.transform(starts, lambda at: let(_raw(F.substring(t, at + 1, F.lit(PIECE + K - 1)), at + offset), reduced)), joined)

    return let(padded, whole)


def anchors(text: Column, size: int | None = SIZE) -> Column:
    """The anchors of a text as a sorted array of longs: all with size None, else its sketch."""
    found = _in_pieces(_padded(text), F.lit(0), lambda x: _sketch(x, size), lambda parts: _sketch(F.flatten(parts), size))
    return F.when(F.length(text) > 0, found).otherwise(_none())


def with_start(text: Column, start: Column, size: int | None = SIZE) -> Column:
    """struct(marks, start): the anchors of a text, and those whose k-mers end inside its first `start` characters, as sketches."""
    side = lambda parts, name: _sketch(F.flatten(F.transform(parts, lambda x: x[name])), size).alias(name)

    def of(last: Column) -> Column:
        both = lambda x: F.struct(_sketch(x, size).alias("marks"), _sketch(F.filter(x, lambda a: place_of(a) <= last), size).alias("start"))
        return _in_pieces(_padded(text), F.lit(0), both, lambda parts: F.struct(side(parts, "marks"), side(parts, "start")))

    return F.when(F.length(text) > 0, let(start - S, of)).otherwise(F.struct(_none().alias("marks"), _none().alias("start")))


def extended(start_marks: Column, text: Column, start: Column, size: int | None = SIZE) -> Column:
    """The anchors of a text of whose first `start` characters the anchors are known."""

    def of(seam: Column) -> Column:
        return _in_pieces(F.substring(_padded(text), seam + 1, F.length(text) + 2 * K), seam, lambda x: _sketch(x, size), lambda parts: _sketch(F.concat(start_marks, F.flatten(parts)), size))

    return F.when(F.length(text) > 0, let(F.greatest(start - S + 1, F.lit(0)), of)).otherwise(_none())


def as_text(marks: Column) -> Column:
    return F.array_join(F.transform(marks, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column, size: int | None = SIZE) -> Column:
    """Jaccard similarity of two texts' anchors, by hash."""
    top = F.lit((1 << HASH) - 1).cast("long")

    def whole_to(x: Column) -> Column:
        # A sketch of fewer than size anchors has all of them.
        return top if size is None else F.when(F.size(x) < size, top).otherwise(F.greatest(hash_of(F.get(x, F.lit(size - 1))), F.lit((1 << HASH) // ONE_IN - 1).cast("long")))

    def of(bound: Column) -> Column:
        hashes = lambda x: F.transform(F.filter(x, lambda v: hash_of(v) <= bound), hash_of)
        return let(hashes(a), lambda p: let(hashes(b), lambda q: let(F.size(F.array_intersect(p, q)), lambda n: n / (F.size(p) + F.size(q) - n).cast("double"))))

    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(let(F.least(whole_to(a), whole_to(b)), of))


def aligned(a: Column, b: Column) -> Column:
    """struct(distance, n): the most frequent distance between the positions of shared anchors (b's less a's, the least on ties) and their number; 0 and 0 for none."""
    side = lambda x, w: F.transform(x, lambda v: F.struct(hash_of(v).alias("h"), F.lit(w).alias("w"), place_of(v).alias("p")))

    def shared(x: Column) -> Column:
        return F.array_sort(F.array_compact(F.transform(x, lambda v, i: F.when((i > 0) & (F.get(x, i - 1)["h"] == v["h"]), v["p"] - F.get(x, i - 1)["p"]))))

    none = F.struct(F.lit(None).cast("long").alias("at"), F.lit(0).alias("run"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("distance"))

    def count(acc: Column, d: Column) -> Column:
        run = F.when(acc["at"] == d, acc["run"] + 1).otherwise(1)
        more = run > acc["n"]
        return F.struct(d.alias("at"), run.alias("run"), F.when(more, run).otherwise(acc["n"]).alias("n"), F.when(more, d).otherwise(acc["distance"]).alias("distance"))

    both = let(F.sort_array(F.concat(side(a, 0), side(b, 1))), shared)
    return F.aggregate(both, none, count, lambda acc: F.struct(acc["distance"].alias("distance"), acc["n"].alias("n")))


def followed(docs: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """docs with __cv_next_<c> for the columns: their values in the next row by descending key, the first row's in the last."""
    facts = docs.agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("top")).first()
    buckets = int(max(1, min(MOST_BUCKETS, facts["n"] // BUCKET_ROWS)))
    bounds: list = []
    if buckets > 1:
        found = docs.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], F.lit(max(10_000, 4 * buckets)))).first()[0]
        bounds = sorted({b for b in found or [] if b is not None and b < facts["top"]})
    k, edges = F.col(key), F.lit(bounds).cast(f"array<{docs.schema[key].dataType.simpleString()}>") if bounds else None
    if bounds:

        def find(e: Column) -> Column:
            # the number of bounds below the key, by binary search
            steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
            start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

            def halve(a, _):
                mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
                open_, below = a["lo"] < a["hi"], F.get(e, mid) < k
                return F.struct(F.when(open_ & below, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(open_ & ~below, mid).otherwise(a["hi"]).alias("hi"))

            return F.aggregate(steps, start, halve, lambda a: a["lo"])

        own = F.when(k.isNull(), 0).otherwise(let(edges, find))
        next_one = let(own, lambda b: F.when(k.isNotNull() & (F.get(edges, b) == k), F.struct((b + 1).alias("b"), F.lit(1).alias("kind"))))
    else:
        own, next_one = F.lit(0), F.lit(None).cast("struct<b:int,kind:int>")
    wrap = F.when(k.eqNullSafe(F.lit(facts["top"])), F.struct(F.lit(0).alias("b"), F.lit(2).alias("kind")))
    placed = docs.withColumn(f"{P}place", F.explode(F.array_compact(F.array(F.struct(own.cast("int").alias("b"), F.lit(0).alias("kind")), next_one, wrap))))
    placed = placed.withColumn(f"{P}b", F.col(f"{P}place.b")).withColumn(f"{P}kind", F.col(f"{P}place.kind")).drop(f"{P}place")
    order = Window.partitionBy(f"{P}b").orderBy(f"{P}kind", k.desc_nulls_last(), *[F.col(c) for c in columns if c == f"{P}tie"], *[F.col(c) for c in columns if c == f"{P}t"])
    return placed.withColumns({f"{P}next_{c.removeprefix(P)}": F.lead(c).over(order) for c in columns}).filter(F.col(f"{P}kind") == 0).drop(f"{P}b", f"{P}kind")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, __cv_t, __cv_n, __cv_marks and the same of the edited text and the next document's marks."""
    t = docs.select(key, text_of(text).alias(f"{P}t")).withColumn(f"{P}n", F.length(f"{P}t").cast("long")).withColumn(f"{P}kept", (F.col(f"{P}n") - F.floor(F.col(f"{P}n") / 3)).cast("int"))
    t = t.withColumn(f"{P}both", with_start(F.col(f"{P}t"), F.col(f"{P}kept")))
    t = t.select(key, f"{P}t", f"{P}n", f"{P}kept", F.col(f"{P}both.marks").alias(f"{P}marks"), F.col(f"{P}both.start").alias(f"{P}start")).withColumn(f"{P}tie", F.xxhash64(f"{P}t"))
    f = followed(t, key, [f"{P}t", f"{P}tie", f"{P}marks"])
    f = f.withColumn(f"{P}edited", F.concat(F.substring(F.col(f"{P}t"), F.lit(1), F.col(f"{P}kept")), F.substring(F.col(f"{P}next_t"), F.lit(1), F.col(f"{P}n").cast("int") - F.col(f"{P}kept"))))
    return f.withColumn(f"{P}edited_marks", extended(F.col(f"{P}start"), F.col(f"{P}edited"), F.col(f"{P}kept")))


def query(spark, sf_dir: str) -> DataFrame:
    f = fingerprints(documents(spark, sf_dir).select("doc_id", "text"))
    f = f.withColumn(f"{P}near", aligned(F.col(f"{P}marks"), F.col(f"{P}edited_marks"))).withColumn(f"{P}far", aligned(F.col(f"{P}marks"), F.col(f"{P}next_marks")))
    return f.select(
        "doc_id", F.col(f"{P}n").alias("n_chars"), F.sha2(f"{P}edited", 256).alias("edited_sha256"), as_text(F.col(f"{P}marks")).alias("fingerprint"), as_text(F.col(f"{P}edited_marks")).alias("edited_fingerprint"),
        likeness(F.col(f"{P}marks"), F.col(f"{P}edited_marks")).alias("near_edited"), likeness(F.col(f"{P}marks"), F.col(f"{P}next_marks")).alias("near_next"),
        F.col(f"{P}near.n").cast("long").alias("aligned_edited"), F.col(f"{P}far.n").cast("long").alias("aligned_next"), F.col(f"{P}far.distance").alias("next_distance"),
    )


def query_edited(spark, sf_dir: str) -> DataFrame:
    """What the fingerprints are taken of: length and digest of each text and of its edited text."""
    t = documents(spark, sf_dir).select("doc_id", text_of("text").alias(f"{P}t")).withColumn(f"{P}tie", F.xxhash64(f"{P}t"))
    f = followed(t, "doc_id", [f"{P}t", f"{P}tie"]).withColumn(f"{P}n", F.length(f"{P}t"))
    part = F.floor(F.col(f"{P}n") / 3).cast("int")
    edited = F.concat(F.substring(F.col(f"{P}t"), F.lit(1), F.col(f"{P}n") - part), F.substring(F.col(f"{P}next_t"), F.lit(1), part))
    return f.select("doc_id", F.col(f"{P}n").cast("long").alias("n_chars"), F.sha2(f"{P}t", 256).alias("text_sha256"), F.sha2(edited, 256).alias("edited_sha256"))
