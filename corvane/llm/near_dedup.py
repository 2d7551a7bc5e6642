"""Near-duplicate detection by BagMinHash over the multiset of five-word shingles.

A shingle's weight is its number of occurrences. The weight axis is cut at 0, 1, 2, 4, 8, ...; each piece of it has its own
Poisson process of points (time, weight, component) drawn from the shingle's hash, so a shingle of weight w takes part
with about log w processes: those of whole pieces fully, that of the piece w falls into with its points thinned
by a coin for the weight's unit cell. A component's signature is the least time of its points; two documents agree in it with
probability sum(min) / sum(max), their weighted Jaccard similarity. Points are drawn in order of time, only until they
exceed the largest of the document's `COMPONENTS` minima, and for all documents of a batch at once.

Documents with equal word sequences are one class, of which only the first goes on. Signatures are cut into `BANDS` bands; documents that share a band's
value are candidates. In each band value's group, two hubs are compared with all others: the documents that share most band
values with others (the text that the others were made from, as a rule). A pair is compared by
one-byte signatures first (agreement of less than `LEAST_AGREEMENT`, more than five standard deviations below the threshold, is dropped)
and then by the exact overlap of the two multisets of the whole texts. Linked documents form components. Hubs join most of a group
in linear work; they settle nothing for two documents that are still in different components and neither of which was a hub. So in groups that still hold
several components all other members are compared too, those outside the group's largest component with everyone, in blocks of `BLOCK` documents or `BLOCK_CHARS` characters, block against block, each pair in the
first band that it shares. So every pair of candidates is compared, or is in one component already.

Defined cases: texts without words (null, empty, white space) are never linked; a text of one to four words is one shingle;
repeated rows are duplicates of each other; ids rank in ascending order with null last; an empty table gives no rows;
other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.operators.graph import components

from .common import P, documents, materialise, scratch
from .spans import numbered, slices

# Joins with tables that grow with the input carry a merge hint: the same plan at any size, and Spark splits their skewed partitions.

WORDS = 5
THRESHOLD = 0.8
COMPONENTS = 128
BANDS = 32
LEAST_AGREEMENT = 0.6

U = np.uint64
#: Multipliers of the 64-bit finaliser, the golden ratio's step and the shingle's base.
M1, M2, STEP, BASE = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53), U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(33))
    x *= M1
    x ^= x >> U(33)
    x *= M2
    x ^= x >> U(33)
    return x


class _Hashes(dict):
    """Word to 64-bit hash, bounded."""

    def __missing__(self, w: bytes) -> int:
        import xxhash

        if len(self) > 150_000:
            self.clear()
        h = xxhash.xxh3_64_intdigest(w)
        if len(w) <= 40:
            self[w] = h
        return h


_hashes = _Hashes()


def word_hashes(text: bytes) -> np.ndarray:
    words = text.split()  # bytes split at ASCII white space
    return np.fromiter(map(_hashes.__getitem__, words), U, len(words))


def shingles(w: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted hashes of all runs of `size` words, repeats included; of all words where there are fewer."""
    n = len(w)
    if n == 0:
        return w
    k = min(n, size)
    h = w[: n - k + 1].copy()
    for i in range(1, k):
        h *= BASE
        h += w[i : n - k + 1 + i]
    h = mix(h ^ U(k))
    h.sort()
    return h


def bag_minhash(bags: list[np.ndarray], components: int = COMPONENTS) -> np.ndarray:
    """(bags, components) least times; bags: sorted hashes with repeats, none empty."""
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    h = np.concatenate(bags)
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(h)))
    h, doc = h[at], doc[at]

    seeds, docs, los, cells, weights, lo, hi, level = [], [], [], [], [], 0, 1, 0
    some = np.arange(len(h))
    while len(some):
        seeds.append(mix(h[some] + STEP * np.full(1, level + 1, U)))
        docs.append(doc[some])
        weights.append(weight[some])
        los.append(np.full(len(some), lo))
        cells.append(np.full(len(some), hi - lo))
        lo, hi, level = hi, 2 * hi, level + 1
        some = some[weight[some] > lo]
    seed, doc, lo, cell, weight = (np.concatenate(x) for x in (seeds, docs, los, cells, weights))

    least = np.full((len(bags), components), np.inf)
    flat, time, drawn = least.reshape(-1), np.zeros(len(seed)), 0
    while len(seed):
        block = int(min(64, max(1, 60_000 // len(seed))))
        count = U(drawn) + np.arange(1, block + 1, dtype=U)
        x = mix(seed[:, None] + STEP * count)
        gaps = np.log(((x >> U(11)).astype(np.float64) + 1) * 2.0**-53)
        gaps /= -cell[:, None].astype(np.float64)
        gaps[:, 0] += time
        t = np.cumsum(gaps, axis=1)
        y = mix(x ^ BASE)
        which = (y % U(components)).astype(np.int64) + doc[:, None] * components
        if len(cell) and cell.max() > 1:
            inside = lo[:, None] + ((y >> U(20)) % cell[:, None].astype(U)).astype(np.int64) < weight[:, None]
            np.minimum.at(flat, which[inside], t[inside])
        else:
            np.minimum.at(flat, which.reshape(-1), t.reshape(-1))
        drawn += block
        on = t[:, -1] < least.max(1)[doc]
        time = t[on, -1]
        seed, doc, lo, cell, weight = seed[on], doc[on], lo[on], cell[on], weight[on]
    return least


def bands(least: np.ndarray, n: int = BANDS) -> np.ndarray:
    rows = least.shape[1] // n
    bits = least.view(U).reshape(len(least), n, rows)
    h = np.broadcast_to(np.arange(n, dtype=U) * STEP, bits.shape[:2]).copy()
    for i in range(rows):
        h = mix((h ^ bits[:, :, i]) * BASE + STEP)
    return h.view(np.int64)


def one_byte(least: np.ndarray) -> np.ndarray:
    return (mix(least.view(U) ^ BASE) >> U(56)).astype(np.uint8)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """sum(min) / sum(max) of two sorted bags of hashes."""
    if not len(a) or not len(b):
        return 0.0
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[i], cb[j]).sum())
    return common / (len(a) + len(b) - common)


_SIGNED = T.StructType([
    T.StructField("uid", T.LongType()), T.StructField("chars", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("bytes", T.ArrayType(T.ByteType())),
])
#: Words signed at a time.
AT_ONCE = 150_000
#: Documents and characters in a block of a group's members, and shingles compared with a document at a time.
BLOCK, BLOCK_CHARS, ELEMENTS = 1024, 8_000_000, 1_000_000


def _sign(batches: Iterator) -> Iterator:
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    to = to_arrow_schema(_SIGNED)

    def flush(ids, chars, digests, bags):
        least = bag_minhash(bags)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(chars, pa.int64()), pa.array(digests, pa.binary()), pa.array(list(bands(least)), pa.list_(pa.int64())), pa.array(list(one_byte(least).view(np.int8)), pa.list_(pa.int8()))], schema=to)

    for batch in batches:
        ids, chars, digests, bags, held = [], [], [], [], 0
        for i in range(batch.num_rows):
            t = batch.column(1)[i].as_py()
            w = word_hashes(t.encode("utf-8", "surrogatepass")) if t else ()
            if len(w):
                ids.append(batch.column(0)[i].as_py())
                chars.append(len(t))
                digests.append(hashlib.blake2b(b" ".join(t.encode("utf-8", "surrogatepass").split()), digest_size=16).digest())
                bags.append(shingles(w))
                held += len(w)
                if held >= AT_ONCE or len(bags) >= 1024:
                    yield flush(ids, chars, digests, bags)
                    ids, chars, digests, bags, held = [], [], [], [], 0
        if bags:
            yield flush(ids, chars, digests, bags)


def _verify(threshold: float):
    schema = "a long, b long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hub, bag = None, None
        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            ok = []
            for i in range(batch.num_rows):
                if hub != b[i].as_py():
                    hub, bag = b[i].as_py(), shingles(word_hashes(tb[i].as_py().encode("utf-8", "surrogatepass")))
                other = shingles(word_hashes(ta[i].as_py().encode("utf-8", "surrogatepass")))
                ok.append(similarity(other, bag) >= threshold)
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], names=["a", "b"])

    return run, schema


def elements(bag: np.ndarray) -> np.ndarray:
    """A sorted bag as a sorted set: equal hashes are told apart by their number, so bags overlap as their sets do."""
    if not len(bag):
        return bag
    at = np.arange(len(bag))
    first = np.maximum.accumulate(np.where(np.append(True, bag[1:] != bag[:-1]), at, 0))
    return np.sort(mix(bag + STEP * (at - first).astype(U)))


def _compare_blocks(threshold: float):
    """(a, b): components that a pair of a group's members links. Rows are sorted by group and pair of blocks; those that ask meet those that are asked."""
    schema = "a long, b long"

    def links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        band = rows[0][1]
        ask, several, uid, comp = (np.array([r[i] for r in rows]) for i in (4, 5, 6, 7))
        signed = np.array([r[8] for r in rows], np.int8)
        shared = np.array([r[9] for r in rows], np.int64)
        up, sets = {int(c): int(c) for c in comp}, {}

        def root(c):
            while up[c] != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        def of(k):
            if k not in sets:
                sets[k] = elements(shingles(word_hashes(rows[k][10].encode("utf-8", "surrogatepass"))))
            return sets[k]

        asked = np.flatnonzero(~ask)
        for k in np.flatnonzero(ask):
            # Of two that ask, the one with the lesser number does.
            others = asked[(comp[asked] != comp[k]) & (~several[asked] | (uid[asked] > uid[k]))]
            others = others[(signed[others] == signed[k]).sum(1) >= LEAST_AGREEMENT * COMPONENTS]
            # A pair is compared in the first band that it shares only.
            others = others[(shared[others] == shared[k]).argmax(1) == band]
            others = [o for o in others if root(int(comp[o])) != root(int(comp[k]))]
            own = of(k) if others else None
            at = 0
            while at < len(others):
                some, held = [], 0
                while at < len(others) and (not some or held < ELEMENTS):
                    some.append(others[at])
                    held += len(of(others[at]))
                    at += 1
                n = np.array([len(of(o)) for o in some])
                every = np.concatenate([of(o) for o in some])
                found = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
                common = np.add.reduceat(found.astype(np.int64), np.append(0, np.cumsum(n)[:-1]))
                for o in np.flatnonzero(common / (n + len(own) - common) >= threshold):
                    a, b = root(int(comp[k])), root(int(comp[some[o]]))
                    if a != b:
                        up[a] = b
                        yield a, b

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(rows):
            found = list(links(rows))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        rows: list[tuple] = []
        for part in slices(batches):
            for row in zip(*(part.column(i).to_pylist() for i in range(8)), part.column(8).to_numpy(zero_copy_only=False), part.column(9).to_numpy(zero_copy_only=False), part.column(10).to_pylist()):
                if rows and rows[0][:4] != row[:4]:
                    yield out(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield out(rows)

    return run, schema


def _rest_of_groups(docs: DataFrame, text: str, live: DataFrame, hubs: DataFrame, labels: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between components that no hub has shown, from all pairs of the other members of groups with several components.

    The members of a group's largest component need no comparison with each other: all others ask, everyone is asked. Both are dealt into blocks, and each block of those that
    ask meets each block of those that are asked.
    """
    own = hubs.select(F.col("bucket").alias("g"), "hub").hint("merge")
    rest = live.select("bucket", "i", "uid", "chars").join(own, (F.col("bucket") == F.col("g")) & (F.col("uid") == F.col("hub")), "left_anti")
    rest = rest.join(labels.hint("merge"), F.col("uid") == F.col("node"), "left").select("bucket", "i", "uid", "chars", F.coalesce("label", "uid").alias("comp"))
    per = rest.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("c"))
    blocks = lambda n, c: F.greatest(F.ceil(n / BLOCK), F.ceil(c / BLOCK_CHARS), F.lit(1)).cast("int")
    whole = per.groupBy(F.col("bucket").alias("g")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("c").alias("c"), F.max(F.struct("n", "comp", "c")).alias("top")).filter("k > 1")
    whole = materialise(whole.select("g", F.col("top.comp").alias("largest"), blocks(F.col("n"), F.col("c")).alias("x_blocks"), blocks(F.col("n") - F.col("top.n"), F.col("c") - F.col("top.c")).alias("y_blocks")), "rest-groups")
    rest = materialise(rest.join(whole.hint("merge"), F.col("bucket") == F.col("g")).select("bucket", "i", "uid", "comp", (F.col("comp") != F.col("largest")).alias("several"), "x_blocks", "y_blocks"), "rest")
    ids = rest.select("uid").distinct()
    texts = docs.select(F.col(f"{P}uid").alias("d"), F.col(text).alias("t")).join(ids.hint("merge"), F.col("d") == F.col("uid"), "left_semi")
    texts = materialise(reps.select("uid", "bytes", "bands").join(texts.hint("merge"), F.col("uid") == F.col("d")).drop("d"), "rest-texts")
    block = lambda of: F.pmod(F.xxhash64("uid"), of).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    columns = ["bucket", F.col("i").alias("band"), "x", "y", "ask", "several", "uid", "comp"]
    asked = rest.withColumn("ask", F.lit(False)).withColumn("x", block("x_blocks")).withColumn("y", every("y_blocks")).select(*columns)
    asking = rest.filter("several").withColumn("ask", F.lit(True)).withColumn("y", block("y_blocks")).withColumn("x", every("x_blocks")).select(*columns)
    dealt = asked.unionByName(asking).join(texts.hint("merge"), "uid").select("bucket", "band", "x", "y", "ask", "several", "uid", "comp", "bytes", "bands", "t")
    run, schema = _compare_blocks(threshold)
    return materialise(dealt.repartition("bucket", "band", "x", "y").sortWithinPartitions("bucket", "band", "x", "y").mapInArrow(run, schema), "rest-links")


def classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(uid, class_uid) of documents with words; class_uid is a member of the class. docs has __cv_uid."""
    signed = materialise(docs.select(F.col(f"{P}uid"), F.col(text)).mapInArrow(_sign, _SIGNED), "signatures")
    first = signed.groupBy("digest").agg(F.min("uid").alias("rep"))
    member = materialise(signed.select("uid", "digest").join(first.hint("merge"), "digest").select("uid", "rep"), "members")

    reps = signed.join(member.filter("uid = rep").select("uid").hint("merge"), "uid", "left_semi")
    band = reps.select("uid", "chars", F.posexplode("bands").alias("i", "v")).select("uid", "chars", "i", F.xxhash64("i", "v").alias("bucket"))
    # Only band values that several documents share; the rest is gone before anything is joined.
    shared = materialise(band.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-values")
    live = materialise(band.join(shared.hint("merge"), "bucket"), "buckets")
    degree = materialise(live.groupBy("uid").agg((-F.sum("n")).alias("rank")), "candidates")
    ranked = live.select("bucket", "uid").join(degree.hint("merge"), "uid")
    # Least ranks are aggregates with partial sums in each task; no group is sorted or collected.
    centre = F.struct("rank", "uid")
    one = materialise(ranked.groupBy("bucket").agg(F.min(centre).alias("c")), "first-hubs")
    two = ranked.join(one.hint("merge"), "bucket").filter(F.col("uid") != F.col("c.uid")).groupBy("bucket").agg(F.min(centre).alias("c2"))
    hubs = materialise(one.join(two.hint("merge"), "bucket").select("bucket", F.explode(F.array("c.uid", "c2.uid")).alias("hub")), "hubs")
    pairs = live.select("bucket", "uid").join(hubs.hint("merge"), "bucket").filter("uid <> hub").select("uid", "hub").distinct()
    sigs = materialise(reps.select("uid", "bytes").join(degree.select("uid").hint("merge"), "uid", "left_semi"), "candidate-signatures")
    # The signatures are compared in the join itself, so that only pairs worth a look at the texts come out of it.
    equal = F.aggregate(F.zip_with("x", "y", lambda p, q: (p == q).cast("int")), F.lit(0), lambda n, e: n + e)
    mine = pairs.join(sigs.select("uid", F.col("bytes").alias("x")).hint("merge"), "uid")
    theirs = sigs.select(F.col("uid").alias("other"), F.col("bytes").alias("y")).hint("merge")
    near = mine.join(theirs, (F.col("hub") == F.col("other")) & (equal >= LEAST_AGREEMENT * COMPONENTS))
    near = materialise(near.select(F.greatest("uid", "hub").alias("uid"), F.least("uid", "hub").alias("hub")).distinct(), "near-pairs")
    of = near.select("uid").union(near.select("hub")).distinct()
    texts = materialise(docs.select(F.col(f"{P}uid").alias("uid"), F.col(text).alias("text")).join(of.hint("merge"), "uid", "left_semi"), "candidate-texts")
    run, schema = _verify(threshold)
    both = near.join(texts.select("uid", F.col("text").alias("ta")).hint("merge"), "uid").join(texts.select(F.col("uid").alias("hub"), F.col("text").alias("tb")).hint("merge"), "hub")
    links = materialise(both.select("uid", "hub", "ta", "tb").mapInArrow(run, schema), "links")
    labels = components(links)
    more = components(_rest_of_groups(docs, text, live, hubs, labels, reps, threshold)).select(F.col("node").alias("from"), F.col("label").alias("to"))
    found = member.join(labels.hint("merge"), F.col("rep") == F.col("node"), "left").select("uid", F.coalesce("label", "rep").alias("class_uid"))
    return found.join(more.hint("merge"), F.col("class_uid") == F.col("from"), "left").select("uid", F.coalesce("to", "class_uid").alias("class_uid"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with __cv_class (the id of the class's first document), __cv_class_size and __cv_stays."""
    docs = numbered(docs)
    with scratch(docs.sparkSession):
        found = materialise(classes(docs, text), "classes")
        place = F.struct(F.col("rank").isNull().alias("a"), F.col("rank").alias("b"), F.col("uid").alias("c"))
        ranked = found.join(docs.select(F.col(f"{P}uid").alias("u"), F.col(key).alias("rank")).hint("merge"), F.col("uid") == F.col("u"))
        head = ranked.groupBy("class_uid").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        # Written first, so that the next join has shuffles of its own and Spark splits the partitions of large classes.
        head = materialise(head.select("class_uid", "first", "n"), "heads")
        of = materialise(found.join(head.hint("merge"), "class_uid").select(F.col("uid").alias(f"{P}of"), F.col("first.b").alias(f"{P}first"), F.col("first.c").alias(f"{P}head"), F.col("n").alias(f"{P}n")), "classes-of", keep=True)
    out = docs.join(of.hint("merge"), F.col(f"{P}uid") == F.col(f"{P}of"), "left")
    alone = F.col(f"{P}of").isNull()
    out = out.withColumn(f"{P}class", F.when(alone, F.col(key)).otherwise(F.col(f"{P}first"))).withColumn(f"{P}class_size", F.coalesce(f"{P}n", F.lit(1)).cast("long"))
    return out.withColumn(f"{P}stays", alone | (F.col(f"{P}uid") == F.col(f"{P}head"))).drop(f"{P}uid", f"{P}of", f"{P}first", f"{P}head", f"{P}n")


def query(spark, sf_dir: str) -> DataFrame:
    d = deduplicate(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select("doc_id", F.col(f"{P}class").alias("class_id"), F.col(f"{P}class_size").alias("class_size"), F.col(f"{P}stays").alias("stays"))
