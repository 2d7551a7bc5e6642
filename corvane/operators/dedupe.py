"""Duplicate sources: equal content, near signatures, transitive clusters, survivors."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.scalar import hamming
from corvane.tables import materialise

from .graph import components
from .merge import dense_ids

#: Columns of the duplicate report, in order.
REPORT = ("content_hash", "perceptual_hash", "action", "grp", "source_key", "original_file_name", "path", "annotations", "width", "height", "kept_source_key")


def rank_of() -> Column:
    """Least first: most annotations, then group, name without case, key."""
    return F.struct((-F.col("n_ann")).alias("a"), F.col("grp").alias("b"), F.lower("original_file_name").alias("c"), F.col("source_key").alias("d"), F.col("doc_id").alias("e"))


def exact_duplicates(sources: DataFrame) -> DataFrame:
    """Sources whose content others have too, with the one that stays. One pass groups, a merge join brings the group's facts back."""
    g = sources.groupBy("content_hash").agg(F.min(rank_of()).alias("keep"), F.min("source_key").alias("cluster"), F.count(F.lit(1)).alias("cluster_size")).filter("cluster_size > 1")
    j = sources.join(g, "content_hash")
    return j.select("doc_id", "grp", "content_hash", "cluster", "cluster_size", F.col("keep.d").alias("kept_source_key"), F.when(F.col("doc_id") == F.col("keep.e"), "kept").otherwise("removed").alias("action"))


def bands(sig: Column, bits: int, n: int) -> Column:
    """The signature cut into n pieces of equal width, the first ones one bit wider where it doesn't go even."""
    out, low = [], 0
    for i in range(n):
        width = bits // n + (1 if i < bits % n else 0)
        out.append(F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(sig, low).bitwiseAND(F.lit((1 << width) - 1)).alias("value")))
        low += width
    return F.array(*out)


def keys(sig: Column, bits: int, threshold: int, more: int = 4) -> Column:
    """Of threshold + more bands of a signature each choice of `more`, as one key: signatures within the threshold agree in one of them at least."""
    pieces = bands(sig, bits, threshold + more)
    chosen = []
    for n, some in enumerate(combinations(range(threshold + more), more)):
        key = F.lit(0).cast("long")
        for i in some:
            key = F.shiftleft(key, bits // (threshold + more) + 1).bitwiseOR(F.get(pieces, F.lit(i))["value"])
        chosen.append(F.struct(F.lit(n).alias("choice"), key.alias("key")))
    return F.array(*chosen)


def near_pairs(signatures: DataFrame, threshold: int = 2, bits: int = 32) -> DataFrame:
    """Pairs of different signatures (a < b) at a Hamming distance of at most threshold, with the distance.

    At most threshold of the bands differ, so an equi-join on all choices of the others misses no pair, and its keys have two thirds of the signature's
    bits; equal signatures are one row here.
    """
    s = signatures.select("sig").distinct().select("sig", F.explode(keys(F.col("sig"), bits, threshold)).alias("k")).select("sig", "k.choice", "k.key")
    s = materialise(s, "signature-keys", keep=True)
    a, b = s.select(F.col("sig").alias("a"), "choice", "key"), s.select(F.col("sig").alias("b"), "choice", "key")
    pairs = a.join(b.hint("merge"), ["choice", "key"]).filter("a < b").select("a", "b", hamming(F.col("a"), F.col("b")).alias("distance"))
    return pairs.filter(F.col("distance") <= threshold).distinct()


def representatives(signatures: DataFrame) -> DataFrame:
    """sig, its first document and its number of documents."""
    return signatures.groupBy("sig").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))


def near_document_pairs(signatures: DataFrame, threshold: int = 2, bits: int = 32) -> DataFrame:
    """Pairs of the first documents of different signatures within the threshold, with the numbers of documents on both sides: n copies are one side, not n pairs. representatives() has the membership."""
    reps = materialise(representatives(signatures), "signatures", keep=True)
    of = lambda side: reps.select(F.col("sig").alias(side), F.col("first").alias(f"f{side}"), F.col("n").alias(f"n{side}"))
    j = near_pairs(reps, threshold, bits).join(of("a"), "a").join(of("b"), "b")
    swap = F.col("fa") > F.col("fb")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return j.select(pick("fa", "fb").alias("doc_a"), pick("fb", "fa").alias("doc_b"), pick("na", "nb").alias("n_a"), pick("nb", "na").alias("n_b"), "distance")


def near_clusters(sources: DataFrame, signatures: DataFrame, threshold: int = 2, bits: int = 32, exact: bool = False) -> DataFrame:
    """doc_id, cluster_id (least member) and sig of documents in clusters of two or more; clusters are transitive.

    Documents are tied to the first one of their signature (and content, if exact), so a group of n copies costs n edges.
    """
    signatures = materialise(signatures.select("doc_id", "sig"), "signatures", keep=True)
    first = signatures.groupBy("sig").agg(F.min("doc_id").alias("first"))
    star = signatures.join(first, "sig").filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    p = near_pairs(signatures, threshold, bits)
    far = p.join(first.select(F.col("sig").alias("a"), F.col("first").alias("x")), "a").join(first.select(F.col("sig").alias("b"), F.col("first").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    edges = star.union(far)
    if exact:
        head = sources.groupBy("content_hash").agg(F.min("doc_id").alias("first"))
        edges = edges.union(sources.join(head, "content_hash").filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b")))
    labels = components(edges)
    return labels.select(F.col("node").alias("doc_id"), F.col("label").alias("cluster_id"))


def cluster_report(sources: DataFrame, signatures: DataFrame, threshold: int = 2, bits: int = 32, exact: bool = False) -> DataFrame:
    """Members of near clusters, the one that stays, and each member's distance to it (which may be above the threshold)."""
    signatures = materialise(signatures.select("doc_id", "sig"), "signatures", keep=True)
    c = near_clusters(sources, signatures, threshold, bits, exact).join(sources, "doc_id").join(signatures, "doc_id")
    keep = c.groupBy("cluster_id").agg(F.min(F.struct(rank_of().alias("r"), F.col("sig").alias("f"))).alias("keep"), F.count(F.lit(1)).alias("cluster_size"))
    keep = keep.select("cluster_id", "cluster_size", F.col("keep.r").alias("keep"), F.col("keep.f").alias("keep_sig"))
    j = c.join(keep, "cluster_id")
    return j.select(
        "doc_id", "cluster_id", "cluster_size", F.col("keep.d").alias("kept_source_key"), F.when(F.col("doc_id") == F.col("keep.e"), "kept").otherwise("would_remove").alias("action"), hamming(F.col("sig"), F.col("keep_sig")).alias("hamming_to_keep"),
        "grp", "source_key", "original_file_name", "n_ann", "content_hash", "sig", F.col("keep.b").alias("kept_grp"),
    )


def numbered_clusters(report: DataFrame) -> DataFrame:
    """cluster_id with its place from 1: larger clusters first, then by the group of the one that stays, then the id. Sizes cut the order into stretches."""
    c = report.filter("action = 'kept'").select("cluster_id", "cluster_size", "kept_grp")
    return dense_ids(c, "cluster_number", [-F.col("cluster_size"), F.col("kept_grp")], [F.col("cluster_id")])


def sheet_members(report: DataFrame, clusters: int = 24, members: int = 8) -> DataFrame:
    """For review: the first members of the first clusters, the one that stays first."""
    few = numbered_clusters(report).filter(F.col("cluster_number") <= clusters).select("cluster_id", "cluster_number")
    j = report.join(few, "cluster_id")
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.col("action") != "kept", "grp", "original_file_name", "source_key"))
    return j.withColumn("position", place).filter(F.col("position") <= members).select("cluster_number", "position", "doc_id", "action", "grp", "n_ann")


def near_summary(report: DataFrame) -> DataFrame:
    """Per group and over all: sources that would go, and the clusters and sources that stay."""
    per = report.rollup("grp").agg(F.count_if(F.col("action") != "kept").alias("would_remove"), F.count_if(F.col("action") == "kept").alias("clusters"))
    return per.withColumn("grp", F.coalesce("grp", F.lit("all")))


def survivors(sources: DataFrame, signatures: DataFrame, threshold: int = 2, bits: int = 32) -> DataFrame:
    """Sources without the removed members of exact and near clusters."""
    c = near_clusters(sources, signatures, threshold, bits, exact=True).join(sources, "doc_id")
    keep = c.groupBy("cluster_id").agg(F.min(rank_of())["e"].alias("keep"))
    removed = c.join(keep, "cluster_id").filter("doc_id <> keep").select("doc_id")
    return sources.join(removed, "doc_id", "left_anti")


def summary(report: DataFrame) -> DataFrame:
    """Per group: sources kept and removed in clusters; and over all, with the number of clusters."""
    per = report.rollup("grp").agg(F.count_if(F.col("action") == "kept").alias("kept"), F.count_if(F.col("action") != "kept").alias("removed"), F.count_distinct("content_hash").alias("clusters"))
    return per.withColumn("grp", F.coalesce("grp", F.lit("all")))


def duplicate_report(sources: DataFrame, perceptual_hash: Column | None = None) -> DataFrame:
    """The report of exact duplicates under its fixed columns, and `position`: inside each cluster the one that stays comes first, then by group, name and key."""
    d = exact_duplicates(sources).select("doc_id", "action", "kept_source_key", "cluster").join(sources, "doc_id")
    order = [F.col("action") != "kept", F.col("grp"), F.col("original_file_name"), F.col("source_key")]
    d = d.withColumn("position", F.row_number().over(Window.partitionBy("cluster").orderBy(*order)))
    return d.select("content_hash", (F.lit("") if perceptual_hash is None else perceptual_hash).alias("perceptual_hash"), "action", "grp", "source_key", "original_file_name", "path", F.col("n_ann").alias("annotations"), "width", "height", "kept_source_key", "position")


def summary_of(report: DataFrame) -> DataFrame:
    """One row of a duplicate report that was read back: clusters, kept, removed, and removed by group as a map in order."""
    removed = report.filter("action = 'removed'").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    by_group = removed.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce("grp", F.lit("unknown")).alias("grp"), "n")))).alias("removed_by_group"))
    total = report.agg(F.count_distinct(F.nullif(F.col("kept_source_key"), F.lit(""))).alias("clusters"), F.count_if(F.col("action") == "removed").alias("removed"), F.count_if(F.col("action") == "kept").alias("kept"))
    return total.crossJoin(by_group)  # one row each
