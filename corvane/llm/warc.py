"""WARC archives: written as text by Spark, read back by boundary-chain verification.

Writing. Of the rows with equal payloads of at least `revisit_bytes` bytes that with the largest id becomes a response record, the
others become revisit records that refer to it; smaller payloads are always responses. A record is one row of Spark's
text writer, whose line separator is the two line ends that close a record, so any storage Spark can write holds the archives.

Reading. Archives are split once at the magic `WARC/1.0`, which may as well stand inside a payload, and the pieces are written, numbered in the order of
their split of the file, so that all later jobs read the same numbers. Every piece is a candidate record; its
header's Content-Length gives the candidate's successor offset. Tasks emit (offset, successor) for the candidates of a block of the
file and shorten each chain to where it leaves the block; pointer jumping over the blocks from the start of the
file finds the offsets where the true chain enters each one, and one more pass over the blocks marks the records reached. Pieces
between two reached offsets belong to the earlier record's payload. Nothing larger than the offsets of a block is held together;
the pieces of one record are joined in order.

Defined cases: a null payload is written as an empty one; a null id is written as the text `null` and read back as null;
rows repeated with the same id are all responses or all revisits; rows that share payload and the largest id are all responses;
an empty table gives an archive without records and no rows; other columns are never read. A file that doesn't begin with a record has none;
the chain of a file ends before a record that states no length, and at one that is cut off, which is read as far as it goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import P, materialise, new_folder, scratch, ship

#: Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

REVISIT_BYTES = 1000
BLOCK = 4 << 20


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One row per page: id, uri, payload, its size and digest, record_type and refers_to."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("string")
    base = pages.select(F.col(key).alias(f"{P}id"), F.coalesce(F.col(url), F.lit("")).alias(f"{P}uri"), payload.alias(f"{P}payload"))
    base = base.withColumn(f"{P}size", F.octet_length(f"{P}payload").cast("long")).withColumn(f"{P}digest", F.sha1(F.col(f"{P}payload").cast("binary")))
    large = F.col(f"{P}size") >= revisit_bytes
    # Only digests that occur twice matter; the table of them is written, so that its size decides how it is joined.
    keepers = base.filter(large).groupBy(f"{P}digest").agg(F.max(f"{P}id").alias(f"{P}keep"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(f"{P}digest").alias(f"{P}of"), f"{P}keep")
    keepers = materialise(keepers, "warc-keepers")
    joined = base.join(keepers, large & (F.col(f"{P}digest") == F.col(f"{P}of")), "left")
    revisit = F.col(f"{P}keep").isNotNull() & ~F.col(f"{P}id").eqNullSafe(F.col(f"{P}keep"))
    return joined.withColumn(f"{P}type", F.when(revisit, "revisit").otherwise("response")).withColumn(f"{P}refers", F.when(revisit, F.col(f"{P}keep"))).drop(f"{P}of", f"{P}keep")


def _urn(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))


def write(pages: DataFrame, path: str, **how) -> None:
    with scratch(pages.sparkSession):
        _write(records(pages, **how), path)


def _write(r: DataFrame, path: str) -> None:
    revisit = F.col(f"{P}type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col(f"{P}payload"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col(f"{P}size").cast("string"), F.lit(END))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.col(f"{P}type"), F.lit("\r\nWARC-Record-ID: "), _urn(F.col(f"{P}id")),
        F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.regexp_replace(f"{P}uri", "[\\r\\n]", " "),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col(f"{P}digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _urn(F.col(f"{P}refers")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(END),
    )
    r.select(F.concat(head, http, body).alias("value")).write.option("lineSep", END).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magics, numbered in file order inside each split: file, split, seq, value."""
    return spark.read.option("lineSep", MAGIC).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("seq"))


def _offsets(raw: DataFrame) -> DataFrame:
    """(file, split, seq, offset, length): offsets from the lengths of all pieces before, summed in two levels."""
    sized = raw.select("file", "split", "seq", F.octet_length("value").cast("long").alias("length"), _successor(F.col("value")).alias("span"))
    sized = materialise(sized, "warc-lengths")
    step = F.col("length") + len(MAGIC)
    splits = sized.groupBy("file", "split").agg(F.sum(step).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("file").alias("f"), F.col("split").alias("s"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    joined = sized.join(splits, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s")))
    # The piece's magic stands before it; the first piece of a file is what stands before the first magic (nothing, in a WARC file).
    start = F.col("base") + F.coalesce(F.sum(step).over(inside), F.lit(0)) - len(MAGIC)
    return materialise(joined.select("file", "split", "seq", start.alias("offset"), "length", (start + F.col("span")).alias("next")), "warc-places")


def _successor(value: Column) -> Column:
    """Bytes from this magic to the next record's by the header's Content-Length; null where this is no header."""
    header = F.substring_index(value, END, 1)
    stated = F.regexp_extract(header, r"(?i)(?:^|\r\n)Content-Length:[ \t]*(\d{1,18})[ \t]*(?:\r\n|$)", 1)
    fits = F.octet_length(header) < F.octet_length(value)
    return F.when(fits & (stated != ""), F.lit(len(MAGIC)) + F.octet_length(header) + 2 * len(END) + stated.cast("long"))


_PAIR = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("exit", T.LongType())])
_REACHED = T.StructType([T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("next", T.LongType())])


def _exits(pdf):
    """Each candidate's first offset on its chain that is outside the block; -1 where the chain breaks."""
    at = dict(zip(pdf["offset"].tolist(), pdf["next"].fillna(-1).astype("int64").tolist()))
    last = {}
    for o in sorted(at, reverse=True):
        n = at[o]
        last[o] = last[n] if n > o and n in last else n if n > o else -1
    out = pdf[["file", "block", "offset"]].copy()
    out["exit"] = [last[o] for o in out["offset"]]
    return out


def _follow(key, ours, entries):
    import pandas as pd

    at = dict(zip(ours["offset"].tolist(), ours["next"].fillna(-1).astype("int64").tolist()))
    found = []
    for e in entries["entry"].tolist():
        while e in at and at[e] > e:
            found.append(e)
            e = at[e]
    return pd.DataFrame({"file": key[0], "offset": found, "next": [at[o] for o in found]})


def chain(candidates: DataFrame, block: int = BLOCK) -> DataFrame:
    """(file, offset, next) of the candidates that the chain from the start of each file reaches."""
    c = candidates.filter("offset >= 0").select("file", F.floor(F.col("offset") / block).cast("long").alias("block"), "offset", "next")
    jump = materialise(c.groupBy("file", "block").applyInPandas(_exits, _PAIR).select("file", "offset", "exit"), "warc-exits")
    reached = jump.filter("offset = 0").select("file", "offset", F.col("offset").alias("entry"))
    found = reached.count()
    rounds = 0
    while True:
        # Twice as far each round: what is reached also reaches its jump's end, and jumps are joined to themselves.
        ends = jump.select("file", F.col("offset").alias("from"), "exit")
        more = reached.join(ends.hint("merge"), (reached["file"] == ends["file"]) & (reached["offset"] == ends["from"])).filter("exit >= 0").select(reached["file"], F.col("exit").alias("offset"))
        reached = materialise(reached.select("file", "offset").union(more).distinct(), f"warc-reached-{rounds}")
        now = reached.count()
        if now == found:
            break
        found, rounds = now, rounds + 1
        a, b = jump.alias("a"), jump.alias("b")
        jump = materialise(a.join(b.hint("merge"), (F.col("a.file") == F.col("b.file")) & (F.col("a.exit") == F.col("b.offset")), "left").select(F.col("a.file").alias("file"), F.col("a.offset").alias("offset"), F.coalesce(F.col("b.exit"), F.lit(-1)).alias("exit")), f"warc-jump-{rounds}")
    entries = reached.select("file", F.floor(F.col("offset") / block).cast("long").alias("block"), F.col("offset").alias("entry"))
    return c.groupBy("file", "block").cogroup(entries.groupBy("file", "block")).applyInPandas(_follow, _REACHED)


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _parsed(bodies: DataFrame) -> DataFrame:
    """Header, HTTP header and payload (binary) of each body."""
    header = F.substring_index("value", END, 1)
    b = bodies.withColumn("header", header).withColumn("block", F.expr(f"substring(cast(value as binary), octet_length(header) + {len(END) + 1}, try_cast(regexp_extract(header, '(?i)(?:^|\\r\\n)Content-Length:[ \\t]*(\\\\d{{1,18}})', 1) as int))"))
    b = b.withColumn("http", F.substring_index(F.col("block").cast("string"), END, 1))
    return b.withColumn("payload", F.expr(f"substring(block, octet_length(http) + {len(END) + 1})")).select("file", "record", "header", "http", "payload")


def read(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Records of the archives below path: file, record (its offset), header, http and payload (binary)."""
    ship(spark)
    raw = materialise(pieces(spark, path), "warc-text", keep=True)
    with scratch(spark):
        odd = _odd(raw, block)
    at = ["file", "split", "seq"]
    single = raw.join(odd.select(*at), at, "left_anti").withColumn("record", F.col("seq"))
    many = raw.join(odd.filter("record is not null"), at).groupBy("file", "record").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]), MAGIC).alias("value"))
    return _parsed(single.select("file", "record", "value").unionByName(many))


def _odd(raw: DataFrame, block: int) -> DataFrame:
    """(file, split, seq, offset, record) of the pieces that are no whole record; record is the offset of theirs, null before the first."""
    places = _offsets(raw)
    true = chain(places, block).select("file", "offset", F.lit(True).alias("starts"))
    # A piece belongs to the last record that starts at or before it in its file. Nearly all records have one piece.
    order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = places.join(true.hint("merge"), ["file", "offset"], "left").withColumn("record", F.max(F.when(F.col("starts"), F.col("offset"))).over(order))
    owned = owned.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("file", "record")))
    return materialise(owned.filter("n > 1 or record is null").select("file", "split", "seq", "offset", "record"), "warc-odd", keep=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    path = new_folder(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    r = read(spark, path)
    revisit = _field(F.col("header"), "WARC-Type") == "revisit"
    ident = lambda name: F.nullif(F.regexp_extract(_field(F.col("header"), name), "<urn:page:([^>]*)>", 1), F.lit("null"))
    return r.select(
        ident("WARC-Record-ID").try_cast("long").alias("page_id"),
        F.when(revisit, _field(F.col("http"), "Content-Length").try_cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.regexp_extract(_field(F.col("header"), "WARC-Payload-Digest"), "sha1:([0-9a-f]+)", 1)).otherwise(F.sha1("payload")).alias("payload_digest"),
        _field(F.col("header"), "WARC-Type").alias("record_type"),
        F.when(revisit, ident("WARC-Refers-To").try_cast("long")).alias("refers_to"),
    )
