"""What an export holds, worked out over tables of its files: annotation documents and their image folders, names of extracted images, image paths, sizes, and the scan that joins them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import scalar as S
from corvane.functions.config import SPLITS
from corvane.operators.merge import dense_ids
from corvane.session import ship

from .readers import ANNOTATION_FILES, IMAGE_SUFFIXES


def annotation_files(listing: DataFrame) -> DataFrame:
    """listing (grp, path below the group's folder) -> (grp, annotation, image_dir, place): documents in the folder itself and in those of the splits, in that order and by accepted name.

    Images are in the folder `images` beside the document where there is one, else beside the document.
    """
    parts = F.split("path", "/")
    folder = F.when(F.size(parts) == 1, F.lit("")).when((F.size(parts) == 2) & F.get(parts, F.lit(0)).isin(*SPLITS), F.get(parts, F.lit(0)))
    name = F.array_position(F.lit(list(ANNOTATION_FILES)), S.basename(F.col("path")))
    found = listing.select("grp", F.col("path").alias("annotation"), folder.alias("dir"), name.alias("name")).filter("dir is not null and name > 0")
    nested = listing.select("grp", F.regexp_extract("path", r"^(?:(.*)/)?images/[^/]+", 1).alias("dir")).filter(F.col("path").rlike(r"^(?:.*/)?images/")).distinct().withColumn("nested", F.lit(True))
    j = found.join(nested, ["grp", "dir"], "left")
    under = F.when(F.col("dir") == "", "images").otherwise(F.concat("dir", F.lit("/images")))
    first = F.when(F.col("dir") == "", 0).otherwise(F.array_position(F.lit(list(SPLITS)), F.col("dir")))
    return j.select("grp", "annotation", F.when(F.col("nested"), under).otherwise(F.col("dir")).alias("image_dir"), (first * 10 + F.col("name")).cast("int").alias("place"))


def extraction_names(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """annotations (archive, annotation) and images (archive, annotation, pos from 0, file_name, member or null) -> where each image goes under which short name.

    Documents are numbered in the order of their names; a folder is that of the split in the document's path, or one of its own where an earlier document took that. Images without a
    member are left out, but their positions count.
    """
    per = Window.partitionBy("archive").orderBy("annotation")
    a = annotations.withColumn("ann", F.row_number().over(per)).withColumn("split", F.get(F.filter(F.reverse(F.split(S.clean_path(F.col("annotation")), "/")), lambda p: p.isin(*SPLITS)), F.lit(0)))
    taken = F.row_number().over(Window.partitionBy("archive", F.coalesce("split", F.lit(""))).orderBy("ann"))
    a = a.select("archive", "annotation", "ann", F.when(taken > 1, F.format_string("part_%02d", "ann")).otherwise(F.coalesce("split", F.lit(""))).alias("folder"))
    usable = lambda c: F.when(S.suffix(c).isin(*IMAGE_SUFFIXES), S.suffix(c))
    j = images.filter("member is not null").join(a, ["archive", "annotation"])
    ext = F.coalesce(usable(F.col("file_name")), usable(F.col("member")), F.lit(".jpg"))
    return j.select("archive", "annotation", "folder", F.format_string("img_%02d_%06d%s", F.col("ann"), F.col("pos") + 1, ext).alias("file_name"), F.col("file_name").alias("original_file_name"), "member")


def image_paths(requests: DataFrame, files: DataFrame) -> DataFrame:
    """requests (id, dir, file_name) with the first of four paths that is among files (path): below the folder by whole and by base name, then below the folder above it."""
    name, above = F.col("file_name"), S.parent(F.col("dir"))
    under = lambda d, n: F.when(d == "", n).otherwise(F.concat(d, F.lit("/"), n))
    tried = F.array(under(F.col("dir"), name), under(F.col("dir"), S.basename(name)), under(above, name), under(above, S.basename(name)))
    hits = requests.select("id", F.posexplode(tried).alias("p", "candidate")).join(files.select(F.col("path").alias("candidate")), "candidate")
    return requests.join(hits.groupBy("id").agg(F.min_by("candidate", "p").alias("path")), "id", "left").select("id", "path")


_SIZE = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])


def size_of(content: bytes | None) -> tuple[int, int]:
    """Width and height from the header of a PNG, JPEG, BMP or lossy WebP file; 0 and 0 where there is none to read."""
    b = content or b""
    if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        return int.from_bytes(b[16:20], "big"), int.from_bytes(b[20:24], "big")
    if b[:2] == b"BM" and len(b) >= 26:
        return int.from_bytes(b[18:22], "little"), abs(int.from_bytes(b[22:26], "little", signed=True))
    if b[:4] == b"RIFF" and b[8:16] == b"WEBPVP8 " and len(b) >= 30:
        return int.from_bytes(b[26:28], "little") & 0x3FFF, int.from_bytes(b[28:30], "little") & 0x3FFF
    if b[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(b) and b[at] == 0xFF:
            kind = b[at + 1]
            if kind == 0xFF:  # padding
                at += 1
            elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):  # a frame, not a table
                return int.from_bytes(b[at + 7 : at + 9], "big"), int.from_bytes(b[at + 5 : at + 7], "big")
            elif kind == 0x01 or 0xD0 <= kind <= 0xD8:  # no length
                at += 2
            else:
                at += 2 + int.from_bytes(b[at + 2 : at + 4], "big")
    return 0, 0


def header_size(content: Column) -> Column:
    """struct(width, height) of encoded images, by their headers alone."""
    ship(SparkSession.active())

    @F.pandas_udf(_SIZE)
    def of(values):
        import pandas as pd

        return pd.DataFrame([size_of(None if v is None else bytes(v)) for v in values], columns=["width", "height"])

    return of(content)


def coco_sources(images: DataFrame, files: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """The scan of a group's documents: one row per usable image, with a dense source_index per group and its annotations' number and known categories.

    images (grp, doc, place, pos, id, dir, file_name, width, height), files (path, width, height, content_hash), annotations (doc, image_id, category_id), categories (doc, id, name).
    Images without a name, a file, or a size in the document or the file's header are dropped.
    """
    named = images.filter(F.nullif(F.col("file_name"), F.lit("")).isNotNull()).withColumn("key", F.struct("doc", "pos"))
    paths = image_paths(named.select(F.col("key").alias("id"), "dir", "file_name"), files).filter("path is not null")
    f = files.select(F.col("path").alias("p"), F.col("width").alias("w"), F.col("height").alias("h"), "content_hash")
    j = named.join(paths, F.col("key") == paths["id"]).drop(paths["id"]).join(f, F.col("path") == F.col("p"))
    own = (F.col("width") > 0) & (F.col("height") > 0)
    j = j.withColumns({"width": F.when(own, F.col("width")).otherwise(F.col("w")), "height": F.when(own, F.col("height")).otherwise(F.col("h"))}).filter("width > 0 and height > 0")
    known = categories.select(F.col("doc").alias("d"), F.col("id").alias("c"), S.blank_to_null(F.col("name")).alias("name"))
    per = annotations.join(known, (F.col("doc") == F.col("d")) & (F.col("category_id") == F.col("c")), "left").groupBy("doc", "image_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("name").isNull()).alias("u"))
    j = j.join(per.select(F.col("doc").alias("ad"), "image_id", "n", "u"), (F.col("doc") == F.col("ad")) & (F.col("id") == F.col("image_id")), "left")
    j = dense_ids(j, "__n", [F.col("grp"), F.col("place"), F.floor(F.col("pos") / 4096)], [F.col("pos")])
    first = j.groupBy(F.col("grp").alias("g")).agg(F.min("__n").alias("__first"))
    j = j.join(first, F.col("grp") == F.col("g")).withColumn("source_index", F.col("__n") - F.col("__first") + 1)
    key = S.source_key(F.col("grp"), F.col("doc"), F.col("id").cast("string"), F.col("file_name"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return j.select("grp", "source_index", "path", F.col("file_name").alias("original_file_name"), "width", "height", key.alias("source_key"), "content_hash", zero("n").alias("n_annotations"), zero("u").alias("n_unknown"))


def class_names(lines: DataFrame) -> DataFrame:
    """lines (n, line) of a dataset description -> (class_id, class_name), from a list or a mapping below `names:`, in block or flow form."""
    text = lines.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("t"))
    block = F.regexp_extract("t", r"(?s)(?:^|\n)names:[ \t]*(.*?)(?:\n[^\s\-#\]\}][^\n]*:.*)?$", 1)
    entry = F.regexp_extract_all(block, F.lit(r"(?m)(?:^|[\[\{,]|- )[ \t]*((?:\d+[ \t]*:[ \t]*)?(?:\"(?:[^\"\\]|\\.)*\"|'[^']*'|[^,\[\]\{\}\n\"'\-: ][^,\[\]\{\}\n:]*))"), F.lit(1))
    e = text.select(F.posexplode(entry).alias("pos", "e"))
    ident = F.coalesce(F.nullif(F.regexp_extract("e", r"^(\d+)[ \t]*:", 1), F.lit("")).cast("int"), F.col("pos"))
    name = F.trim(F.regexp_replace("e", r"^\d+[ \t]*:[ \t]*", ""))
    quoted = F.from_json(F.concat(F.lit("["), name, F.lit("]")), "array<string>")[0]
    return e.select(ident.alias("class_id"), F.when(F.startswith(name, F.lit('"')), quoted).when(F.startswith(name, F.lit("'")), F.substring(name, F.lit(2), F.length(name) - 2)).otherwise(name).alias("class_name"))


def first_dataset(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """candidates (place, dir): the first that holds a description among files (path), else the first."""
    held = files.select("path").distinct()
    j = candidates.join(held, F.concat("dir", F.lit("/data.yaml")) == F.col("path"), "left")
    return j.agg(F.min_by("dir", F.struct(F.col("path").isNull(), "place")).alias("dir"))


def evaluation_records(images: DataFrame, lines: DataFrame) -> DataFrame:
    """images (dir, stem, file_name, width, height) with their group and label lines (dir, stem, line_number, line), matched in their own split's folder."""
    per = lines.groupBy("dir", "stem").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_number", "line"))), lambda x: x["line"]).alias("lines"))
    r = images.join(per, ["dir", "stem"], "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
    return r.withColumn("grp", S.group_from_name(F.col("file_name")))


def dataset_names(spark, path: str) -> DataFrame:
    """Class names of the dataset description at path."""
    text = spark.read.text(path, wholetext=True)
    return class_names(text.select(F.posexplode(F.split("value", r"\r?\n")).alias("n", "line")))
