"""Readers for annotation documents, label files, metric tables and archives. All run as scans; annotation documents, a few for each group, are copied first, as their names are hidden ones to Spark."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import scalar as S
from corvane.tables import new_folder

#: Names of annotation files, image suffixes.
ANNOTATION_FILES = ("_annotations.coco.json", "_annotations.coco-segmentation.json", "_annotations.json")
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".webp")

COCO = (
    "images array<struct<id:bigint,file_name:string,width:int,height:int>>, categories array<struct<id:int,name:string,supercategory:string>>, "
    "annotations array<struct<id:bigint,image_id:bigint,category_id:int,segmentation:variant,bbox:array<double>,area:double>>"
)


def _staged(spark: SparkSession, path: str, names: tuple[str, ...]) -> DataFrame:
    """Files of these names below path as (doc, value). Spark's scans skip names with a leading underscore, so they are copied under others, by the file system.

    There is one document per group and split. Each is one row, so it must be below 2 GB.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root, to = jvm.org.apache.hadoop.fs.Path(path), new_folder(spark, "documents")
    fs = root.getFileSystem(conf)
    target = jvm.org.apache.hadoop.fs.Path(to)
    target.getFileSystem(conf).mkdirs(target)
    files, found = fs.listFiles(root, True), []
    while files.hasNext():
        f = files.next().getPath()
        if f.getName() in names:
            found.append((f"{len(found):08d}.json", f.toString()))
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, f, target.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(f"{to}/{found[-1][0]}"), False, conf)
    if not found:
        raise FileNotFoundError(f"no annotation document below {path}")
    text = spark.read.text(to, wholetext=True).select(S.basename(F.col("_metadata.file_path")).alias("copy"), "value")
    return text.join(spark.createDataFrame(found, "copy string, doc string"), "copy").select("doc", "value")


def coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images, annotations and categories of all annotation documents below path, each with the document's path."""
    docs = _staged(spark, path, ANNOTATION_FILES).select("doc", F.from_json(S.strip_bom(F.col("value")), COCO).alias("d"))
    images = docs.select("doc", F.posexplode("d.images").alias("pos", "i")).select("doc", "pos", "i.*").filter(S.blank_to_null(F.col("file_name")).isNotNull())
    annotations = docs.select("doc", F.posexplode("d.annotations").alias("ann_pos", "a")).select("doc", "ann_pos", "a.*").withColumn("polygons", polygons())
    categories = docs.select("doc", F.explode("d.categories").alias("c")).select("doc", "c.id", S.blank_to_null(F.col("c.name")).alias("name"))
    return images, annotations, categories


def polygons():
    """Segmentation of any form as polygons: one flat list, a list of lists of six numbers or more, or the box where it is an object (a run-length mask); none where it is missing."""
    text = F.expr("to_json(segmentation)")
    many = F.from_json(text, "array<array<double>>")
    flat = F.from_json(text, "array<double>")
    b = lambda i: F.get("bbox", F.lit(i))
    box = F.array(F.array(b(0), b(1), b(0) + b(2), b(1), b(0) + b(2), b(1) + b(3), b(0), b(1) + b(3)))
    none = F.array().cast("array<array<double>>")
    is_object, nested = F.startswith(text, F.lit("{")), text.rlike(r"^\[\s*\[")
    usable = F.col("bbox").isNotNull() & (b(2) > 1) & (b(3) > 1)
    return F.when(text.isNull() | (text == "null"), none).when(is_object, F.when(usable, box).otherwise(none)).when(nested, F.filter(many, lambda p: F.size(p) >= 6)).otherwise(F.array(flat))


def label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of label files: folder and stem of the file, line number (from 1) and text; blank lines are dropped, a missing file has no rows."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    lines = raw.select(S.basename(S.parent(F.col("_metadata.file_path"))).alias("dir"), S.stem(F.col("_metadata.file_path")).alias("stem"), F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    return lines.select("dir", "stem", (F.col("n") + 1).alias("line_number"), "line").filter(F.trim("line") != "")


def images(spark: SparkSession, path: str) -> DataFrame:
    """Image files: path, folder, name, stem, suffix, size in bytes and SHA-1 of the content."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    f = f.filter(S.suffix(F.col("path")).isin(*IMAGE_SUFFIXES))
    return f.select("path", S.basename(S.parent(F.col("path"))).alias("dir"), S.basename(F.col("path")).alias("file_name"), S.stem(F.col("path")).alias("stem"), S.suffix(F.col("path")).alias("suffix"), F.col("length"), F.sha1("content").alias("content_hash"))


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """A trainer's table of epochs: trimmed headers, cells that are no numbers null, epoch by position where it is missing."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    if raw.isEmpty():
        raise ValueError(f"no rows in {path}")
    t = raw.select([F.col(f"`{c}`").try_cast("double").alias(c.strip()) for c in raw.columns])
    from pyspark.sql import Window

    # A table of epochs is small: its rows are counted in one task.
    n = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("double")
    return t.withColumn("epoch", F.coalesce("epoch", n) if "epoch" in t.columns else n)


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """Members of the archives below path: archive, member and content."""

    def unpack(batches: Iterator) -> Iterator:
        import io
        import zipfile

        import pandas as pd

        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in sorted(z.namelist()):
                        if not m.endswith("/"):
                            yield pd.DataFrame({"archive": [name], "member": [m.replace("\\", "/").lstrip("/")], "content": [z.read(m)]})

    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return f.mapInPandas(unpack, "archive string, member string, content binary")


def resolve_members(requests: DataFrame, members: DataFrame) -> DataFrame:
    """requests (id, base_dir, file_name) with the member each means: four paths in order, else a base name that is unique, over all or below base_dir.

    Members are counted by base name and each folder above them before they meet the requests, so a name that is everywhere is one row.
    """
    name = S.clean_path(F.col("file_name"))
    under = lambda tail: F.when(F.col("base_dir") != "", F.concat("base_dir", F.lit("/"), tail)).otherwise(tail)
    tried = F.array(under(name), under(F.concat(F.lit("images/"), S.basename(name))), name, S.basename(name))
    m = members.select(F.col("member").alias("found"))
    direct = requests.select("id", F.posexplode(tried).alias("p", "candidate")).join(m, F.col("candidate") == F.col("found")).groupBy("id").agg(F.min_by("found", "p").alias("direct"))
    parts = F.split("found", "/")
    folders = F.concat(F.array(F.lit("")), F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).otherwise(F.array().cast("array<string>")))
    counted = m.select("found", S.basename(F.col("found")).alias("name"), F.explode(folders).alias("folder")).groupBy("name", "folder").agg(F.count(F.lit(1)).alias("n"), F.min("found").alias("only"))
    r = requests.select("id", "base_dir", S.basename(name).alias("wanted"))
    over = counted.filter("folder = ''").select(F.col("name").alias("wanted"), F.col("n").alias("all"), F.col("only").alias("one"))
    below = counted.select(F.col("name").alias("wanted"), F.col("folder").alias("base_dir"), "n", "only")
    j = requests.select("id").join(direct, "id", "left").join(r, "id").join(over, "wanted", "left").join(below, ["wanted", "base_dir"], "left")
    return j.select("id", F.coalesce("direct", F.when(F.col("all") == 1, F.col("one")), F.when(F.col("n") == 1, F.col("only"))).alias("member"))


def group_inputs(children: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """grp and input of every group: an explicit path, else the only child (name) that starts with the group's code or is one of its aliases.

    The result fails where a group has no input or several; evaluation is lazy, as for any frame.
    """
    from corvane.functions.config import groups

    g = groups(children.sparkSession).select("grp", "aliases")
    fits = F.startswith(F.col("name"), F.col("grp")) | F.array_contains("aliases", F.col("name"))
    found = F.broadcast(g).join(children, fits, "left").groupBy("grp").agg(F.count("name").alias("n"), F.min("name").alias("only"))
    if explicit is None:
        explicit = children.sparkSession.createDataFrame([], "grp string, input string")
    j = found.join(explicit, "grp", "left")
    wrong = F.raise_error(F.concat(F.lit("group "), F.col("grp"), F.lit(": inputs found: "), F.col("n").cast("string")))
    return j.select("grp", F.coalesce("input", F.when(F.col("n") == 1, F.col("only")), F.when(F.col("n") != 1, wrong.cast("string"))).alias("input"))


def records(images: DataFrame, lines: DataFrame, limit: int | None = None) -> DataFrame:
    """images() with their group and label lines in order, matched inside a split by folder name (images/train with labels/train); images without a label file have none."""
    per = lines.groupBy("dir", "stem").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_number", "line"))), lambda x: x["line"]).alias("lines"))
    r = images.join(per, ["dir", "stem"], "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<string>"))).withColumn("grp", S.group_from_name(F.col("file_name")))
    return r.orderBy("file_name").limit(limit) if limit else r


def subset(images: DataFrame, lines: DataFrame, grp: str) -> DataFrame:
    """Records of one group, by its file name prefix; empty where it has none."""
    return records(images.filter(F.startswith(F.col("file_name"), F.lit(f"g{grp}_"))), lines)
