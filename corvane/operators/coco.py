"""Image, annotation and category tables: lookups, class ids in order of first appearance, remapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.scalar import stable_stem

from .merge import dense_ids


def attach(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """Per image its annotations' count, known categories and total area; images without annotations stay. categories is a fixed-size table."""
    named = annotations.join(F.broadcast(categories), "category", "left")
    per = named.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("class_name").alias("k"), F.count_if(F.col("class_name").isNull()).alias("unknown"), F.sum("area").alias("a"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return images.join(per, "image_id", "left").select("image_id", "grp", zero("n").cast("long").alias("n_annotations"), zero("k").cast("long").alias("n_categories"), zero("unknown").cast("long").alias("n_unknown"), F.coalesce("a", F.lit(0.0)).alias("total_area"), F.when(F.coalesce("n", F.lit(0)) == 0, 1).otherwise(0).alias("is_background"))


def first_seen_classes(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Categories with ids 0, 1, ... in the order (group, image, position) in which they first occur."""
    seen = annotations.join(images.select("image_id", "grp"), "image_id").groupBy("category").agg(F.min(F.struct("grp", "image_id", "ann_pos")).alias("first"), F.count(F.lit(1)).alias("n_annotations"))
    # One row per category: the window orders a table as small as the list of classes.
    return seen.select("category", (F.row_number().over(Window.orderBy("first")) - 1).alias("class_id"), F.col("first.grp").alias("first_grp"), F.col("first.image_id").alias("first_image"), "n_annotations")


def remap(annotations: DataFrame, classes: DataFrame) -> DataFrame:
    """Annotations with class ids; those of unknown categories are dropped."""
    return annotations.join(classes.select("category", "class_id"), "category").drop("category")


def split_build(sources: DataFrame, annotations: DataFrame, classes: DataFrame, groups: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of every split under ids 1, 2, ... of the split.

    sources (image_id, split, grp, source_index, width, height, source_key, original_file_name, suffix) in the order (grp, source_index), of some groups only if named;
    annotations (image_id, ann_pos, category, ...) follow their images, those of unknown categories are dropped.
    """
    s = sources if groups is None else sources.filter(F.col("grp").isin(*groups))
    bucket = lambda c: F.floor(F.col(c) / 4096)
    images = per_split(s, "id", [F.col("grp"), bucket("source_index")], [F.col("source_index")])
    known = F.lower("suffix").isin(".jpg", ".jpeg", ".png", ".bmp", ".webp")
    name = F.concat(stable_stem(F.col("grp"), F.col("source_index")), F.when(known, F.lower("suffix")).otherwise(".jpg"))
    images = images.withColumn("file_name", name)
    a = remap(annotations, classes).join(images.select("image_id", "split", F.col("id").alias("new_image")), "image_id")
    return images, per_split(a, "id", [bucket("new_image")], [F.col("new_image"), F.col("ann_pos")])


def per_split(df: DataFrame, name: str, bucket: list, order: list) -> DataFrame:
    """Ids from 1 in each split, in the order (bucket, order)."""
    numbered = dense_ids(df, "__id", [F.col("split"), *bucket], order)
    first = numbered.groupBy(F.col("split").alias("__s")).agg(F.min("__id").alias("__first"))
    return numbered.join(first, F.col("split") == F.col("__s")).withColumn(name, F.col("__id") - F.col("__first") + 1).drop("__id", "__s", "__first")


def document_lines(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """(section, n, line): the lines of one document, in order, whose parts are written by as many tasks as there are; nothing is gathered.

    images and annotations have an id (1, 2, ...), categories too; all other columns go into the objects as they are.
    """

    def objects(df: DataFrame, section: int, first: int) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.col("id").cast("long").alias("n"), F.concat(F.when(F.col("id") > first, F.lit(",")).otherwise(F.lit("")), F.to_json(F.struct(*df.columns))).alias("line"))

    between = ['{"images":[', '],"annotations":[', '],"categories":[', "]}"]
    heads = images.sparkSession.createDataFrame([(2 * i, 0, x) for i, x in enumerate(between)], "section int, n long, line string")
    return heads.unionByName(objects(images, 1, 1)).unionByName(objects(annotations, 3, 1)).unionByName(objects(categories, 5, 0))


def documents(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """One JSON object per image with its annotations in order, for a sink of lines."""
    anns = annotations.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("ann_pos", "category", "area"))).alias("annotations"))
    return images.join(anns, "image_id", "left").select("image_id", F.to_json(F.struct("image_id", "file_name", F.coalesce("annotations", F.array().cast("array<struct<ann_pos:int,category:string,area:double>>")).alias("annotations"))).alias("value"))
