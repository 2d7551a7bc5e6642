"""Totals, counts by prefix and the written summary of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scalar import percent


def totals(images: DataFrame) -> DataFrame:
    """images (split, grp, objects): images, objects, backgrounds and their share per (split, group), per split and over all ('all')."""
    r = images.rollup("split", "grp").agg(F.count(F.lit(1)).alias("images"), F.sum("objects").alias("objects"), F.count_if(F.col("objects") == 0).alias("background_images"))
    share = F.try_divide(F.col("background_images").cast("double"), F.col("images").cast("double"))
    return r.select(F.coalesce("split", F.lit("all")).alias("split"), F.coalesce("grp", F.lit("all")).alias("grp"), "images", "objects", "background_images", F.coalesce(percent(share), F.lit("0%")).alias("background_share"))


def by_prefix(images: DataFrame, annotations: DataFrame, groups: list[str]) -> DataFrame:
    """Images whose name has a group's prefix and the annotations of these images, for every group named."""
    g = images.sparkSession.createDataFrame([(x,) for x in groups], "grp string")
    named = images.select("image_id", F.regexp_extract("file_name", r"^g(\d{2})_", 1).alias("grp")).filter("grp <> ''")
    n_images = named.groupBy("grp").agg(F.count(F.lit(1)).alias("i"))
    n_annotations = annotations.join(named, "image_id").groupBy("grp").agg(F.count(F.lit(1)).alias("a"))
    j = g.join(n_images, "grp", "left").join(n_annotations, "grp", "left")
    return j.select("grp", F.coalesce("i", F.lit(0)).cast("long").alias("images"), F.coalesce("a", F.lit(0)).cast("long").alias("annotations"))


def group_subsets(images: DataFrame) -> DataFrame:
    """Images per group by prefix; groups without one are skipped."""
    code = F.regexp_extract("file_name", r"^g(\d{2})_", 1)
    return images.withColumn("grp", code).filter("grp <> ''").groupBy("grp").agg(F.count(F.lit(1)).alias("images"))


def sized(images: DataFrame) -> DataFrame:
    """Images of a known size."""
    return images.filter("width > 0 and height > 0")


def pooled(parts: dict[str, DataFrame]) -> DataFrame:
    """Exports of several splits as one table, with the split each row came from."""
    frames = [df.withColumn("export", F.lit(name)) for name, df in parts.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def markdown(total: DataFrame, classes: DataFrame, cells: DataFrame, dataset: Column) -> DataFrame:
    """The summary's lines as (section, n, line). total: one row of totals(); classes (class_id, class_name, n_objects); cells (split, grp, images, objects, background_images)."""
    heads = {0: ("# Data audit", ""), 3: ("", "## Class counts", ""), 5: ("", "## Split and group counts", "")}
    fixed = total.sparkSession.createDataFrame([(s, i, x) for s, lines in heads.items() for i, x in enumerate(lines)], "section int, n long, line string")
    tick = lambda name, c: F.concat(F.lit(f"- {name}: `"), c.cast("string"), F.lit("`"))
    facts = [F.concat(F.lit("Dataset: `"), dataset, F.lit("`")), F.lit(""), F.lit("## Overview"), F.lit(""), tick("Images", F.col("images")), tick("Objects", F.col("objects")), tick("Background images", F.col("background_images")), tick("Background ratio", F.col("background_share"))]
    overview = total.select(F.posexplode(F.array(*facts)).alias("n", "line")).select(F.lit(1).alias("section"), F.col("n").cast("long").alias("n"), "line")
    counts = classes.select(F.lit(4).alias("section"), F.col("class_id").cast("long").alias("n"), F.concat(F.lit("- `"), "class_name", F.lit("`: `"), F.col("n_objects").cast("string"), F.lit("`")).alias("line"))
    order = F.element_at(F.create_map(*[F.lit(x) for pair in (("train", 0), ("valid", 1), ("test", 2)) for x in pair]), F.col("split")) * 100 + F.col("grp").cast("int")
    text = F.concat(F.lit("- `"), "split", F.lit(" g"), "grp", F.lit("`: "), F.col("images").cast("string"), F.lit(" images, "), F.col("objects").cast("string"), F.lit(" objects, "), F.col("background_images").cast("string"), F.lit(" background"))
    return fixed.unionByName(overview).unionByName(counts).unionByName(cells.select(F.lit(6).alias("section"), order.cast("long").alias("n"), text.alias("line")))


def data_yaml(classes: DataFrame) -> DataFrame:
    """The dataset's description as (n, line): paths, then the class names in order of their ids, as JSON strings."""
    head = classes.sparkSession.createDataFrame([(i, x) for i, x in enumerate(("path: .", "train: images/train", "val: images/valid", "test: images/test", "names:"))], "n long, line string")
    name = F.to_json(F.array("class_name"))
    return head.unionByName(classes.select((F.col("class_id") + 5).cast("long").alias("n"), F.concat(F.lit("  "), F.col("class_id").cast("string"), F.lit(": "), F.substring(name, F.lit(2), F.length(name) - 2)).alias("line")))
