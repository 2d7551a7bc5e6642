"""Stratified splits and their constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.config import SPLITS, ratio_column
from corvane.functions.scalar import round_half_even

SEED = 42


def split_counts(n: Column, valid_ratio: Column, test_ratio: Column) -> tuple[Column, Column, Column]:
    """(train, valid, test) of n sources; one source trains, two also validate; from three on every split has one."""
    v = F.greatest(F.lit(1), round_half_even(n * valid_ratio))
    t = F.greatest(F.lit(1), round_half_even(n * test_ratio))
    none_left = n - v - t < 1
    # Training keeps one source in any case; one is taken off validation, or off test where that is larger.
    from_valid = none_left & (v >= t) & (v > 1)
    from_test = none_left & ~from_valid & (t > 1)
    v3, t3 = v - from_valid.cast("int"), t - from_test.cast("int")
    small = lambda a, b, c: F.when(n <= 0, F.lit(0)).when(n == 1, F.lit(a)).when(n == 2, F.lit(b)).otherwise(c).cast("long")
    return small(1, 1, F.greatest(F.lit(1), n - v - t)), small(0, 1, v3), small(0, 0, t3)


def shuffled(seed: int, key: Column) -> Column:
    """A fixed pseudo-random order."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key).cast("binary"))


def assign(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """sources with split: positions in each group's shuffled order against the group's split sizes.

    Positions are dense per group, summed in two levels: the first byte of the shuffled order cuts a group into 256 stretches.
    """
    s = sources.withColumn("__h", shuffled(seed, F.col("source_key"))).withColumn("__b", F.substring("__h", 1, 2))
    cells = s.groupBy("grp", "__b").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy("grp").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("grp", "__b", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__offset"), F.sum("__c").over(Window.partitionBy("grp")).alias("__n"))
    inside = s.withColumn("__r", F.row_number().over(Window.partitionBy("grp", "__b").orderBy("__h", "doc_id")))
    j = inside.join(cells, ["grp", "__b"]).withColumn("__at", F.col("__offset") + F.col("__r"))
    train, valid, _ = split_counts(F.col("__n"), ratio_column(F.col("grp"), 1), ratio_column(F.col("grp"), 2))
    split = F.when(F.col("__at") <= train, "train").when(F.col("__at") <= train + valid, "valid").otherwise("test")
    return j.withColumn("split", split).drop("__h", "__b", "__r", "__offset", "__n", "__at")


def leaks(assigned: DataFrame) -> DataFrame:
    """Contents that are in more than one split."""
    return assigned.groupBy("content_hash").agg(F.count_distinct("split").alias("n_splits"), F.count(F.lit(1)).alias("n_sources"), F.min("doc_id").alias("first_doc")).filter("n_splits > 1")


def grid(spark, groups=("01", "02", "03", "04", "05")) -> DataFrame:
    return spark.createDataFrame([(s, g) for s in SPLITS for g in groups], "split string, grp string")


def missing(assigned: DataFrame) -> DataFrame:
    """All cells of the grid with their counts and whether they are empty."""
    counts = assigned.groupBy("split", "grp").agg(F.count(F.lit(1)).alias("n"))
    full = grid(assigned.sparkSession).join(counts, ["split", "grp"], "left")
    return full.select("split", "grp", F.coalesce("n", F.lit(0)).cast("long").alias("n_sources"), F.when(F.col("n").isNull(), 1).otherwise(0).alias("is_missing"))


def empty_cells(assigned: DataFrame) -> DataFrame:
    return grid(assigned.sparkSession).join(assigned.select("split", "grp").distinct(), ["split", "grp"], "left_anti")


def summary(assigned: DataFrame) -> DataFrame:
    per = assigned.groupBy("split", "grp").agg(F.count(F.lit(1)).alias("a"), F.sum("n_ann").alias("b"))
    full = grid(assigned.sparkSession).join(per, ["split", "grp"], "left").select("split", "grp", F.coalesce("a", F.lit(0)).cast("long").alias("source_images"), F.coalesce("b", F.lit(0)).cast("long").alias("annotations"))
    over = Window.partitionBy("split")
    return full.select("*", F.sum("source_images").over(over).alias("total_images_in_split"), F.sum("annotations").over(over).alias("total_annotations_in_split"))


def audit(assigned: DataFrame) -> DataFrame:
    """Dense grid of images, objects, backgrounds and their ratios."""
    per = assigned.groupBy("split", "grp").agg(F.count(F.lit(1)).alias("i"), F.sum("n_ann").alias("o"), F.count_if(F.col("n_ann") == 0).alias("b"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    ratio = lambda a, b: F.coalesce(F.round(F.try_divide(a.cast("double"), b.cast("double")), 4), F.lit(0.0))
    full = grid(assigned.sparkSession).join(per, ["split", "grp"], "left").select("split", "grp", zero("i").alias("images"), zero("o").alias("objects"), zero("b").alias("background_images"))
    return full.select("*", ratio(F.col("background_images"), F.col("images")).alias("background_ratio"), ratio(F.col("objects"), F.col("images")).alias("objects_per_image"))


def sample(assigned: DataFrame, per_group: int = 6, seed: int = SEED) -> DataFrame:
    """Of each group's training sources: up to per_group - 2 (1 at least) with objects, then backgrounds up to per_group."""
    want = max(1, per_group - 2)
    t = assigned.filter("split = 'train'").withColumn("is_background", F.when(F.col("n_ann") == 0, 1).otherwise(0)).withColumn("h", shuffled(seed, F.col("source_key")))
    ranked = t.withColumn("r", F.row_number().over(Window.partitionBy("grp", "is_background").orderBy("h", "doc_id"))).filter(F.col("r") <= per_group)
    picked = ranked.filter((F.col("is_background") == 1) | (F.col("r") <= want))
    final = picked.withColumn("position", F.row_number().over(Window.partitionBy("grp").orderBy("is_background", "r")))
    return final.filter(F.col("position") <= per_group).select("grp", "position", "doc_id", "source_key", "is_background")
