"""Dense ids, unique names, and the union of two annotated parts under new ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.tables import materialise


def dense_ids(df: DataFrame, name: str, bucket: list[Column], order: list[Column], start: int = 1) -> DataFrame:
    """df with consecutive ids in the order (bucket, order).

    bucket cuts the order into stretches: rows are numbered inside each, and one row per stretch carries the running total. No
    task sorts more than one stretch, unlike a window without partitions.
    """
    names = [f"__b{i}" for i in range(len(bucket))]
    b = df.withColumns(dict(zip(names, bucket)))
    totals = b.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = b.withColumn("__r", F.row_number().over(Window.partitionBy(*names).orderBy(*order)))
    return inside.join(offsets, names).withColumn(name, (F.col("__offset") + F.col("__r") - 1 + start).cast("long")).drop("__offset", "__r", *names)


def _split_name(name: Column) -> tuple[Column, Column]:
    return F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 2)


def unique_names(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """In order, each row keeps its name if nobody before has it, else gets the first of _1, _2, ... before the extension that nobody before has.

    Names that could meet through such suffixes (`a`, `a_1`, `a_1_2` where all of them are names) are one family, found by rounds of joins over the distinct names.
    Rows of a family of several names are named one after the other; all other names only count their holders.
    """
    stem, ext = _split_name(F.col(name))
    names = df.select(F.col(name).alias("__name")).distinct()
    head = F.regexp_extract(_split_name(F.col("__name"))[0], r"^(.+)_[1-9]\d*$", 1)
    up = names.withColumn("__up", F.when(head != "", F.concat(head, _split_name(F.col("__name"))[1])))
    up = up.join(names.select(F.col("__name").alias("__known")), F.col("__up") == F.col("__known"), "left").select("__name", F.coalesce("__known", "__name").alias("__root"))
    up = materialise(up, "name-families", keep=True)
    while True:
        above = up.select(F.col("__name").alias("__at"), F.col("__root").alias("__next"))
        further = materialise(up.join(above, F.col("__root") == F.col("__at")).select("__name", F.col("__root").alias("__was"), F.col("__next").alias("__root")), "name-families", keep=True)
        up = further.select("__name", "__root")
        if further.filter("__was <> __root").isEmpty():
            break
    families = up.groupBy("__root").agg(F.count(F.lit(1)).alias("__names")).filter("__names > 1")
    met = materialise(up.join(families.select("__root"), "__root"), "met-names", keep=True)
    marked = df.join(met.select(F.col("__name").alias("__of"), "__root"), F.col(name) == F.col("__of"), "left").drop("__of")
    n = F.row_number().over(Window.partitionBy("__root", name).orderBy(*order)) - 1
    suffixed = F.when(n == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), n.cast("string"), ext))
    plain = marked.filter("__root is null").withColumn("__new", suffixed)
    if met.isEmpty():
        return plain.withColumn(name, F.col("__new")).drop("__root", "__new")
    ranked = marked.filter("__root is not null").withColumn("__r", F.row_number().over(Window.partitionBy("__root").orderBy(*order)))
    schema = T.StructType([*ranked.schema.fields, T.StructField("__new", T.StringType())])

    def one_by_one(pdf):
        taken, out = set(), []
        pdf = pdf.sort_values("__r")
        for x in pdf[name]:
            at = x.rfind(".")
            base, tail = (x[:at], x[at:]) if at > 0 else (x, "")
            k, new = 0, x
            while new in taken:
                k += 1
                new = f"{base}_{k}{tail}"
            taken.add(new)
            out.append(new)
        pdf["__new"] = out
        return pdf

    named = ranked.groupBy("__root").applyInPandas(one_by_one, schema).drop("__r")
    return plain.unionByName(named).withColumn(name, F.col("__new")).drop("__root", "__new")


def merge_parts(images: DataFrame, annotations: DataFrame, stretch: int = 4096, image_stretch: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """images (part, image_id, file_name, ...) and annotations (part, image_id, ann_pos, ...) of all parts, under new ids.

    Annotations of images that no part has are dropped. One task numbers `stretch` ids, and one sums all stretches: where image ids lie far apart, image_stretch says
    which stretch of its part an image is in. Images are written before and after they are named and numbered, as names, totals and annotations read them again.
    """
    order = [F.col("part"), F.col("image_id")]
    named = unique_names(materialise(images, "parts", keep=True), "file_name", order)
    at = F.floor(F.col("image_id") / stretch) if image_stretch is None else image_stretch
    new = materialise(dense_ids(named, "new_id", [F.col("part"), at], [F.col("image_id")]), "merged", keep=True)
    ids = new.select("part", "image_id", "new_id")
    kept = annotations.join(ids, ["part", "image_id"])
    numbered = dense_ids(kept, "new_ann_id", [F.floor(F.col("new_id") / stretch)], [F.col("new_id"), F.col("ann_pos")])
    return new, numbered
