"""One tokenizer and three label policies, which differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.geometry import evens, largest_polygon, odds
from corvane.functions.scalar import clamp01, fixed, normalise, numbers, tokens

ERRORS = ("too_few_values", "non_numeric", "invalid_polygon", "invalid_bbox")


def parsed(lines: DataFrame) -> DataFrame:
    """lines (line, ...) with tokens, coords (all after the first as doubles) and whether all of them are numbers."""
    t = lines.withColumn("tokens", tokens(F.col("line")))
    t = t.withColumn("coords", numbers(F.slice("tokens", 2, F.greatest(F.size("tokens"), F.lit(1)))))
    return t.withColumn("numeric", ~F.exists("coords", lambda c: c.isNull()))


def _corners(coords: Column) -> tuple[Column, Column, Column, Column]:
    return F.array_min(evens(coords)), F.array_min(odds(coords)), F.array_max(evens(coords)), F.array_max(odds(coords))


def convert(lines: DataFrame) -> DataFrame:
    """Detection boxes (xc, yc, w, h), coordinates clamped before anything is measured; error tells why a line is rejected; blank lines give neither."""
    p = parsed(lines)
    n, c = F.size("coords"), F.transform("coords", clamp01)
    x0, y0, x1, y1 = _corners(c)
    is_box = n == 4
    w = F.when(is_box, F.get(c, F.lit(2))).otherwise(x1 - x0)
    h = F.when(is_box, F.get(c, F.lit(3))).otherwise(y1 - y0)
    blank = F.size("tokens") == 0
    error = (
        F.when(blank, None).when(F.size("tokens") < 5, "too_few_values").when(~F.col("numeric"), "non_numeric")
        .when(~is_box & ((n < 6) | (n % 2 != 0)), "invalid_polygon").when((w <= 0) | (h <= 0), "invalid_bbox")
    )
    out = p.withColumn("error", error).withColumn("blank", blank)
    fine = ~F.col("blank") & F.col("error").isNull()
    return out.select(*lines.columns, "blank", "error", F.when(fine, F.when(is_box, F.get(c, F.lit(0))).otherwise(x0 + w / 2)).alias("xc"), F.when(fine, F.when(is_box, F.get(c, F.lit(1))).otherwise(y0 + h / 2)).alias("yc"), F.when(fine, w).alias("w"), F.when(fine, h).alias("h"))


def audit(lines: DataFrame) -> DataFrame:
    """Accepted objects only: corners from unclamped values, sizes measured before and reported after clamping."""
    p = parsed(lines).withColumn("class_value", F.get("tokens", F.lit(0)).try_cast("double"))
    n = F.size("coords")
    g = lambda i: F.get("coords", F.lit(i))
    p0, q0, p1, q1 = _corners(F.col("coords"))
    box = n == 4
    x0, x1 = F.when(box, g(0) - g(2) / 2).otherwise(p0), F.when(box, g(0) + g(2) / 2).otherwise(p1)
    y0, y1 = F.when(box, g(1) - g(3) / 2).otherwise(q0), F.when(box, g(1) + g(3) / 2).otherwise(q1)
    ok = p.filter((F.size("tokens") >= 5) & F.col("numeric") & F.col("class_value").isNotNull() & (box | ((n >= 6) & (n % 2 == 0))))
    # A box of negative size has its corners swapped, as the least and greatest of both are taken.
    sized = ok.select(*lines.columns, F.col("class_value").cast("int").alias("class_id"), F.least(x0, x1).alias("a"), F.least(y0, y1).alias("b"), F.greatest(x0, x1).alias("c"), F.greatest(y0, y1).alias("d"), box.alias("is_box"))
    sized = sized.withColumn("uw", F.col("c") - F.col("a")).withColumn("uh", F.col("d") - F.col("b")).filter("uw > 0 and uh > 0")
    k = lambda c: clamp01(F.col(c))
    return sized.select(*lines.columns, "class_id", k("a").alias("x_min"), k("b").alias("y_min"), k("c").alias("x_max"), k("d").alias("y_max"), k("uw").alias("width"), k("uh").alias("height"), (k("uw") * k("uh")).alias("area"), (F.col("uw") / F.col("uh")).alias("aspect_ratio"), "is_box")


def evaluation(lines: DataFrame, width: Column, height: Column) -> DataFrame:
    """Ground-truth corners in pixels, clamped to the image; exactly five tokens; degenerate boxes stay."""
    p = parsed(lines).filter((F.size("tokens") == 5) & F.col("numeric"))
    g = lambda i: F.get("coords", F.lit(i))
    within = lambda v, top: F.greatest(F.lit(0.0), F.least(top.cast("double"), v))
    return p.select(*lines.columns, within((g(0) - g(2) / 2) * width, width).alias("x1"), within((g(1) - g(3) / 2) * height, height).alias("y1"), within((g(0) + g(2) / 2) * width, width).alias("x2"), within((g(1) + g(3) / 2) * height, height).alias("y2"))


def violation(line: Column) -> Column:
    """The first rule of well-formed detection lines that a line breaks, or null."""
    t = tokens(line)
    c = numbers(F.slice(t, 2, F.greatest(F.size(t), F.lit(1))))
    return (
        F.when(F.size(t) == 0, None).when(F.size(t) != 5, "token_count").when(F.get(t, F.lit(0)) != "0", "class").when(F.exists(c, lambda v: v.isNull()), "number")
        .when(F.exists(c, lambda v: (v < 0) | (v > 1)), "range").when((F.get(c, F.lit(2)) <= 0) | (F.get(c, F.lit(3)) <= 0), "size")
    )


def conversion_summary(lines: DataFrame) -> DataFrame:
    """lines (image_id, split, ...): per split and over all: images, objects, images without objects, rejects by reason."""
    c = convert(lines)
    per_image = c.groupBy("image_id", "split").agg(F.count_if(~F.col("blank") & F.col("error").isNull()).alias("objects"), *[F.count_if(F.col("error") == e).alias(e) for e in ERRORS])
    out = per_image.rollup("split").agg(F.count(F.lit(1)).alias("images"), F.sum("objects").alias("objects"), F.count_if(F.col("objects") == 0).alias("background_images"), *[F.sum(e).alias(f"skipped_{e}") for e in ERRORS])
    return out.withColumn("split", F.coalesce("split", F.lit("overall")))


def image_rows(lines: DataFrame) -> DataFrame:
    """lines (image_id, split, ...): one row per image with its accepted objects."""
    per = audit(lines).groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    images = lines.select("image_id", "split").distinct().join(per, "image_id", "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return images.select("image_id", "split", n.alias("objects"), F.when(n == 0, 1).otherwise(0).alias("is_background"))


def object_rows(lines: DataFrame) -> DataFrame:
    numbered = lines.withColumn("line_number", F.row_number().over(Window.partitionBy("image_id").orderBy("event_id")))
    return audit(numbered)


def detection_line(xc: Column, yc: Column, w: Column, h: Column) -> Column:
    return F.concat_ws(" ", F.lit("0"), *[fixed(v) for v in (xc, yc, w, h)])


def segmentation_line(class_id: Column, polygons: Column, width: Column, height: Column) -> Column:
    """Class and normalised corners of the largest polygon; null where there is no polygon at all, the class alone where the largest is empty."""
    flat = largest_polygon(polygons)["polygon"]
    coords = F.transform(flat, lambda v, i: fixed(F.when(i % 2 == 0, normalise(v, width)).otherwise(normalise(v, height))))
    return F.when(F.size(polygons) > 0, F.concat(class_id.cast("string"), F.lit(" "), F.array_join(coords, " ")))


def segmentation_lines(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """images (image_id, width, height) and annotations (image_id, ann_id, class_id, polygons) -> (image_id, line_number, line); line is null where nothing can be written."""
    j = annotations.join(images.select("image_id", "width", "height"), "image_id")
    line = segmentation_line(F.col("class_id"), F.col("polygons"), F.col("width"), F.col("height"))
    return j.select("image_id", F.row_number().over(Window.partitionBy("image_id").orderBy("ann_id")).alias("line_number"), line.alias("line"))


def skipped(lines: DataFrame) -> DataFrame:
    """One row: annotations written, and skipped for want of a polygon or a box."""
    return lines.agg(F.count("line").alias("written"), F.count_if(F.col("line").isNull()).alias("rle_or_missing_segmentation"))
