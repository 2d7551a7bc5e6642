"""Tiles over image extents, what lies in them, and which empty ones stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import geometry as G
from corvane.functions.config import groups


def windows(images: DataFrame) -> DataFrame:
    """images (image_id, grp, width, height) of tiled groups, one row per tile. The config table has a fixed size."""
    cfg = groups(images.sparkSession).filter("slice is not null").select("grp", "slice.*")
    j = images.join(F.broadcast(cfg), "grp").withColumn("tiles", G.tile_windows(F.col("width"), F.col("height"), F.col("size"), F.col("overlap")))
    return j.select("image_id", "grp", "ignore_negative", "max_empty", "min_area_ratio", F.posexplode("tiles").alias("window_idx", "t")).select("image_id", "grp", "window_idx", "t.*", "ignore_negative", "max_empty", "min_area_ratio")


def overlaps(tiles: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pairs of a tile and a box of the same image that share an area, with the area and the part of the box inside."""
    b = boxes.select("image_id", "event_id", F.col("x1").alias("bx1"), F.col("y1").alias("by1"), F.col("x2").alias("bx2"), F.col("y2").alias("by2"))
    j = tiles.join(b, "image_id").filter("bx1 < x1 and bx2 > x0 and by1 < y1 and by2 > y0")
    inter = G.intersection((F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")), (F.col("bx1"), F.col("by1"), F.col("bx2"), F.col("by2")))
    area = (F.col("bx2") - F.col("bx1")) * (F.col("by2") - F.col("by1"))
    out = j.withColumn("area_inside", inter.cast("long")).withColumn("ratio", inter.cast("double") / area.cast("double"))
    return out.filter("ratio >= min_area_ratio").select("image_id", "grp", "window_idx", "event_id", "area_inside", "ratio")


def counted(tiles: DataFrame, boxes: DataFrame) -> DataFrame:
    per = overlaps(tiles, boxes).groupBy("image_id", "window_idx").agg(F.count(F.lit(1)).alias("n"))
    return tiles.join(per, ["image_id", "window_idx"], "left").withColumn("n_ann", F.coalesce("n", F.lit(0)).cast("long")).drop("n")


def cap_empty(tiles: DataFrame, source: Column | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """Tiles (n_ann, ...): those with annotations and, per source, the first max_empty empty ones by file name (all, where it is null).

    A source is what `source` says, else the start of the file name as far as the sixth digit of the image's id, as the pipeline has it: longer ids share sources then. `more` columns of the tiles stay.
    """
    t = tiles.withColumn("file_name", F.format_string("g%s_%06d_slice_%04d.jpg", "grp", "image_id", "window_idx")).filter(~(F.col("ignore_negative") & (F.col("n_ann") == 0)))
    stem = F.coalesce(F.nullif(F.regexp_extract("file_name", r"^(g\d{2}_\d{6})", 1), F.lit("")), F.lit("unknown")) if source is None else source
    empty = F.col("n_ann") == 0
    t = t.withColumn("stem", stem).withColumn("r", F.when(empty, F.row_number().over(Window.partitionBy("stem", empty).orderBy("file_name"))))
    return t.filter(~empty | F.col("max_empty").isNull() | (F.col("r") <= F.col("max_empty"))).select("image_id", "window_idx", "file_name", "n_ann", *more)


def clip_annotations(tiles: DataFrame, annotations: DataFrame) -> DataFrame:
    """annotations (image_id, ann_id, polygons) in each tile of their image (image_id, window_idx, x0, y0, x1, y1, min_area_ratio), in tile coordinates.

    Each polygon is clipped; parts of three corners or more and an area above 1 stay. An annotation stays where its parts make up at least min_area_ratio of its
    whole area and their box is larger than 1 x 1.
    """
    every = F.flatten("polygons")
    a = annotations.withColumns({"__l": F.array_min(G.evens(every)), "__r": F.array_max(G.evens(every)), "__t": F.array_min(G.odds(every)), "__b": F.array_max(G.odds(every))})
    j = tiles.join(a, "image_id").filter("__l < x1 and __r > x0 and __t < y1 and __b > y0")
    bounds = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    cut = F.transform("polygons", lambda p: G.let(G.clip_polygon(G.points(p), *bounds), lambda q: F.struct(q.alias("q"), G.points_area(q).alias("area"))))
    j = j.withColumn("__parts", F.filter(cut, lambda x: (F.size(x["q"]) >= 3) & (x["area"] > 1)))
    total = lambda c, of: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + of(x))
    j = j.withColumn("__whole", total(F.col("polygons"), G.polygon_area)).withColumn("area", total(F.col("__parts"), lambda x: x["area"]))
    j = j.filter((F.size("__parts") > 0) & (F.col("__whole") > 0) & (F.col("area") / F.col("__whole") >= F.col("min_area_ratio")))
    moved = F.transform("__parts", lambda x: F.flatten(F.transform(x["q"], lambda q: F.array(q["x"] - F.col("x0"), q["y"] - F.col("y0")))))
    j = j.withColumn("polygons", moved).withColumn("bbox", G.polygon_bbox(F.flatten("polygons"), F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))).filter("bbox.w > 1 and bbox.h > 1")
    return j.drop("__l", "__r", "__t", "__b", "__parts", "__whole")


def slices(images: DataFrame, annotations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tiles of images (image_id, grp, width, height, ...) with their names and numbers of annotations, capped empty ones gone, and the clipped annotations of those that stay."""
    tiles = windows(images)
    clipped = clip_annotations(tiles, annotations)
    kept = kept_tiles(tiles, clipped)
    return kept, annotations_of(clipped, kept)


def kept_tiles(tiles: DataFrame, clipped: DataFrame) -> DataFrame:
    """Tiles with their names and numbers of annotations in clipped (image_id, window_idx, ...), capped empty ones gone."""
    per = clipped.groupBy("image_id", "window_idx").agg(F.count(F.lit(1)).alias("__n"))
    full = tiles.join(per, ["image_id", "window_idx"], "left").withColumn("n_ann", F.coalesce("__n", F.lit(0)).cast("long")).drop("__n")
    return cap_empty(full, F.col("image_id"), ("grp", "x0", "y0", "x1", "y1"))


def annotations_of(clipped: DataFrame, kept: DataFrame) -> DataFrame:
    """The clipped annotations whose tile stays."""
    return clipped.join(kept.select("image_id", "window_idx"), ["image_id", "window_idx"], "left_semi")


def clip_polygons(polys: DataFrame, tiles: DataFrame, min_ratio: float = 0.1) -> DataFrame:
    """polys (vec_id, flat) against tiles (window_idx, x0, y0, x1, y1; a fixed-size table): clipped parts in tile coordinates.

    Kept where the part has three corners or more, an area above 1 and at least min_ratio of the whole, and a box above 1 x 1.
    """
    box = lambda f, g: f(g(F.col("flat")))
    bounded = polys.withColumns({"px0": box(F.array_min, G.evens), "px1": box(F.array_max, G.evens), "py0": box(F.array_min, G.odds), "py1": box(F.array_max, G.odds), "whole": G.polygon_area(F.col("flat"))})
    j = bounded.join(F.broadcast(tiles), (F.col("px0") < F.col("x1")) & (F.col("px1") > F.col("x0")) & (F.col("py0") < F.col("y1")) & (F.col("py1") > F.col("y0")))
    j = j.withColumn("p", G.points(F.col("flat")))
    j = j.withColumn("p", G.clip_polygon(F.col("p"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    j = j.withColumn("area", G.points_area(F.col("p"))).filter((F.size("p") >= 3) & (F.col("area") > 1) & (F.col("whole") > 0) & (F.col("area") / F.col("whole") >= min_ratio))
    span = lambda axis: F.array_max(F.transform("p", lambda q: q[axis])) - F.array_min(F.transform("p", lambda q: q[axis]))
    j = j.withColumn("w", span("x")).withColumn("h", span("y")).filter("w > 1 and h > 1")
    shifted = F.transform("p", lambda q: F.struct((q["x"] - F.col("x0")).alias("x"), (q["y"] - F.col("y0")).alias("y")))
    return j.select("vec_id", "window_idx", F.size("p").alias("n_points"), "area", "w", "h", shifted.alias("polygon"))
