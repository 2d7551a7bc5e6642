"""Detector evaluation: IoU join, suppression, matching, precision-recall curves, average precision.

A detection claims only the ground truth it overlaps most; the first claimant by score is a true positive, later ones and those below the
threshold are false positives. So IoU is computed once, the best ground truth is an aggregate, and the thresholds
are crossed with what is left. Box columns are x1, y1, x2, y2; ids are event_id; image_id joins both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import geometry as G

THRESHOLDS = 10
GRID = 101
#: Stretches of the score axis in which cumulative counts are taken separately: so many for each doubling of the score, so that scores crowded near 0 are spread as well.
STRETCHES = 4096
LEAST_SCORE = 2.0**-40
BOX = ("x1", "y1", "x2", "y2")


def threshold(i: Column) -> Column:
    return F.lit(0.5) + i.cast("double") * F.lit(0.05)


def _cols(prefix: str = "") -> tuple[Column, ...]:
    return tuple(F.col(prefix + c) for c in BOX)


def iou_pairs(dets: DataFrame, truth: DataFrame) -> DataFrame:
    """Detections and ground truths of one image that overlap."""
    g = truth.select("image_id", F.col("event_id").alias("gt_id"), *[F.col(c).alias("g" + c) for c in BOX])
    j = dets.join(g, "image_id").withColumn("iou", G.iou(_cols(), _cols("g"))).filter("iou > 0")
    return j.select("image_id", "event_id", "gt_id", "iou")


def matched(dets: DataFrame, truth: DataFrame) -> DataFrame:
    """Every detection with the ground truth it overlaps most (least id on ties) and that IoU, or null and 0."""
    best = iou_pairs(dets, truth).groupBy("event_id").agg(F.max(F.struct("iou", (-F.col("gt_id")).alias("back"))).alias("b"))
    j = dets.join(best, "event_id", "left")
    return j.select("event_id", "image_id", "grp", "score", (-F.col("b.back")).alias("gt_id"), F.coalesce("b.iou", F.lit(0.0)).alias("iou"))


def flags(match: DataFrame, thresholds: Column) -> DataFrame:
    """Each detection at each threshold index in the array, with tp (0 or 1)."""
    at = match.withColumn("thr", F.explode(thresholds))
    reaches = F.col("gt_id").isNotNull() & (F.col("iou") >= threshold(F.col("thr")))
    claim = Window.partitionBy("thr", "image_id", F.when(reaches, F.col("gt_id")), reaches).orderBy(F.col("score").desc(), "event_id")
    return at.withColumn("tp", F.when(reaches & (F.row_number().over(claim) == 1), 1).otherwise(0))


def in_subsets(df: DataFrame) -> DataFrame:
    """Each row for `overall` and for its group."""
    return df.withColumn("subset", F.explode(F.array(F.lit("overall"), F.concat(F.lit("g"), F.substring("grp", 2, 2)))))


def curve(flagged: DataFrame, keys: list[str]) -> DataFrame:
    """rank and cumulative tp of every detection within keys, by falling score.

    Counts are summed in two levels, so that no task sorts more than one stretch of the score axis of a key.
    """
    f = flagged.withColumn("stretch", F.floor(F.log2(F.greatest(F.col("score"), F.lit(LEAST_SCORE))) * STRETCHES).cast("int"))
    cells = f.groupBy(*keys, "stretch").agg(F.count(F.lit(1)).alias("n"), F.sum("tp").alias("t"))
    above = Window.partitionBy(*keys).orderBy(F.col("stretch").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*keys, "stretch", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("rank0"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tp0"))
    inside = Window.partitionBy(*keys, "stretch").orderBy(F.col("score").desc(), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    f = f.withColumn("r", F.count(F.lit(1)).over(inside)).withColumn("c", F.sum("tp").over(inside))
    return f.join(cells, [*keys, "stretch"]).withColumn("rank", F.col("rank0") + F.col("r")).withColumn("ctp", F.col("tp0") + F.col("c")).drop("stretch", "rank0", "tp0", "r", "c")


def subset_sizes(dets: DataFrame, truth: DataFrame) -> DataFrame:
    """Images, ground truths and detections per subset; subsets without ground truth have 0."""
    both = dets.select("image_id", "grp", F.lit(0).alias("g")).unionByName(truth.select("image_id", "grp", F.lit(1).alias("g")))
    per_image = both.groupBy("grp", "image_id").agg(F.sum("g").alias("gt"), F.count(F.lit(1)).alias("n"))
    return in_subsets(per_image).groupBy("subset").agg(F.count(F.lit(1)).alias("images"), F.sum("gt").alias("gt_objects"), F.sum(F.col("n") - F.col("gt")).alias("detections"))


def average_precision(dets: DataFrame, truth: DataFrame) -> DataFrame:
    """Per subset and threshold index: mean over 101 recall levels of the best precision at that recall or above; null without ground truth."""
    every = F.sequence(F.lit(0), F.lit(THRESHOLDS - 1))
    sizes = subset_sizes(dets, truth)
    c = curve(in_subsets(flags(matched(dets, truth), every)), ["subset", "thr"])
    c = c.filter("tp = 1").join(F.broadcast(sizes.select("subset", "gt_objects")), "subset")
    # The highest level a true positive reaches, in integers: 100 * ctp >= level * gt.
    level = F.floor(100 * F.col("ctp") / F.col("gt_objects")).cast("int")
    cells = c.groupBy("subset", "thr", level.alias("level")).agg(F.max(F.col("ctp").cast("double") / F.col("rank").cast("double")).alias("p"))
    rows = cells.groupBy("subset", "thr").agg(F.collect_list(F.struct("level", "p")).alias("cells"))
    best = lambda i: F.coalesce(F.array_max(F.transform(F.filter("cells", lambda x: x["level"] >= i), lambda x: x["p"])), F.lit(0.0))
    rows = rows.select("subset", "thr", (F.aggregate(F.sequence(F.lit(0), F.lit(GRID - 1)), F.lit(0.0), lambda acc, i: acc + best(i)) / GRID).alias("ap"))
    full = sizes.withColumn("thr", F.explode(every)).join(rows, ["subset", "thr"], "left")
    ap = F.when(F.col("gt_objects") == 0, F.lit(None).cast("double")).otherwise(F.round(F.coalesce("ap", F.lit(0.0)), 9))
    return full.select("subset", F.col("thr").alias("thr_idx"), ap.alias("ap"), F.col("gt_objects").alias("n_gt"), F.col("detections").alias("n_det"))


def mean_ap(dets: DataFrame, truth: DataFrame) -> DataFrame:
    ap = average_precision(dets, truth)
    per = ap.groupBy("subset").agg(F.max(F.when(F.col("thr_idx") == 0, F.col("ap"))).alias("map50"), F.round(F.avg("ap"), 8).alias("map50_95"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.format_string("%.2f", threshold(F.col("thr_idx"))), "ap")))).alias("ap_by_iou"))
    return subset_sizes(dets, truth).join(per, "subset").select("subset", "images", "gt_objects", "detections", "map50", "map50_95", "ap_by_iou")


def at_confidence(dets: DataFrame, truth: DataFrame, confidences: tuple[float, ...] = (0.25,), thr: int = 0) -> DataFrame:
    """Per subset and confidence: tp, fp, fn, precision (0 without detections), recall and f1 (NaN without ground truth).

    Detections below a confidence claim nothing; they come after all others of their image by score, so claims are the same for all
    confidences and only counted up to each.
    """
    f = in_subsets(flags(matched(dets, truth), F.array(F.lit(thr)))).withColumn("conf", F.explode(F.array(*[F.lit(c) for c in confidences]))).filter("score >= conf")
    n = f.groupBy("subset", "conf").agg(F.sum("tp").alias("t"), F.count(F.lit(1)).alias("k"))
    full = subset_sizes(dets, truth).withColumn("conf", F.explode(F.array(*[F.lit(c) for c in confidences]))).join(n, ["subset", "conf"], "left")
    tp, k, gt = F.coalesce("t", F.lit(0)), F.coalesce("k", F.lit(0)), F.col("gt_objects")
    nan = F.lit(float("nan"))
    full = full.select("subset", "conf", "images", tp.cast("long").alias("tp"), (k - tp).cast("long").alias("fp"), (gt - tp).cast("long").alias("fn"), F.when(k > 0, tp.cast("double") / k.cast("double")).otherwise(0.0).alias("precision"), F.when(gt > 0, tp.cast("double") / gt.cast("double")).otherwise(nan).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return full.withColumn("f1", F.when(F.isnan(r), nan).when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def suppressed(dets: DataFrame, iou_above: float = 0.55, max_det: int = 300) -> DataFrame:
    """Greedy suppression per image: by falling score (then id), a box goes if it overlaps a kept one by more than iou_above. Groups are single images."""
    boxed = F.struct(F.col("score").alias("score"), (-F.col("event_id")).alias("back"), *[F.col(c).cast("double").alias(c) for c in BOX])
    per = dets.groupBy("image_id").agg(F.sort_array(F.collect_list(boxed), asc=False).alias("boxes"))
    kind = "array<struct<score:double,back:bigint,x1:double,y1:double,x2:double,y2:double>>"
    corners = lambda b: tuple(b[c] for c in BOX)

    def step(kept: Column, b: Column) -> Column:
        free = (F.size(kept) < max_det) & ~F.exists(kept, lambda k: G.iou(corners(k), corners(b)) > iou_above)
        return F.when(free, F.concat(kept, F.array(b))).otherwise(kept)

    kept = F.aggregate("boxes", F.array().cast(kind), step)
    out = per.select("image_id", F.posexplode(kept).alias("rank", "b"))
    return out.select("image_id", (-F.col("b.back")).alias("event_id"), "rank", F.col("b.score").alias("score"), *[F.col(f"b.{c}").alias(c) for c in BOX])


def merged_tiles(tile_dets: DataFrame, full_dets: DataFrame, width: Column, height: Column, **how) -> DataFrame:
    """Predictions of tiles (in tile coordinates, with x0, y0) and of whole images: moved, clipped, degenerate ones dropped, suppressed."""
    moved = tile_dets.withColumns({"x1": F.col("x1") + F.col("x0"), "x2": F.col("x2") + F.col("x0"), "y1": F.col("y1") + F.col("y0"), "y2": F.col("y2") + F.col("y0")}).drop("x0", "y0")
    both = moved.unionByName(full_dets.select(*moved.columns))
    clip = lambda c, top: F.greatest(F.lit(0), F.least(top, F.col(c)))
    clipped = both.withColumns({"x1": clip("x1", width), "x2": clip("x2", width), "y1": clip("y1", height), "y2": clip("y2", height)})
    return suppressed(clipped.filter("x2 > x1 and y2 > y1"), **how)


def area_histogram(boxes: DataFrame, canvas: Column, bins: int = 60) -> DataFrame:
    """Equal-width bins of box areas in per cent of the canvas; the last bin is closed; empty bins are there."""
    v = boxes.select(F.greatest(F.lit(1e-8), F.lit(100.0) * ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).cast("double") / canvas).alias("v"))
    ends = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    j = v.crossJoin(F.broadcast(ends))  # one row
    b = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"))).otherwise(0)
    counts = j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return boxes.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n_boxes"))


def public(df: DataFrame) -> DataFrame:
    """Without the columns whose names start with an underscore."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def check_arguments(slice_size: int, overlap: float, batch: int = 1, near_threshold: int = 0) -> None:
    if not 0.0 <= overlap < 0.9:
        raise ValueError("overlap must be in [0, 0.9)")
    if slice_size <= 0:
        raise ValueError("slice size must be positive")
    if batch <= 0:
        raise ValueError("batch must be positive")
    if near_threshold < 0:
        raise ValueError("near-duplicate threshold must be 0 or more")


def per_image(dets: DataFrame, confidence: float = 0.25) -> DataFrame:
    """Predictions at or above a confidence, as a list per image in falling order of score."""
    d = dets.filter(F.col("score") >= confidence)
    kept = F.sort_array(F.collect_list(F.struct("score", (-F.col("event_id")).alias("back"))), asc=False)
    return d.groupBy("image_id").agg(F.transform(kept, lambda x: -x["back"]).alias("event_ids"))


def drawn(dets: DataFrame, truth: DataFrame, count: int = 20, confidence: float = 0.25) -> DataFrame:
    """The first images with a prediction or a ground truth, with the numbers of both."""
    both = dets.filter(F.col("score") >= confidence).select("image_id", F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(truth.select("image_id", F.lit(0).alias("p"), F.lit(1).alias("t")))
    return both.groupBy("image_id").agg(F.sum("p").alias("n_predictions"), F.sum("t").alias("n_truth")).orderBy("image_id").limit(count)


def summary_rows(dets: DataFrame, truth: DataFrame, confidence: float = 0.25) -> DataFrame:
    """One row per subset: sizes, mean average precisions, ap_by_iou, and counts and ratios at the confidence."""
    at = at_confidence(dets, truth, (confidence,)).select("subset", "tp", "fp", "fn", F.col("precision").alias("precision_at_conf"), F.col("recall").alias("recall_at_conf"), F.col("f1").alias("f1_at_conf"))
    return mean_ap(dets, truth).join(at, "subset")


def json_of(row: DataFrame) -> DataFrame:
    """subset and value: the row as JSON in which NaN stands bare and null is null, as the reports of an evaluation have them."""
    number = lambda c: F.when(F.isnan(c), "NaN").otherwise(F.coalesce(c.cast("string"), F.lit("null")))
    plain = [F.concat(F.lit(f'"{c}": '), number(F.col(c).cast("double")) if t == "double" else F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c, t in row.dtypes if c not in ("subset", "ap_by_iou")]
    by = F.array_join(F.transform(F.map_entries("ap_by_iou"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), number(e["value"]))), ", ")
    parts = [F.concat(F.lit('"name": '), F.to_json(F.array("subset")).substr(F.lit(2), F.length("subset") + 2)), *plain, F.concat(F.lit('"ap_by_iou": {'), by, F.lit("}"))]
    return row.select("subset", F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")).alias("value"))


def tabulated(dets: DataFrame) -> DataFrame:
    """Detections as a table: rank in the image, rounded score and coordinates."""
    w = Window.partitionBy("image_id").orderBy(F.col("score").desc(), "event_id")
    return dets.select("image_id", "event_id", F.row_number().over(w).alias("rank"), F.round("score", 4).alias("confidence"), *[F.round(F.col(c).cast("double"), 1).alias(c) for c in BOX])
