"""All queries of the annotation engine over the fixture views, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import geometry as G
from corvane.functions import scalar as S
from corvane.operators import coco, dedupe, evaluate, labels, merge, metrics, split, tiling
from corvane.sources import readers

from . import build_catalogue, build_oracle
from . import fixtures as X
from .oracle import SQL

CONFIDENCES = (0.05, 0.1, 0.25, 0.4, 0.5, 0.75, 0.9)
CLASS_NAMES = ((0, "smoke"), (1, "fire"), (2, "other"))


def _categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("AF", "class_af"), ("NF", "class_nf"), ("NO", "class_no"), ("RF", "class_rf")], "category string, class_name string")


def coco_image_annotation_join(spark, sf):
    return coco.attach(X.coco_images(spark, sf), X.coco_annotations(spark, sf), _categories(spark))


def coco_category_first_seen_ids(spark, sf):
    return coco.first_seen_classes(X.coco_images(spark, sf), X.coco_annotations(spark, sf))


def coco_remapped_annotations(spark, sf):
    images, anns = X.coco_images(spark, sf), X.coco_annotations(spark, sf)
    known = coco.first_seen_classes(images, anns).filter("class_id < 3")
    return coco.remap(anns, known).groupBy("image_id", "class_id").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))


def _parts(spark, sf):
    part = F.when(F.col("image_id") % 2 == 0, "base").otherwise("sliced").alias("part")
    images, anns = X.coco_images(spark, sf), X.coco_annotations(spark, sf)
    return images.select("*", part).filter("image_id % 11 <> 0"), anns.select("*", part)


def coco_merge_reid(spark, sf):
    images, anns = merge.merge_parts(*_parts(spark, sf))
    per = anns.groupBy("new_id").agg(F.count(F.lit(1)).alias("n"), F.min("new_ann_id").alias("first_ann_id"))
    return images.join(per, "new_id", "left").select("new_id", "part", F.col("image_id").alias("old_id"), "file_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_annotations"), "first_ann_id")


def coco_json_documents(spark, sf):
    docs = coco.documents(X.coco_images(spark, sf), X.coco_annotations(spark, sf))
    back = docs.select("image_id", F.from_json("value", "image_id bigint, file_name string, annotations array<struct<ann_pos:int,category:string,area:double>>").alias("d"))
    return back.select("image_id", F.col("d.file_name").alias("file_name"), F.size("d.annotations").alias("n_annotations"), F.aggregate("d.annotations", F.lit(0.0), lambda a, x: a + x["area"]).alias("total_area"))


def source_manifest(spark, sf):
    s = X.sources(spark, sf)
    per_group = merge.dense_ids(s, "n", [F.col("grp"), F.substring_index("original_file_name", "/", 1)], [F.col("original_file_name"), F.col("source_key"), F.col("doc_id")])
    first = per_group.groupBy("grp").agg(F.min("n").alias("n0"))
    i = per_group.join(F.broadcast(first), "grp").withColumn("source_index", (F.col("n") - F.col("n0")).cast("long"))
    return i.select("grp", "source_index", "source_key", "content_hash", "original_file_name", S.stable_stem(F.col("grp"), F.col("source_index")).alias("stable_stem"))


def group_from_name(spark, sf):
    plain = F.concat(F.lit("g"), F.col("grp"), F.lit("_"), F.lpad(F.col("doc_id").cast("string"), 6, "0"), F.when(F.col("doc_id") % 3 == 0, "_slice_0001").otherwise(""), F.lit(".jpg"))
    name = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("x_"), plain)).when(F.col("doc_id") % 7 == 1, F.concat(F.lit("g"), F.col("grp"), F.lit("-"), F.col("doc_id").cast("string"))).otherwise(plain)
    n = X.sources(spark, sf).select("doc_id", "grp", name.alias("name"))
    return n.select("doc_id", "name", S.group_from_name(F.col("name")).alias("group_code"), S.has_group_prefix(F.col("name"), F.col("grp")).cast("int").alias("has_prefix"), S.source_stem(F.col("name")).alias("source_stem"))


def path_parts(spark, sf):
    p = X.sources(spark, sf).select("doc_id", F.concat(F.lit("\\Data\\"), F.when(F.col("doc_id") % 4 == 0, "Train").when(F.col("doc_id") % 4 == 1, "valid\\x").otherwise("other"), F.lit("\\"), F.replace("original_file_name", F.lit("/"), F.lit("\\"))).alias("raw"))
    c = p.withColumn("path", S.clean_path(F.col("raw")))
    path = F.col("path")
    return c.select("doc_id", "path", S.parent(path).alias("parent"), S.basename(path).alias("base"), S.stem(path).alias("stem"), S.suffix(path).alias("suffix"), S.split_from_path(path).alias("split"))


def member_resolution(spark, sf):
    s = X.sources(spark, sf)
    members = s.filter("doc_id % 5 <> 0").select(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("root/images/"), S.basename(F.col("original_file_name")))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("root/"), F.col("original_file_name"))).otherwise(F.concat(F.lit("else/deep/"), S.basename(F.col("original_file_name")))).alias("member"))
    requests = s.select(F.col("doc_id").alias("id"), F.lit("root").alias("base_dir"), F.col("original_file_name").alias("file_name"))
    return readers.resolve_members(requests, members)


def exact_duplicates(spark, sf):
    return dedupe.exact_duplicates(X.sources(spark, sf))


def near_duplicate_pairs(spark, sf):
    return dedupe.near_document_pairs(X.signatures(spark, sf))


def near_duplicate_clusters(spark, sf):
    r = dedupe.cluster_report(X.sources(spark, sf), X.signatures(spark, sf))
    return r.select("doc_id", "cluster_id", "cluster_size", "kept_source_key", "action", "hamming_to_keep")


def dedupe_survivors(spark, sf):
    return dedupe.survivors(X.sources(spark, sf), X.signatures(spark, sf)).select("doc_id", "grp", "source_key", "n_ann")


def duplicate_report_summary(spark, sf):
    return dedupe.summary(dedupe.exact_duplicates(X.sources(spark, sf)))


def split_counts_table(spark, sf):
    n = spark.range(201).select(F.col("id").alias("n"), F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.lit(t).alias("t")) for v, t in ((0.07, 0.06), (0.1, 0.1), (0.45, 0.45), (20 / 140, 20 / 140))])).alias("r"))
    train, valid, test = split.split_counts(F.col("n"), F.col("r.v"), F.col("r.t"))
    return n.select("n", F.col("r.v").alias("valid_ratio"), F.col("r.t").alias("test_ratio"), train.alias("train"), valid.alias("valid"), test.alias("test"))


def stratified_split(spark, sf):
    return split.assign(X.sources(spark, sf)).select("doc_id", "grp", "source_key", "split")


def split_leakage_violations(spark, sf):
    return split.leaks(split.assign(X.sources(spark, sf)))


def split_group_grid_missing(spark, sf):
    return split.missing(split.assign(X.sources(spark, sf)).filter("not (split = 'test' and grp in ('03', '04'))"))


def split_summary(spark, sf):
    return split.summary(split.assign(X.sources(spark, sf)))


def audit_split_group_summary(spark, sf):
    return split.audit(split.assign(X.sources(spark, sf)))


def stratified_sample(spark, sf):
    return split.sample(split.assign(X.sources(spark, sf)))


def tile_windows(spark, sf):
    return tiling.windows(X.images(spark, sf)).select("image_id", "grp", "window_idx", "x0", "y0", "x1", "y1")


def tile_box_overlap(spark, sf):
    return tiling.overlaps(tiling.windows(X.images(spark, sf)), X.boxes(spark, sf))


def empty_tile_cap(spark, sf):
    t = tiling.windows(X.images(spark, sf))
    return tiling.cap_empty(tiling.counted(t, X.boxes(spark, sf)))


def polygon_area(spark, sf):
    return X.polygons(spark, sf).select("vec_id", F.round(G.polygon_area(F.col("flat")), 5).alias("area"))


def polygon_bbox(spark, sf):
    p = X.polygons(spark, sf).select("vec_id", G.polygon_bbox(F.col("flat"), F.lit(330), F.lit(330)).alias("b"))
    return p.select("vec_id", *[F.col(f"b.{c}").alias(c) for c in "xywh"])


def largest_polygon(spark, sf):
    p = X.polygons(spark, sf).select("vec_id", G.largest_polygon(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("flat", i * 16 + 1, 16))).alias("b"))
    return p.select("vec_id", F.col("b.index").cast("int").alias("polygon_idx"), F.round("b.area", 5).alias("area"))


def polygon_clip_tile(spark, sf):
    tiles = spark.createDataFrame([(0, 0, 0, 320, 320), (1, 320, 0, 640, 320), (2, 0, 320, 320, 640), (3, 320, 320, 640, 640)], "window_idx int, x0 int, y0 int, x1 int, y1 int")
    return tiling.clip_polygons(X.polygons(spark, sf), tiles).select("vec_id", "window_idx", "n_points", F.round("area", 5).alias("area"), F.round("w", 6).alias("w"), F.round("h", 6).alias("h"))


def polygon_to_box(spark, sf):
    p = X.polygons(spark, sf).select("vec_id", F.transform("flat", lambda c: S.clamp01(c / 640)).alias("c"))
    x0, x1, y0, y1 = F.array_min(G.evens(F.col("c"))), F.array_max(G.evens(F.col("c"))), F.array_min(G.odds(F.col("c"))), F.array_max(G.odds(F.col("c")))
    return p.select("vec_id", (x0 + (x1 - x0) / 2).alias("xc"), (y0 + (y1 - y0) / 2).alias("yc"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))


def difference_hashes(spark, sf):
    v = X.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda e: e.cast("double")).alias("v"))
    h = v.select("vec_id", S.difference_hash(F.col("v"), bits=56, width=8).alias("dhash"))
    return h.select("vec_id", "dhash", S.long_to_hex(F.col("dhash")).alias("hex"), S.hamming(F.col("dhash"), S.hex_to_long(S.long_to_hex(F.col("dhash")))).alias("round_trip"), S.hamming(F.col("dhash"), F.lit(0).cast("long")).alias("n_bits"))


def label_parse_convert(spark, sf):
    return labels.convert(X.label_lines(spark, sf)).select("event_id", F.col("blank").cast("int").alias("blank"), "error", "xc", "yc", "w", "h")


def label_parse_audit(spark, sf):
    return labels.audit(X.label_lines(spark, sf)).select("event_id", "class_id", "x_min", "y_min", "x_max", "y_max", "width", "height", "area", "aspect_ratio")


def label_parse_eval(spark, sf):
    return labels.evaluation(X.label_lines(spark, sf), F.lit(640), F.lit(480)).select("event_id", "x1", "y1", "x2", "y2")


def conversion_summary(spark, sf):
    return labels.conversion_summary(X.split_lines(spark, sf))


def label_validation_counts(spark, sf):
    v = X.label_lines(spark, sf).select(labels.violation(F.col("line")).alias("rule")).filter("rule is not null")
    return v.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def audit_image_rows(spark, sf):
    return labels.image_rows(X.split_lines(spark, sf))


def audit_object_rows(spark, sf):
    return labels.object_rows(X.label_lines(spark, sf)).select("image_id", "event_id", "line_number", "class_id", "width", "height", "area", F.col("is_box").cast("int").alias("is_box"))


def class_distribution(spark, sf):
    names = spark.createDataFrame(CLASS_NAMES, "class_id int, class_name string")
    n = labels.audit(X.label_lines(spark, sf)).groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(names).join(n, "class_id", "left").select("class_id", "class_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_objects"))


def iou_pairs(spark, sf):
    return evaluate.iou_pairs(X.detections(spark, sf), X.truth(spark, sf))


def nms_kept(spark, sf):
    return evaluate.suppressed(X.detections(spark, sf)).select("image_id", "event_id", "rank", "score")


def merge_tile_predictions(spark, sf):
    d = X.detections(spark, sf)
    x0, y0 = (F.col("event_id") % 3 * 300).alias("x0"), (F.col("event_id") % 2 * 400).alias("y0")
    tile = d.filter("event_id % 2 = 0").select("event_id", "image_id", "score", "x1", "y1", "x2", "y2", x0, y0)
    full = d.filter("event_id % 2 = 1")
    return evaluate.merged_tiles(tile, full, F.lit(1000), F.lit(1000), max_det=40).select("image_id", "event_id", "rank", "x1", "y1", "x2", "y2")


def match_tp_fp(spark, sf):
    f = evaluate.flags(evaluate.matched(X.detections(spark, sf), X.truth(spark, sf)), F.array(F.lit(0), F.lit(5)))
    return f.select("event_id", "image_id", F.col("thr").alias("thr_idx"), "gt_id", "iou", "tp")


def pr_curve(spark, sf):
    d, t = X.detections(spark, sf), X.truth(spark, sf)
    c = evaluate.curve(evaluate.in_subsets(evaluate.flags(evaluate.matched(d, t), F.array(F.lit(0)))), ["subset"])
    c = c.join(F.broadcast(evaluate.subset_sizes(d, t).select("subset", "gt_objects")), "subset").filter("gt_objects > 0")
    return c.select("subset", "event_id", "rank", "ctp", (F.col("ctp").cast("double") / F.col("rank").cast("double")).alias("precision"), (F.col("ctp").cast("double") / F.col("gt_objects").cast("double")).alias("recall"))


def eval_ap_by_subset(spark, sf):
    return evaluate.average_precision(X.detections(spark, sf), X.truth(spark, sf))


def eval_map_summary(spark, sf):
    return evaluate.mean_ap(X.detections(spark, sf), X.truth(spark, sf)).drop("ap_by_iou")


def precision_recall_at_conf(spark, sf):
    return evaluate.at_confidence(X.detections(spark, sf), X.truth(spark, sf)).drop("images")


def conf_threshold_sweep(spark, sf):
    return evaluate.at_confidence(X.detections(spark, sf), X.truth(spark, sf), CONFIDENCES).drop("images")


def false_positives_per_image(spark, sf):
    c = evaluate.at_confidence(X.detections(spark, sf), X.truth(spark, sf))
    return c.select("subset", "images", "fp", (F.col("fp").cast("double") / F.col("images").cast("double")).alias("fp_per_image"))


def area_histogram(spark, sf):
    return evaluate.area_histogram(X.truth(spark, sf), F.lit(1_000_000.0))


def tabulated_detections(spark, sf):
    return evaluate.tabulated(X.detections(spark, sf))


def best_epoch(spark, sf):
    return metrics.best_epoch(X.epochs(spark, sf))


def stage_comparison(spark, sf):
    return metrics.series(X.epochs(spark, sf))


_ALL = (
    coco_image_annotation_join, coco_category_first_seen_ids, coco_remapped_annotations, coco_merge_reid, coco_json_documents, source_manifest, group_from_name, path_parts, member_resolution,
    exact_duplicates, near_duplicate_pairs, near_duplicate_clusters, dedupe_survivors, duplicate_report_summary, split_counts_table, stratified_split, split_leakage_violations, split_group_grid_missing,
    split_summary, audit_split_group_summary, stratified_sample, tile_windows, tile_box_overlap, empty_tile_cap, polygon_area, polygon_bbox, largest_polygon, polygon_clip_tile, polygon_to_box, difference_hashes,
    label_parse_convert, label_parse_audit, label_parse_eval, conversion_summary, label_validation_counts, audit_image_rows, audit_object_rows, class_distribution, iou_pairs, nms_kept, merge_tile_predictions,
    match_tp_fp, pr_curve, eval_ap_by_subset, eval_map_summary, precision_recall_at_conf, conf_threshold_sweep, false_positives_per_image, area_histogram, tabulated_detections, best_epoch, stage_comparison,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (*_ALL, *build_catalogue.ALL)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in (SQL | build_oracle.SQL).items() if k in queries()}
