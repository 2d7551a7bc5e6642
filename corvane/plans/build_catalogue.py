"""Queries of the dataset build, its scans, labels and reports over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import geometry as G
from corvane.functions import scalar as S
from corvane.operators import coco, dedupe, evaluate, labels, merge, metrics, reports, split, tiling
from corvane.sources import listing, readers
from corvane.tables import materialise

from . import fixtures as X


def annotation_discovery(spark, sf):
    return listing.annotation_files(X.listing(spark, sf))


def extraction_names(spark, sf):
    return listing.extraction_names(*X.archives(spark, sf))


def image_listing(spark, sf):
    f = X.listing(spark, sf).withColumn("suffix", S.suffix(F.col("path")))
    return f.filter(F.col("suffix").isin(*readers.IMAGE_SUFFIXES)).select("grp", "path", S.stem(F.col("path")).alias("stem"), "suffix")


def image_path_resolution(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("a/b"), (F.col("doc_id") % 3).cast("string")).alias("dir"), F.concat(F.lit("sub/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("file_name"))
    base, k = S.basename(F.col("file_name")), F.col("doc_id") % 5
    path = F.when(k == 0, F.concat("dir", F.lit("/"), "file_name")).when(k == 1, F.concat("dir", F.lit("/"), base)).when(k == 2, F.concat(F.lit("a/"), "file_name")).when(k == 3, F.concat(F.lit("a/"), base)).otherwise(F.concat(F.lit("z/"), base))
    return listing.image_paths(d.withColumnRenamed("doc_id", "id"), d.select(path.alias("path")).union(d.filter("doc_id % 10 = 0").select(F.concat(F.lit("a/"), base).alias("path"))))


def image_header_sizes(spark, sf):
    return X.headers(spark, sf).select("doc_id", listing.header_size(F.col("content")).alias("s")).select("doc_id", "s.width", "s.height")


def coco_scan(spark, sf):
    return listing.coco_sources(*X.scanned(spark, sf))


def raw_sources_with_hash(spark, sf):
    v = X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("v"), F.transform("embedding", lambda e: e.cast("double")).alias("e"))
    j = X.sources(spark, sf).join(v, F.col("doc_id") == F.col("v"))
    return j.select("doc_id", "grp", "source_key", "original_file_name", "path", F.col("n_ann").alias("annotations"), "content_hash", S.long_to_hex(S.difference_hash(F.col("e"), bits=56, width=8)).alias("dhash"))


def evaluation_records(spark, sf):
    stem = S.stable_stem(F.concat(F.lit("0"), (1 + F.col("image_id") % 5).cast("string")), F.col("image_id"))
    lines = X.label_lines(spark, sf).filter("line <> ''").select(X.split_of(F.col("image_id")).alias("dir"), stem.alias("stem"), F.col("event_id").alias("line_number"), "line")
    i = X.images(spark, sf).withColumn("stem", stem)
    i = i.select(X.split_of(F.col("image_id")).alias("dir"), "stem", F.concat("stem", F.lit(".jpg")).alias("file_name"), "width", "height")
    r = listing.evaluation_records(i, lines)
    return r.select("dir", "stem", "grp", "width", "height", F.size("lines").alias("n_lines"), F.array_join("lines", "|").alias("text"))


def dataset_location(spark, sf):
    d = X.table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("data/"), "n_name").alias("dir"))
    return listing.first_dataset(d.select(F.col("n_nationkey").alias("place"), "dir"), d.filter("n_nationkey > 6").select(F.concat("dir", F.lit("/data.yaml")).alias("path")))


def group_inputs(spark, sf):
    names = X.table(spark, sf, "part").select(F.concat(F.lit("0"), (1 + F.col("p_partkey") % 5).cast("string"), F.lit("_export")).alias("name")).distinct()
    return readers.group_inputs(names, spark.createDataFrame([("04", "given/path")], "grp string, input string"))


def segmentation_polygons(spark, sf):
    p = X.segmentations(spark, sf).select("vec_id", readers.polygons().alias("p"))
    return p.select("vec_id", F.size("p").alias("n_polygons"), F.aggregate(F.transform("p", G.polygon_area), F.lit(0.0), lambda a, x: a + x).alias("area"), F.aggregate(F.transform("p", F.size), F.lit(0), lambda a, x: a + x).alias("n_numbers"))


def bom_text(spark, sf):
    t = X.sources(spark, sf).select("doc_id", F.concat(F.when(F.col("doc_id") % 2 == 0, F.lit("﻿")).otherwise(F.lit("")), F.lit('{"name":"'), "original_file_name", F.lit('"}')).alias("raw"))
    return t.select("doc_id", F.get_json_object(S.strip_bom(F.col("raw")), "$.name").alias("name"), F.length(S.strip_bom(F.col("raw"))).alias("n_chars"))


def normalised_values(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", ((F.col("doc_id") * 37) % 1500 - 200).cast("double").alias("v"), (F.col("doc_id") % 4 * 300).cast("int").alias("size"))
    return d.select("doc_id", S.normalise(F.col("v"), F.col("size")).alias("value"), S.fixed(S.normalise(F.col("v"), F.col("size"))).alias("text"), S.blank_to_null(F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.lit(" x "))).alias("name"))


def _build(spark, sf, groups=None):
    return coco.split_build(X.build_sources(spark, sf), X.build_annotations(spark, sf), X.build_classes(spark), groups)


def split_coco_images(spark, sf):
    return _build(spark, sf)[0].select("split", F.col("id").cast("long").alias("id"), "file_name", "width", "height", "grp", "source_key", "original_file_name")


def split_coco_annotations(spark, sf):
    return _build(spark, sf)[1].select("split", F.col("id").cast("long").alias("id"), F.col("new_image").cast("long").alias("image_id"), "class_id", F.size("polygons").alias("n_polygons"))


def split_build_of_groups(spark, sf):
    images, anns = _build(spark, sf, ("02", "04"))
    n = anns.groupBy(F.col("split").alias("s"), "new_image").agg(F.count(F.lit(1)).alias("n"))
    return images.join(n, (F.col("split") == F.col("s")) & (F.col("id") == F.col("new_image")), "left").select("split", F.col("id").cast("long").alias("id"), "file_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_annotations"))


def coco_document(spark, sf):
    images, anns = _build(spark, sf)
    cats = X.build_classes(spark).select(F.col("class_id").alias("id"), F.col("category").alias("name"))
    images = images.filter("split = 'valid'").select(F.col("id").cast("long").alias("id"), "file_name", "width", "height")
    anns = anns.filter("split = 'valid'").select(F.col("id").cast("long").alias("id"), F.col("new_image").cast("long").alias("image_id"), F.col("class_id").alias("category_id"))
    return coco.document_lines(images, anns, cats)


def clipped_annotations(spark, sf):
    c = tiling.clip_annotations(tiling.windows(X.images(spark, sf)), X.build_annotations(spark, sf))
    return c.select("image_id", "window_idx", "ann_id", F.size("polygons").alias("n_polygons"), F.aggregate("polygons", F.lit(0), lambda n, p: n + F.size(p)).alias("n_numbers"), F.round("area", 5).alias("area"), *[F.round(f"bbox.{c}", 6).alias(c) for c in "xywh"])


def _slices(spark, sf):
    return tiling.slices(X.images(spark, sf).filter(X.split_of(F.col("image_id")) == "train"), X.build_annotations(spark, sf))


def train_slices(spark, sf):
    return _slices(spark, sf)[0].select("image_id", "window_idx", "file_name", "n_ann", (F.col("x1") - F.col("x0")).alias("width"), (F.col("y1") - F.col("y0")).alias("height"))


def train_slice_annotations(spark, sf):
    return _slices(spark, sf)[1].select("image_id", "window_idx", "ann_id", F.round("area", 5).alias("area"))


def train_merged(spark, sf):
    base = X.build_sources(spark, sf).filter("split = 'train'").select(F.lit("0").alias("part"), "image_id", S.stable_stem(F.col("grp"), F.col("source_index")).alias("file_name"))
    windows = tiling.windows(X.images(spark, sf).filter(X.split_of(F.col("image_id")) == "train"))
    # Tiles and annotations both follow from what lies where, so polygons are clipped once.
    clipped = materialise(tiling.clip_annotations(windows, X.build_annotations(spark, sf)).select("grp", "image_id", "window_idx", "ann_id"), "clipped", keep=True)
    part, key = F.concat(F.lit("g"), "grp").alias("part"), (F.col("image_id") * 10_000 + F.col("window_idx")).alias("image_id")
    images = base.unionByName(tiling.kept_tiles(windows, clipped).select(part, key, "file_name"))
    own = X.build_annotations(spark, sf).filter(X.split_of(F.col("image_id")) == "train").select(F.lit("0").alias("part"), "image_id", "ann_pos")
    cut = clipped.select(part, key, F.col("ann_id").alias("ann_pos"))
    merged, new = merge.merge_parts(images, own.unionByName(cut), image_stretch=F.floor(F.col("image_id") / F.when(F.col("part") == "0", 4096).otherwise(4096 * 10_000)))
    per = new.groupBy("new_id").agg(F.count(F.lit(1)).alias("n"), F.min("new_ann_id").alias("first"))
    return merged.join(per, "new_id", "left").select("new_id", "part", "file_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_annotations"), F.col("first").alias("first_ann_id"))


def _label_lines(spark, sf):
    anns = X.build_annotations(spark, sf).join(X.build_classes(spark), "category")
    return labels.segmentation_lines(X.images(spark, sf), anns)


def segmentation_labels(spark, sf):
    return _label_lines(spark, sf)


def skipped_annotations(spark, sf):
    return labels.skipped(_label_lines(spark, sf))


def detection_labels(spark, sf):
    c = labels.convert(X.label_lines(spark, sf)).filter("not blank and error is null")
    return c.select("event_id", labels.detection_line(*[F.col(x) for x in ("xc", "yc", "w", "h")]).alias("line"))


def duplicate_report(spark, sf):
    return dedupe.duplicate_report(X.sources(spark, sf))


def duplicate_report_read_back(spark, sf):
    r = dedupe.summary_of(dedupe.duplicate_report(X.sources(spark, sf)))
    return r.select("clusters", "kept", "removed", F.array_join(F.transform(F.map_entries("removed_by_group"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), " ").alias("removed_by_group"))


def _near(spark, sf):
    return dedupe.cluster_report(X.sources(spark, sf), X.signatures(spark, sf), exact=True)


def near_cluster_numbers(spark, sf):
    return dedupe.numbered_clusters(_near(spark, sf)).select("cluster_id", "cluster_size", "cluster_number")


def near_cluster_sheets(spark, sf):
    return dedupe.sheet_members(_near(spark, sf))


def near_cluster_summary(spark, sf):
    return dedupe.near_summary(_near(spark, sf))


def _audited(spark, sf):
    return labels.image_rows(X.split_lines(spark, sf)).withColumn("grp", F.concat(F.lit("0"), (1 + F.col("image_id") % 5).cast("string")))


def dataset_totals(spark, sf):
    return reports.totals(_audited(spark, sf))


def audit_markdown(spark, sf):
    t = reports.totals(_audited(spark, sf))
    names = spark.createDataFrame([(0, "smoke"), (1, "fire"), (2, "other")], "class_id int, class_name string")
    n = labels.audit(X.label_lines(spark, sf)).groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    classes = names.join(n, "class_id", "left").select("class_id", "class_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_objects"))
    return reports.markdown(t.filter("split = 'all'"), classes, t.filter("split <> 'all' and grp <> 'all'"), F.lit("data"))


def _classes(spark, sf):
    b = X.table(spark, sf, "part").select(F.col("p_brand").alias("class_name")).distinct()
    return merge.dense_ids(b, "class_id", [F.substring("class_name", 1, 7)], [F.col("class_name")], start=0)


def data_yaml(spark, sf):
    return reports.data_yaml(_classes(spark, sf))


def class_names_read_back(spark, sf):
    return listing.class_names(reports.data_yaml(_classes(spark, sf)))


def annotations_by_prefix(spark, sf):
    i = X.coco_images(spark, sf).select("image_id", F.concat(F.when(F.col("image_id") % 7 == 0, "x").otherwise(F.lit("")), F.lit("g"), "grp", F.when(F.col("image_id") % 11 == 0, "-").otherwise(F.lit("_")), F.col("image_id").cast("string")).alias("file_name"))
    return reports.by_prefix(i, X.coco_annotations(spark, sf), ["01", "02", "03", "04", "05", "06"])


def group_subsets(spark, sf):
    return reports.group_subsets(X.coco_images(spark, sf).filter("grp <> '03'").select(F.concat(F.lit("g"), "grp", F.lit("_"), F.col("image_id").cast("string")).alias("file_name")))


def positive_sizes(spark, sf):
    return reports.sized(X.images(spark, sf).withColumn("width", F.when(F.col("image_id") % 10 == 0, 0).otherwise(F.col("width")))).select("image_id", "width", "height")


def pooled_exports(spark, sf):
    i = X.build_sources(spark, sf)
    p = reports.pooled({s: i.filter(F.col("split") == s).select("image_id", "grp") for s in ("train", "valid", "test")})
    return p.groupBy("export", "grp").agg(F.count(F.lit(1)).alias("images"), F.min("image_id").alias("first_image"))


def predictions_per_image(spark, sf):
    return evaluate.per_image(X.detections(spark, sf)).select("image_id", F.size("event_ids").alias("n"), F.array_join("event_ids", ",").alias("event_ids"))


def drawn_images(spark, sf):
    return evaluate.drawn(X.detections(spark, sf), X.truth(spark, sf))


def eval_ap_by_iou(spark, sf):
    s = evaluate.mean_ap(X.detections(spark, sf), X.truth(spark, sf)).withColumn("_private", F.lit(1))
    return evaluate.public(s).select("subset", F.explode("ap_by_iou").alias("iou", "ap"))


def eval_summary_rows(spark, sf):
    return evaluate.summary_rows(X.detections(spark, sf), X.truth(spark, sf)).drop("ap_by_iou")


def _stages(spark, sf):
    e = X.epochs(spark, sf)
    return [e.filter(F.col("stage") == s) for s in ("Stage 1", "Stage 2")]


def stage_best_table(spark, sf):
    return metrics.comparison(_stages(spark, sf))


def metric_aliases(spark, sf):
    e = X.epochs(spark, sf).select("stage", "epoch", *[F.col(c).cast("string").alias(a[i % len(a)]) for i, (c, a) in enumerate(metrics.ALIASES.items())])
    return metrics.with_known_names(e).select("stage", "epoch", *metrics.METRICS)


def empty_grid_cells(spark, sf):
    return split.empty_cells(split.assign(X.sources(spark, sf)).filter("not (split = 'test' and grp in ('03', '04'))"))


ALL = (
    annotation_discovery, extraction_names, image_listing, image_path_resolution, image_header_sizes, coco_scan, raw_sources_with_hash, evaluation_records, dataset_location, group_inputs, segmentation_polygons, bom_text, normalised_values,
    split_coco_images, split_coco_annotations, split_build_of_groups, coco_document, clipped_annotations, train_slices, train_slice_annotations, train_merged, segmentation_labels, skipped_annotations, detection_labels,
    duplicate_report, duplicate_report_read_back, near_cluster_numbers, near_cluster_sheets, near_cluster_summary, dataset_totals, audit_markdown, data_yaml, class_names_read_back, annotations_by_prefix, group_subsets, positive_sizes,
    pooled_exports, predictions_per_image, drawn_images, eval_ap_by_iou, eval_summary_rows, stage_best_table, metric_aliases, empty_grid_cells,
)
