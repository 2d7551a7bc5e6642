"""Views of the driver's tables in the shapes the engine works on. Integer arithmetic, equal in any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes on a canvas of 1000 x 1000 with scores."""
    placed = table(spark, sf, "events").selectExpr(
        "event_id", "user_id as image_id", "concat('g0', cast(1 + user_id % 5 as string)) as grp", "event_type",
        "100 + 200*((event_id*31) % 5) + 10*((event_id*17) % 3 - 1) as cx", "100 + 200*(((event_id*13) div 5) % 5) + 10*((event_id*11) % 3 - 1) as cy",
        "80 + 5*((event_id*7) % 5) as hw", "80 + 5*((event_id*3) % 5) as hh",
    )
    return placed.selectExpr("event_id", "image_id", "grp", "event_type", "greatest(0, cx - hw) as x1", "greatest(0, cy - hh) as y1", "least(1000, cx + hw) as x2", "least(1000, cy + hh) as y2", "cast((event_id*7919) % 10007 as double) / cast(10007 as double) as score")


def truth(spark: SparkSession, sf: str) -> DataFrame:
    """Ground truth: purchases, none of them in g03."""
    return boxes(spark, sf).filter("event_type = 'purchase' and grp <> 'g03'")


def detections(spark: SparkSession, sf: str) -> DataFrame:
    return boxes(spark, sf).filter("event_type <> 'purchase'")


def sources(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs.join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left").selectExpr(
        "doc_id", "concat('0', cast(1 + cast(substring(source,4,10) as int) % 5 as string)) as grp", "concat(source,'/',lang,'_',cast(doc_id as string),'.jpg') as original_file_name",
        "sha1(text) as content_hash", "coalesce(quality + toxic, 0) as n_ann", "cast(320 + n_chars % 1600 as int) as width", "cast(240 + (n_chars*7) % 900 as int) as height", "concat('raw/', source, '/', cast(doc_id as string), '.jpg') as path",
        "substring(sha1(concat_ws('|', source, cast(doc_id as string))),1,16) as source_key",
    )


def label_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One label line per event: blank, too short, not numeric, odd polygon, boxes and polygons inside and outside the image."""
    part = lambda base, factor, modulus: f"concat('0.', lpad(cast({base}+(event_id*{factor})%{modulus} as string),3,'0'))"
    quad = ", ".join(part(b, 1, m) for b, m in ((100, 300), (100, 200), (500, 400), (100, 200), (500, 400), (500, 300), (100, 300), (500, 300)))
    triangle = ", ".join(part(b, 1, m) for b, m in ((100, 300), (100, 200), (500, 400), (300, 200), (200, 400), (600, 300)))
    box = ", ".join((part(100, 1, 800), part(100, 7, 800), part(20, 1, 300), part(20, 3, 300)))
    return table(spark, sf, "events").selectExpr(
        "event_id", "user_id as image_id",
        "case event_id % 11 when 0 then '' when 1 then '0 0.5 0.5' when 2 then '1 0.1 abc 0.3 0.4' when 3 then '0 0.1 0.2 0.3 0.4 0.5' when 4 then '1 0.5 0.5 0 0.2' when 5 then '0 1.2 0.5 0.3 0.4' "
        f"when 6 then concat_ws(' ', '1', {quad}) when 7 then concat_ws(' ', '0', {triangle}) else concat_ws(' ', cast(event_id%2 as string), {box}) end as line",
    )


def split_of(image_id) -> Column:
    """A fixed split of the fixtures: 7, 2 and 1 of ten images."""
    return F.when(image_id % 10 < 7, "train").when(image_id % 10 < 9, "valid").otherwise("test")


def split_lines(spark: SparkSession, sf: str) -> DataFrame:
    return label_lines(spark, sf).withColumn("split", split_of(F.col("image_id")))


def epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Training metrics per stage and day; ratios of counts."""
    daily = table(spark, sf, "events").groupBy(F.expr("case when user_id % 2 = 0 then 'Stage 1' else 'Stage 2' end").alias("stage"), F.expr("cast(extract(day from ts) as int)").alias("epoch"))
    c = daily.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "purchase").alias("p"), F.count_if(F.col("event_type") == "signup").alias("s"))
    d = lambda a, b: F.when(b != 0, a.cast("double") / b.cast("double"))
    n, p, s = F.col("n"), F.col("p"), F.col("s")
    return c.select("stage", "epoch", d(p, p + s).alias("precision"), d(p + s, n).alias("recall"), d(p, n).alias("mAP50"), d(s, n).alias("mAP50_95"))


def images(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr("p_partkey as image_id", "concat('0', cast(1+p_size%5 as string)) as grp", "cast(200+(p_partkey*37)%2000 as int) as width", "cast(200+(p_partkey*53)%1500 as int) as height")


def signatures(spark: SparkSession, sf: str) -> DataFrame:
    """32-bit SimHash of each document's distinct tokens."""
    words = table(spark, sf, "documents").selectExpr("doc_id", "explode(array_distinct(split(lower(text), ' '))) as w").selectExpr("doc_id", "cast(conv(substring(md5(w),1,8),16,10) as bigint) as h")
    votes = words.distinct().groupBy("doc_id").agg(*[F.sum(F.when(F.shiftright("h", k).bitwiseAND(1) == 1, 1).otherwise(-1)).alias(f"v{k}") for k in range(32)])
    sig = F.lit(0).cast("long")
    for k in range(32):
        sig = sig + F.when(F.col(f"v{k}") > 0, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
    return votes.select("doc_id", sig.alias("sig"))


def polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Flat coordinates of 32 vertices on a canvas of 640 x 640."""
    return table(spark, sf, "embeddings").selectExpr("vec_id", "label", "transform(embedding, e -> (cast(e as double) + 1) * 320) as flat")


def coco_images(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr("o_orderkey as image_id", "concat('0', cast(1 + o_orderkey % 5 as string)) as grp", "concat('img_', cast(o_custkey as string), '.jpg') as file_name")


def coco_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations with their position inside the image; lineitem has no key, so all its columns order them."""
    from pyspark.sql import Window

    every = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("image_id"), F.concat("l_returnflag", "l_linestatus").alias("category"), F.col("l_quantity").alias("area"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*every)).alias("ann_pos"))


def build_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Images of all groups with splits and places; every third one has an odd suffix."""
    return images(spark, sf).selectExpr(
        "image_id", "grp", "width", "height", "cast(image_id as long) as source_index", "case when image_id % 10 < 7 then 'train' when image_id % 10 < 9 then 'valid' else 'test' end as split",
        "substring(sha1(concat_ws('|', grp, cast(image_id as string))), 1, 16) as source_key", "concat('photo ', cast(image_id as string)) as original_file_name", "case when image_id % 3 = 0 then '.PNG' when image_id % 3 = 1 then '.tif' else '.jpeg' end as suffix",
    )


def build_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations with one, two or four polygons on a canvas of 640 x 640, or a box of a mask; some of unknown category, some of images that are not there."""
    flat = F.transform("embedding", lambda e: (e.cast("double") + 1) * 320)
    cut = lambda n, k: F.array(*[F.slice("flat", i * n + 1, n) for i in range(k)])
    x, y, w, h = (F.get("flat", F.lit(i)) for i in range(4))
    box = F.when((w - 300 > 1) & (h - 300 > 1), F.array(F.array(x, y, x + w - 300, y, x + w - 300, y + h - 300, x, y + h - 300))).otherwise(F.array().cast("array<array<double>>"))
    kind = F.col("vec_id") % 4
    polygons = F.when(kind == 0, F.array("flat")).when(kind == 1, cut(32, 2)).when(kind == 2, cut(16, 4)).otherwise(box)
    category = F.when(F.col("label") % 5 < 4, F.concat(F.lit("class "), (F.col("label") % 5).cast("string"))).otherwise(F.lit("unknown"))
    e = table(spark, sf, "embeddings").withColumn("flat", flat)
    return e.select(F.col("vec_id").alias("ann_id"), F.col("vec_id").alias("ann_pos"), (F.col("vec_id") * 4 % 400).alias("image_id"), category.alias("category"), polygons.alias("polygons"))


def build_classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"class {i}", i) for i in range(4)], "category string, class_id int")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Files of exports: documents in folders that count and in one that doesn't, images beside them and below them."""
    path = (
        "case doc_id % 7 when 0 then '_annotations.coco.json' when 1 then 'train/_annotations.json' when 2 then concat('train/images/', cast(doc_id as string), '.jpg') when 3 then 'valid/_annotations.coco-segmentation.json' "
        "when 4 then 'deep/train/_annotations.json' when 5 then concat('valid/', cast(doc_id as string), '.WEBP') else concat('notes', cast(doc_id as string), '.txt') end"
    )
    return table(spark, sf, "documents").selectExpr("concat('0', cast(1 + doc_id % 5 as string)) as grp", f"{path} as path").distinct()


def archives(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Annotation documents of archives, and the images they name with the member each means (or null)."""
    images = table(spark, sf, "documents").selectExpr(
        "concat('g', cast(doc_id % 5 as string)) as archive", "case cast(doc_id / 5 as long) % 4 when 0 then 'train/_annotations.coco.json' when 1 then 'valid/_annotations.coco.json' when 2 then 'x/train/_annotations.json' else '_annotations.json' end as annotation",
        "cast(doc_id / 20 as int) as pos", "concat(lang, ' ', cast(doc_id as string), case doc_id % 3 when 0 then '.JPG' when 1 then '.gif' else '' end) as file_name", "case when doc_id % 9 > 0 then concat('m/', cast(doc_id as string), case doc_id % 2 when 0 then '.png' else '.dat' end) end as member",
    )
    return images.select("archive", "annotation").distinct(), images


def scanned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Images, files, annotations and categories of documents: names, files and sizes are missing here and there."""
    docs = table(spark, sf, "documents")
    images = docs.selectExpr(
        "concat('0', cast(1 + doc_id % 5 as string)) as grp", "concat('doc', cast(doc_id % 10 as string)) as doc", "cast(cast(doc_id % 10 / 5 as int) as int) as place", "cast(doc_id / 10 as int) as pos", "doc_id as id", "concat('d', cast(doc_id % 10 as string)) as dir",
        "case when doc_id % 17 = 0 then null when doc_id % 19 = 0 then '' else concat('i', cast(doc_id as string), '.jpg') end as file_name", "case when doc_id % 13 = 0 then 0 else cast(100 + doc_id % 50 as int) end as width", "cast(80 + doc_id % 40 as int) as height",
    )
    files = docs.filter("doc_id % 7 <> 0").selectExpr("concat('d', cast(doc_id % 10 as string), '/i', cast(doc_id as string), '.jpg') as path", "case when doc_id % 26 = 0 then 0 else 640 end as width", "case when doc_id % 26 = 0 then 0 else 480 end as height", "sha1(cast(doc_id as string)) as content_hash")
    annotations = docs.selectExpr("concat('doc', cast(doc_id % 10 as string)) as doc", "doc_id as image_id", "cast(doc_id % 4 as int) as category_id", "explode(sequence(0, cast(doc_id % 3 as int))) as i").filter("i > 0").drop("i")
    categories = spark.range(10).selectExpr("concat('doc', cast(id as string)) as doc", "explode(array(0, 1, 2)) as id").selectExpr("doc", "id", "case when id = 1 then '  ' else concat(' c', cast(id as string)) end as name")
    return images, files, annotations, categories


def headers(spark: SparkSession, sf: str) -> DataFrame:
    """First bytes of image files in several formats, with the sizes they say."""
    little = lambda c: f"concat(substring(lpad(hex({c}),8,'0'),7,2), substring(lpad(hex({c}),8,'0'),5,2), substring(lpad(hex({c}),8,'0'),3,2), substring(lpad(hex({c}),8,'0'),1,2))"
    return sources(spark, sf).selectExpr(
        "doc_id", "width", "height",
        "unhex(case doc_id % 4 when 0 then concat('89504E470D0A1A0A0000000D49484452', lpad(hex(width),8,'0'), lpad(hex(height),8,'0')) "
        "when 1 then concat('FFD8FFE000044A46FFDB0003AAFFFFC4000411', '22FFC2001108', lpad(hex(height),4,'0'), lpad(hex(width),4,'0'), '03') "
        f"when 2 then concat('424D00000000000000000000000028000000', {little('width')}, {little('height')}) else '00112233' end) as content",
    )


def segmentations(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations with segmentations of every form, as the documents have them."""
    n = "cast(vec_id as string)"
    form = (
        f"case vec_id % 7 when 0 then concat('{{\"counts\":[1,', {n}, '],\"size\":[3,4]}}') when 1 then concat('[0,0,', {n}, ',0,', {n}, ',10]') when 2 then concat('[[0,0,', {n}, ',0,', {n}, ',10],[1,2,3,4]]') when 3 then '[]' "
        f"when 4 then null when 5 then concat('[[0,0,4,0,4,', {n}, '],[0,0,', {n}, ',0,', {n}, ',', {n}, ',0,', {n}, ']]') else '[[]]' end"
    )
    return table(spark, sf, "embeddings").selectExpr("vec_id", f"parse_json({form}) as segmentation", "array(cast(vec_id % 10 as double), 2D, cast(vec_id % 21 as double), cast(vec_id % 5 as double)) as bbox")
