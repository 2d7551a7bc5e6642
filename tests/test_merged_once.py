"""The merge of sources and tiles does its work once."""

from pyspark.sql import functions as F

from corvane.operators import merge
from corvane.plans import catalogue

SF = "/root/testdata/sf0.001"


def test_tiles_and_polygons_are_made_once(spark):
    plan = catalogue.queries()["train_merged"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate " not in plan and "aggregate(" not in plan


def test_ids_of_tiles_share_stretches(spark, monkeypatch):
    stretches = []
    number = merge.dense_ids

    def counted(df, name, bucket, order, start=1):
        if name == "new_id":
            stretches.append(df.select(*[b.alias(f"b{i}") for i, b in enumerate(bucket)]).distinct().count())
        return number(df, name, bucket, order, start)

    monkeypatch.setattr(merge, "dense_ids", counted)
    catalogue.queries()["train_merged"](spark, SF)
    assert stretches == [4]


def test_merge_with_stretches_given(spark):
    df = spark.createDataFrame([("g", 20_003, "b.jpg"), ("0", 7, "a.jpg"), ("g", 10_001, "c.jpg"), ("0", 3, "d.jpg")], "part string, image_id long, file_name string")
    anns = spark.createDataFrame([("g", 20_003, 5), ("0", 7, 2), ("g", 20_003, 4), ("x", 1, 1)], "part string, image_id long, ann_pos int")
    images, numbered = merge.merge_parts(df, anns, image_stretch=F.floor(F.col("image_id") / F.when(F.col("part") == "0", 4).otherwise(15_000)))
    assert [r.file_name for r in images.orderBy("new_id").collect()] == ["d.jpg", "a.jpg", "c.jpg", "b.jpg"]
    assert [(r.new_id, r.ann_pos, r.new_ann_id) for r in numbered.orderBy("new_ann_id").collect()] == [(2, 2, 1), (4, 4, 2), (4, 5, 3)]
