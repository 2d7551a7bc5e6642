"""Queries against their SQL where image ids have seven digits."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from corvane.plans import catalogue
from tests.oracle import compare, connect

SHIFT = 999_950


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """The smallest tables, with copies of images and label lines under ids around a million."""
    folder = str(tmp_path_factory.mktemp("large-ids"))
    for p in glob.glob("/root/testdata/sf0.001/*.parquet"):
        t = spark.read.parquet(p)
        if p.endswith("/part.parquet"):
            t.union(t.withColumn("p_partkey", F.col("p_partkey") + SHIFT)).write.parquet(f"{folder}/part.parquet")
        elif p.endswith("/events.parquet"):
            t.union(t.withColumns({"event_id": F.col("event_id") + SHIFT, "user_id": F.col("user_id") + SHIFT})).write.parquet(f"{folder}/events.parquet")
        else:
            shutil.copy(p, os.path.join(folder, os.path.basename(p)))
    return folder


@pytest.mark.parametrize("name", ["evaluation_records", "train_slices", "empty_tile_cap", "train_merged"])
def test_query_equals_sql(spark, large, name):
    compare(spark, connect(large), name, catalogue.queries()[name], catalogue.oracle_sql()[name], large)
