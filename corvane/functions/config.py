"""Groups of sources: split ratios and tiling, as a small table that plans may broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Fixed values: (code, name, aliases, (train, valid, test), (size, overlap, least area ratio, drop empty tiles, empty tiles kept per source) or None)
GROUPS = (
    ("01", "01_positive_standard", ["01_positive_standard", "01_Positive_Standard"], (0.87, 0.07, 0.06), None),
    ("02", "02_Alley_Context", ["02_Alley_Context", "02_alley_context"], (0.80, 0.10, 0.10), (640, 0.40, 0.10, False, 6)),
    ("03", "03_Negative_Hard_Samples", ["03_Negative_Hard_Samples", "03_negative_hard_samples"], (100 / 140, 20 / 140, 20 / 140), (640, 0.40, 0.10, False, 8)),
    ("04", "04_SAHI_Small_Objects", ["04_SAHI_Small_Objects", "04_sahi_small_objects"], (70 / 110, 20 / 110, 20 / 110), (416, 0.50, 0.05, True, 0)),
    ("05", "05_Ambient_Context_Null", ["05_Ambient_Context_Null", "05_ambient_context_null", "05_Real_Situation"], (0.87, 0.07, 0.06), None),
)
SPLITS = ("train", "valid", "test")

SCHEMA = "grp string, name string, aliases array<string>, ratios struct<train:double,valid:double,test:double>, slice struct<size:int,overlap:double,min_area_ratio:double,ignore_negative:boolean,max_empty:int>"


def groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, n, a, r, s) for c, n, a, r, s in GROUPS], SCHEMA)


def ratio_column(grp, which: int):
    """The ratio of a group as an expression, without a join."""
    from pyspark.sql import functions as F

    out = F.lit(None).cast("double")
    for c, _, _, r, _ in reversed(GROUPS):
        out = F.when(grp == c, F.lit(r[which])).otherwise(out)
    return out
