"""Training metrics: best epochs, series, comparison of stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("precision", "recall", "mAP50", "mAP50_95")
#: Names under which trainers write the metrics.
ALIASES = {
    "precision": ("metrics/precision(B)", "metrics/precision", "precision"),
    "recall": ("metrics/recall(B)", "metrics/recall", "recall"),
    "mAP50": ("metrics/mAP50(B)", "metrics/mAP50", "mAP50"),
    "mAP50_95": ("metrics/mAP50-95(B)", "metrics/mAP50-95", "mAP50_95"),
}


def with_known_names(df: DataFrame) -> DataFrame:
    """Metric columns under their own names, whichever alias the file has; missing ones are null."""
    out = df
    for name, aliases in ALIASES.items():
        found = next((a for a in aliases if a in df.columns), None)
        out = out.withColumn(name, F.col(f"`{found}`").try_cast("double") if found else F.lit(None).cast("double"))
    return out


def best_epoch(rows: DataFrame) -> DataFrame:
    """Per stage the first epoch of the highest mAP50; missing mAP50 ranks last, missing metrics are NaN."""
    score = F.coalesce("mAP50", F.lit(float("-inf")))
    nan = lambda c: F.coalesce(F.col(f"r.{c}"), F.lit(float("nan"))).alias(c)
    best = rows.groupBy("stage").agg(F.min_by(F.struct("epoch", *METRICS), F.struct((-score).alias("a"), F.col("epoch").alias("b"))).alias("r"))
    return best.select("stage", F.col("r.epoch").alias("best_epoch"), *[nan(c) for c in METRICS])


def series(rows: DataFrame) -> DataFrame:
    """Long form: one row per stage, epoch and metric."""
    return rows.unpivot(["stage", "epoch"], list(METRICS), "metric", "value").filter("value is not null")


def comparison(stages: list[DataFrame]) -> DataFrame:
    """The best epoch of each stage, one below the other."""
    out = best_epoch(stages[0])
    for s in stages[1:]:
        out = out.unionByName(best_epoch(s))
    return out


def long_series(wide: DataFrame) -> DataFrame:
    """All columns but stage and epoch in long form, whatever the trainer wrote."""
    return wide.unpivot(["stage", "epoch"], [c for c in wide.columns if c not in ("stage", "epoch")], "metric", "value").filter("value is not null")
