"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import ship
from corvane.tables import materialise, new_folder, scratch, shared_dir

__all__ = ["P", "WORD", "documents", "let", "materialise", "new_folder", "scratch", "shared_dir", "ship", "text_of"]

#: Words, as every operator here counts them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Prefix of internal columns, so that no input column's name clashes with them.
P = "__cv_"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once: projections that merge cannot copy it into a lambda."""
    return F.transform(F.array(value), body).getItem(0)
