"""Cutting character spans out of documents: what the substring and line operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import P, materialise, ship

#: Texts turned into Python strings at a time.
AT_ONCE = 128


def numbered(docs: DataFrame) -> DataFrame:
    """docs with __cv_uid, written once to the shared folder.

    A number that a plan computes anew in each job depends on how the scan was split, and that on the cores there are at that moment. So all jobs
    of an operator read the written number, whatever happens to the executors between them.
    """
    ship(docs.sparkSession)
    return materialise(docs.withColumn(f"{P}uid", F.monotonically_increasing_id()), "numbered")


def slices(batches: Iterator, rows: int = AT_ONCE) -> Iterator:
    """The batches in parts of a few rows, so that what Python makes of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def rows_of(docs: DataFrame, key: str, text: str, schema: T.StructType, each: Callable[[int, object, str], list[tuple]]) -> DataFrame:
    """each(uid, key, text) gives rows of schema for every document with a text; docs has __cv_uid."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        for part in slices(batches):
            out = [r for u, k, t in zip(*(c.to_pylist() for c in part.columns)) if t for r in each(u, k, t)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), to)], schema=to)

    return docs.select(f"{P}uid", F.col(key).alias(f"{P}key"), F.col(text).alias(f"{P}text")).mapInArrow(run, schema)


def cut(text: str | None, starts: list[int] | None, ends: list[int] | None) -> str | None:
    """text without the spans (disjoint, in any order)."""
    if not text or not starts:
        return text
    out, at = [], 0
    for s, e in sorted(zip(starts, ends)):
        out.append(text[at:s])
        at = e
    return "".join([*out, text[at:]])


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs (with __cv_uid) with __cv_starts and __cv_ends (arrays, null for none) of spans (__cv_of, __cv_start, __cv_end)."""
    lists = spans.groupBy(f"{P}of").agg(F.sort_array(F.collect_list(F.struct(f"{P}start", f"{P}end"))).alias(f"{P}list"))
    lists = lists.select(f"{P}of", F.col(f"{P}list.{P}start").alias(f"{P}starts"), F.col(f"{P}list.{P}end").alias(f"{P}ends"))
    return docs.join(lists.hint("merge"), F.col(f"{P}uid") == F.col(f"{P}of"), "left").drop(f"{P}of")


@F.pandas_udf(T.StringType())
def without_spans(text, starts, ends):
    import pandas as pd

    return pd.Series([cut(t, None if s is None else list(s), None if e is None else list(e)) for t, s, e in zip(text, starts, ends)], dtype=object)
