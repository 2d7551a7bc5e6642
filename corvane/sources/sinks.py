"""Writers: tables as CSV with headers, documents and labels as lines, metrics as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True, emptyValue="")


def json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def coco_lines(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """documents (value): one JSON object a line."""
    documents.select("value").write.mode(mode).text(path)


def label_texts(lines: DataFrame) -> DataFrame:
    """lines (stem, line_number, line; line null for background) -> (stem, text): one file's content per image, with a final line end unless empty."""
    per = lines.groupBy("stem").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("line_number", "line")))), lambda x: x["line"]), "\n").alias("text"))
    return per.select("stem", F.when(F.col("text") == "", "").otherwise(F.concat("text", F.lit("\n"))).alias("text"))


def labels(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Label texts as a table by stem; one small file per image would not scale, export() makes those."""
    label_texts(lines).write.mode(mode).parquet(path)


def export(lines: DataFrame, write_file) -> None:
    """Calls write_file(stem, text) on the executors for each image."""

    def each(rows):
        for r in rows:
            write_file(r.stem, r.text)

    label_texts(lines).foreachPartition(each)


def report(df: DataFrame, columns: tuple[str, ...], path: str, mode: str = "errorifexists") -> None:
    """A CSV table under fixed columns, whose header is there even if there is no row."""
    if df.isEmpty():
        df.sparkSession.createDataFrame([(",".join(columns),)], "value string").coalesce(1).write.mode(mode).text(path)
    else:
        csv(df.select(*columns), path, mode)


def coco_document(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines (section, n, line) of a document as text files, which make up the document one after the other by name."""
    lines.orderBy("section", "n").select("line").write.mode(mode).text(path)
