"""Small document tables with awkward rows."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, uid string, `n` int"

LONG = " ".join(f"w{i % 977} abc{i}" for i in range(30_000))

ROWS = [
    (1, None, None, None, None, 1, "a", None),
    (2, "", "en", "a", 0, 1, "a", 1),
    (3, " \n\t \n", "en", "a", 5, 1, None, 1),
    (4, "one two three", "en", "b", 13, 1, "a", 1),
    (4, "one two three", "en", "b", 13, 1, "a", 1),
    (5, "one two three", "en", "b", 13, 2, "b", 2),
    (None, "a null id with é and 日本語 and 😀 emoji\r\nsecond line\nsecond line", "fr", "c", 40, None, None, None),
    (6, LONG, "en", "c", len(LONG), 3, "z", 3),
    (7, "the same eight words come back again here " * 9, "de", "d", 1, 3, "z", 3),
    (8, "### $$$ %%% &&& ||| <<<" * 5, "de", None, 1, 3, "z", 3),
]


def table(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write(df, tmp_path):
    """df as documents.parquet in a folder that queries can read."""
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)
