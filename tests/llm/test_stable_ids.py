"""Scans are split otherwise from one job of an operator to the next, as they are when executors come and go."""

import itertools

import pytest

from corvane.llm import chunk_dedup, near_dedup, spans, suffix_dedup, unit_dedup, warc

from . import helpers

SPLITS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def shaken(spark, monkeypatch):
    sizes = itertools.cycle(["2k", "128m", "9k", "40k"])
    for module in (spans, chunk_dedup, near_dedup, suffix_dedup, unit_dedup, warc):
        was = module.materialise

        def moved(df, name, keep=False, was=was):
            out = was(df, name, keep)
            spark.conf.set(SPLITS, next(sizes))
            return out

        monkeypatch.setattr(module, "materialise", moved)
    before = spark.conf.get(SPLITS)
    yield lambda: spark.conf.set(SPLITS, next(sizes))
    spark.conf.set(SPLITS, before)


def folder(spark, tmp_path):
    line = "a line that many of the documents have somewhere in them, and that is long enough to be one"
    rows = [(i, "\n".join([f"own {i} {j}" if (i + j) % 3 else f"{line} {j}" for j in range(30)]), None, None, None, 1, "", 1) for i in range(300)]
    rows += [(1000 + i, " ".join(f"w{k} v{i // 3}" for k in range(80)) + f" end{i}", None, None, None, 1, "", 1) for i in range(90)]
    helpers.table(spark, rows).repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("module", [chunk_dedup, near_dedup, suffix_dedup, unit_dedup], ids=lambda m: m.__name__.split(".")[-1])
def test_same_rows(spark, tmp_path, module, shaken):
    from . import test_chunk_dedup, test_near_dedup, test_suffix_dedup, test_unit_dedup

    check = {chunk_dedup: test_chunk_dedup, near_dedup: test_near_dedup, suffix_dedup: test_suffix_dedup, unit_dedup: test_unit_dedup}[module].check
    shaken()
    check(spark, folder(spark, tmp_path))


def test_same_archives(spark, tmp_path, shaken):
    from . import test_warc

    rows = [(i, "u", f"{i} WARC/1.0\r\nContent-Length: {i}\r\n\r\n" * (i % 40), None, None, None) for i in range(400)]
    spark.createDataFrame(rows, test_warc.SCHEMA).coalesce(3).write.parquet(f"{tmp_path}/pages.parquet")
    shaken()
    test_warc.check(spark, tmp_path)


def test_two_threads_keep_their_tables(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    place = folder(spark, tmp_path)
    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(lambda m: m.query(spark, place).count(), [unit_dedup, chunk_dedup, unit_dedup, chunk_dedup]))
    assert got == [390] * 4
