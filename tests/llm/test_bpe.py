import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from corvane.llm import bpe

from . import helpers

AWKWARD = ["", "a", "  two  spaces ", "don't we'll I'M", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endof", "\r\n\t tab", "é日本語😀", "123 4567a8", "  x ", "a" * 5000, "ab" * 3000 + " " * 300, "\x00\x01\x7f", "ÄÖ" * 700]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary())


def want(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_awkward_texts(library):
    c = bpe.Codec(bpe.vocabulary())
    letters = "abcdefgh  \n'tsé<|>0"
    rng = random.Random(5)
    for t in [*AWKWARD, *("".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(300))]:
        assert list(memoryview(c.encode(t)).cast("I")) == library.encode(t, add_special_tokens=False).ids
        assert c.decode(c.encode(t)) == library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False)


def test_both_ways_to_merge_agree():
    c, rng = bpe.Codec(bpe.vocabulary()), random.Random(7)
    for _ in range(500):
        w = bytes(rng.choice(b"thearnoisp ") for _ in range(rng.randrange(1, 120)))
        assert c.merge_short(w) == c.merge_long(w)


def check(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in bpe.query(spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(repr((r.doc_id, *want(library, r.text or ""))) for r in docs)


def test_query(spark, sf, library):
    check(spark, sf, library)


def test_awkward_rows(spark, tmp_path, library):
    check(spark, helpers.write(helpers.table(spark), tmp_path), library)


def test_empty_table(spark, tmp_path, library):
    check(spark, helpers.write(helpers.empty(spark), tmp_path), library)


def test_encode_returns_ids_and_text(spark):
    for r in bpe.encode(helpers.table(spark, helpers.ROWS[3:7]), bpe.vocabulary()).collect():
        assert len(r.ids) % 4 == 0 and r.decoded
