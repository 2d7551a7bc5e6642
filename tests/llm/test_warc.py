import hashlib

from corvane.llm import warc

SCHEMA = "page_id long, url string, html string, header string, record long, file string"


def brute(rows):
    keep = {}
    for r in rows:
        b = (r.html or "").encode()
        if len(b) >= 1000 and r.page_id is not None:
            keep[b] = max(keep.get(b, r.page_id), r.page_id)
    out = []
    for r in rows:
        b = (r.html or "").encode()
        k = keep.get(b)
        twice = sum((x.html or "").encode() == b for x in rows) > 1
        revisit = k is not None and twice and k != r.page_id
        out.append((r.page_id, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", k if revisit else None))
    return sorted(map(repr, out))


def check(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()
    got = [tuple(r) for r in warc.query(spark, folder).collect()]
    assert sorted(map(repr, got)) == brute(rows)
    return got


def test_pages(spark, sf):
    check(spark, sf)


def test_magic_in_payloads_and_awkward_rows(spark, tmp_path):
    fake = "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.0\r\n"
    rows = [
        (1, "http://a/\r\nX: y", None, "h", 1, "f"),
        (2, None, "", "h", 1, "f"),
        (3, "u", fake, None, None, None),
        (4, "u", fake * 20, None, None, None),
        (5, "u", fake * 20, None, None, None),
        (9, "u", fake * 20, None, None, None),
        (9, "u", fake * 20, None, None, None),
        (6, "u", "é" * 499, None, None, None),
        (7, "u", "é" * 500, None, None, None),
        (8, "u", "é" * 500, None, None, None),
        (10, "u", "é" * 499, None, None, None),
        (None, "u", "null id \r\n", None, None, None),
        (11, "u", "WARC/1.0\r\n", None, None, None),
        (12, "u", "long " * 200_000 + "WARC/1.0\r\n" + "tail", None, None, None),
        (13, "u", "\n".join(f"WARC/1.0\r\nContent-Length: {i}\r\n\r\n" for i in range(500)), None, None, None),
    ]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    assert len(check(spark, tmp_path)) == len(rows)


def test_small_splits_and_blocks(spark, tmp_path):
    rows = [(i, "u", f"{i} WARC/1.0\r\nContent-Length: {i}\r\n\r\n" * (i % 40), None, None, None) for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        path = f"{tmp_path}/warc"
        warc.write(spark.read.parquet(f"{tmp_path}/pages.parquet"), path)
        got = {warc_id(r.header): bytes(r.payload).decode() for r in warc.read(spark, path, block=3000).collect()}
        assert got == {i: h for i, _, h, *_ in rows}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def warc_id(header):
    return int(header.split("<urn:page:")[1].split(">")[0])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert check(spark, tmp_path) == []


def record(payload, length=True, kind="response"):
    body = f"HTTP/1.1 200 OK\r\n\r\n{payload}"
    stated = f"Content-Length: {len(body.encode())}\r\n" if length else ""
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{stated}\r\n{body}\r\n\r\n"


def test_files_that_are_not_whole(spark, tmp_path):
    """Junk before the first record, a last record that is cut off, a record that states no length."""
    (tmp_path / "w").mkdir()
    files = {
        "junk": "no record\r\n\r\n" + record("a"), "cut": record("a") + record("bcdef")[:-8], "none": record("a") + record("b", length=False) + record("c"), "only": record("a"), "empty": "", "magic": record("x WARC/1.0\r\nContent-Length: 3\r\n\r\n") + record("z"),
    }
    for name, text in files.items():
        (tmp_path / "w" / name).write_bytes(text.encode())
    got = {}
    for r in warc.read(spark, f"{tmp_path}/w").orderBy("record").collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append(bytes(r.payload).decode())
    assert {k: sorted(v) for k, v in got.items()} == {"cut": ["a", "b"], "none": ["a"], "only": ["a"], "magic": ["x WARC/1.0\r\nContent-Length: 3\r\n\r\n", "z"]}


def test_revisits_by_sql(spark, tmp_path):
    from corvane.llm import oracle
    from tests.oracle import compare, connect

    rows = [(i, "u", "<p>" + "text " * (250 if i % 3 else 20) + str(i % 4), None, None, None) for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    assert compare(spark, connect(str(tmp_path)), "op5", warc.query, oracle.SQL["op5_warc"], str(tmp_path)) == 40
    assert any(r.record_type == "revisit" for r in warc.query(spark, str(tmp_path)).collect())
