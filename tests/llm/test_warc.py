import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import warc
from tandem.llm.warc import MAGIC, candidate, exits, mark_revisits, read_archives, write_archives

INNER = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
SCHEMA = "page_id long, url string, html string, file string, pos int"


def want(rows, least=0):
    first = {}
    for i, _, html, *_ in rows:
        html = html or ""
        if i is not None and len(html.encode()) >= least:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html, *_ in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        to = first.get(html or "")
        revisit = to is not None and to != i
        out.append((i, len(raw), digest, "revisit" if revisit else "response", to if revisit else None))
    return sorted(map(repr, out))


def pages(seed, n):
    rng = random.Random(seed)
    kinds = ["", None, INNER, "a" + INNER * 3 + "é", MAGIC, MAGIC + "Content-Length: 999999\r\n\r\nzz" + MAGIC * 4, "WARC/1.1\r", "日本" * 50, "x" * 300]
    return [(i, f"http://x/{i}\r\nContent-Length: 3", rng.choice([*kinds, f"page {i}"]), "f", 1) for i in range(n)]


@pytest.mark.parametrize("split", [1 << 27, 900])
def test_magic_in_payloads(spark, tmp_path, split):
    rows = pages(1, 24)
    path = str(tmp_path / "archives")
    write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(2), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = mark_revisits(read_archives(spark, path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(repr(tuple(r)) for r in got) == want(rows)


def test_odd_rows(spark, tmp_path):
    rows = [(3, None, None, None, None), (3, "u", "", "f", 1), (None, "u", "x", None, None), (9, "u", "x", "f", 2), (-4, "u", "y" * 100_000, "f", 3), (9, "u", "x", "f", 2)]
    write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    read = read_archives(spark, str(tmp_path / "a"))
    assert sorted(repr(tuple(r)) for r in mark_revisits(read).collect()) == want(rows)
    assert sorted(repr(tuple(r)) for r in mark_revisits(read, 2).collect()) == want(rows, 2)


def test_no_pages(spark, tmp_path):
    write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"))
    assert mark_revisits(read_archives(spark, str(tmp_path / "a"))).collect() == []


def test_cut_off_archive(spark, tmp_path):
    record = MAGIC + "WARC-Record-ID: <urn:page:%d>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "one.warc").write_bytes((record % 1 + record % 2).encode()[:-6])
    got = read_archives(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r.payload_digest is not None for r in got] == [True, False]
    (tmp_path / "one.warc").write_bytes((record % 1 + "junk" + record % 2).encode())
    assert read_archives(spark, str(tmp_path)).count() == 1


def test_candidates_and_exits():
    assert candidate(b"WARC-Type: x\r\ncontent-length: 12\r\n\r\npayload")[1:] == (36, 12)
    assert candidate(b"no end") is None and candidate(b"no length\r\n\r\n") is None
    assert candidate(b"a: b\r\n\r\nContent-Length: 5\r\n\r\n") is None
    out = exits(np.array([10, 20, 30, 40]), np.array([30, 25, 70, -1]), 50)
    assert out.tolist() == [70, -1, 70, -1]
    assert warc.base32_sha1(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def split_in_another_way(monkeypatch, spark, name, value):
    """Change a setting between the two reads of an archive."""
    plain = warc._joined_payloads

    def changed(*arguments):
        spark.conf.set(name, value)
        return plain(*arguments)

    monkeypatch.setattr(warc, "_joined_payloads", changed)


def test_cores_that_come_and_go_between_the_reads(spark, tmp_path, monkeypatch):
    rows = pages(2, 40)
    path = str(tmp_path / "archives")
    write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    small, cores = "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism"
    before = spark.conf.get(small)
    try:
        spark.conf.set(small, "100")
        spark.conf.set(cores, "12")
        split_in_another_way(monkeypatch, spark, cores, "3")
        got = mark_revisits(read_archives(spark, path)).collect()
    finally:
        spark.conf.set(small, before)
        spark.conf.unset(cores)
    assert sorted(repr(tuple(r)) for r in got) == want(rows)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_other_splits_raise(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "archives")
    write_archives(spark.createDataFrame(pages(3, 40), SCHEMA).coalesce(1), path)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "900")
        split_in_another_way(monkeypatch, spark, name, "1370")
        with pytest.raises(Exception, match="split in another way"):
            read_archives(spark, path).collect()
    finally:
        spark.conf.set(name, before)


def test_records_are_dated(spark, tmp_path):
    table = spark.createDataFrame([(1, "u", "x", "2020-01-02 03:04:05"), (2, "u", "y", None)], "page_id long, url string, html string, at string")
    write_archives(table, str(tmp_path / "a"), F.col("at").cast("timestamp"))
    at = spark.sql("SELECT date_format(to_utc_timestamp(TIMESTAMP '2020-01-02 03:04:05', current_timezone()), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").first()[0]
    got = [r[0] for r in read_archives(spark, str(tmp_path / "a")).select(warc.header("WARC-Date")).collect()]
    assert sorted(got) == ["1970-01-01T00:00:00Z", at]
