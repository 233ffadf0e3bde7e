"""Archives are written, split among tasks and read back."""

from __future__ import annotations

import hashlib
import random

from leadloom.llm.warc import MAGIC, page_number, read_records, write_records
from leadloom.session import fresh_path
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 100 and (h or "") in first and (i is None or i > first[h or ""])
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=repr)


def result(spark, rows):
    path = fresh_path(spark, "warc-test")
    write_records(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    got = read_records(spark, path).select(
        page_number(F.col("record_id")), "payload_bytes", "payload_digest", "record_type", page_number(F.col("refers_to")))
    return sorted(map(tuple, got.collect()), key=repr)


def made():
    draw = random.Random(4)
    inner = MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    parts = ["é漢🙂", "\r\n\r\n", "\n", "x" * 50, MAGIC, MAGIC + "Content-Length: 3\r\n\r\n", inner, inner * 3, "Content-Length: 9\r\n\r\n",
             MAGIC + "Content-Length: 99999999\r\n\r\n", "WARC/1.0", "\r", "<html>"]
    rows = [(i, f"http://x/{i}", "".join(draw.choices(parts, k=draw.randint(0, 12)))) for i in range(300)]
    rows += [(1000 + i, "u\r\nContent-Length: 7\r\n\r\n" if i % 2 else None, rows[i][2]) for i in range(40)]
    rows += [(2000, "u", None), (2001, None, ""), (2002, "u", "short"), (2003, "u", "short"), (None, "u", "y" * 200),
             (None, "u", rows[5][2] + "z" * 100), (2004, "u", rows[5][2] + "z" * 100), (2005, "u", "q" * 300_000 + MAGIC + "q" * 300_000)]
    return rows


def test_round_trip(spark):
    rows = made()
    assert result(spark, rows) == expected(rows)


def test_small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        rows = made()[:200]
        assert result(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty(spark):
    assert result(spark, []) == []
