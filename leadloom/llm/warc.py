"""Web archives: writing WARC files and reading them back by their chain of boundaries.

Files are written by Spark's text writer, a record per row with two line ends after it. They are read by Spark's text
reader with the record magic as separator, so large files are split among tasks. Each task gives every piece that
follows a magic as a candidate: where it begins and, by its length header, where the next record must begin. A payload may hold
the magic too. Pointer jumping from the start of each file finds the candidates that the chain reaches; others are
payload. The number of rounds is the logarithm of the records in a file.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadloom.llm.common import ship_package
from leadloom.session import cut_lineage

MAGIC, END = "WARC/1.0\r\n", "\r\n\r\n"
#: Payloads of fewer bytes are always stored.
REVISIT_FROM = 100
#: Bytes of a file that pieces are grouped by when a payload is put together.
STRETCH = 1 << 16
_HEADER = regex.compile(rb"([A-Za-z][A-Za-z0-9-]*):[ \t]*([^\r\n]*)\r\n")


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def write_records(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
                  date: str = "1970-01-01T00:00:00Z", per_file: int = 100_000) -> None:
    """Write a record per row below ``path``: ``response``, or ``revisit`` for a payload that a smaller id holds.

    Payloads are UTF-8; null is empty. Of equal payloads of at least ``REVISIT_FROM`` bytes, rows with the smallest id are
    responses, all others revisit it and hold no payload. Null ids are larger than all others; payloads that only null
    ids have are responses. Characters of a URL that would break a header line are percent-encoded; a null URL has no header.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).alias("url"), body.alias("body"),
                        F.octet_length(body).cast("long").alias("size"), F.sha2(body.cast("binary"), 256).alias("digest"))
    again = (rows.filter(F.col("size") >= REVISIT_FROM).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1 and first is not null").select("digest", "first"))
    rows = rows.join(cut_lineage(again), "digest", "left")
    revisit = F.col("first").isNotNull() & ((F.col("id") > F.col("first")) | F.col("id").isNull())
    safe = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    stored = F.when(revisit, F.lit("")).otherwise(F.col("body"))
    record = F.concat(
        F.lit(MAGIC), _header("WARC-Type", kind), _header("WARC-Record-ID", name), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", safe), _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
        _header("WARC-Refers-To-Payload-Length", F.when(revisit, F.col("size").cast("string"))),
        F.lit("Content-Type: text/html\r\n"), _header("Content-Length", F.octet_length(stored).cast("string")),
        F.lit("\r\n"), stored)
    rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


CANDIDATE = ("file string, block long, rel long, size long, header long, content long, type string, id string, refers string, "
             "digest string, told long, own_digest string, piece binary")


def _number(value: bytes | None) -> int | None:
    return int(value) if value is not None and value.isdigit() and len(value) < 19 else None


def _candidates(batches, keep: bool = False):
    """A row for every piece. Bytes stay with it if its payload is not complete, or ``keep`` is set; else their digest does."""
    file = block = None
    at = 0
    for batch in batches:
        columns = {name: [] for name in (part.split()[0] for part in CANDIDATE.split(", "))}
        for name, start, value in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(),
                                      batch.column("value").to_pylist()):
            if (name, start) != (file, block):
                file, block, at = name, start, 0
            row = {"file": file, "block": block, "rel": at, "size": len(value)}
            at += len(value) + len(MAGIC)
            end = value.find(b"\r\n\r\n") + 4
            fields = dict((k.lower(), v) for k, v in _HEADER.findall(value, 0, end)) if end > 3 else {}
            length = _number(fields.get(b"content-length"))
            text = {k: fields[k].decode("utf-8", "replace") for k in fields}
            if length is not None:
                row |= {"header": end, "content": length, "type": text.get(b"warc-type"), "id": text.get(b"warc-record-id"),
                        "refers": text.get(b"warc-refers-to"), "digest": text.get(b"warc-payload-digest"),
                        "told": _number(fields.get(b"warc-refers-to-payload-length"))}
            if length is not None and end + length + 4 == len(value) and not keep:
                row["own_digest"] = hashlib.sha256(memoryview(value)[end:end + length]).hexdigest()
            else:
                row["piece"] = value
            for key, out in columns.items():
                out.append(row.get(key))
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k])
                            for n, k in (part.split() for part in CANDIDATE.split(", "))])
        yield pa.RecordBatch.from_pydict(columns, schema=schema)


def reachable(links: DataFrame) -> DataFrame:
    """Of rows (file, at, next) those that the chain from 0 reaches, as (file, at).

    In every round marked rows mark the row they jump to and all jumps double; it ends when no marked row jumps on.
    """
    state = cut_lineage(links.select("file", "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("mark"))
                        .dropDuplicates(["file", "at"]))
    while True:
        marks = state.filter("mark and jump is not null").select("file", F.col("jump").alias("at"), F.lit(True).alias("hit"))
        ahead = state.select("file", F.col("at").alias("jump"), F.col("jump").alias("jump2"), F.lit(True).alias("known"))
        step = state.join(ahead, ["file", "jump"], "left").join(marks, ["file", "at"], "left")
        state = cut_lineage(step.select(
            "file", "at", F.when(F.col("known"), F.col("jump2")).alias("jump"), (F.col("mark") | F.coalesce("hit", F.lit(False))).alias("mark")))
        if state.filter("mark and jump is not null").isEmpty():
            return state.filter("mark").select("file", "at")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, offset, record_type, record_id, refers_to, payload_bytes, payload_digest, header_digest) of all records below ``path``.

    Length and digest are those of the bytes that were read; of a revisit, those of the payload it stands for as its headers
    tell. Records behind a break in the chain of a file are not reached. Without files there are no rows.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))
    found = cut_lineage(lines.mapInArrow(_candidates, CANDIDATE))
    blocks = found.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # blocks of one file
    base = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    base = cut_lineage(base)
    placed = found.join(base, ["file", "block"]).withColumn("at", F.col("base") + F.col("rel") - len(MAGIC)).filter("at >= 0")
    stop = F.col("at") + len(MAGIC) + F.col("header") + F.col("content") + len(END)
    placed = cut_lineage(placed.withColumn("next", stop).drop("base", "rel", "block"))
    chain = reachable(placed.filter("next is not null").select("file", "at", "next"))
    records = cut_lineage(placed.join(chain, ["file", "at"]))

    # Payloads that hold the magic lie in several pieces; stretches of a file bring them to their record.
    broken = records.filter("own_digest is null").select("file", F.col("at").alias("start"), "next", "header", "content", F.col("piece").alias("head"))
    stretch = F.explode(F.sequence(F.floor(F.col("start") / STRETCH), F.floor(F.col("next") / STRETCH)))
    owners = broken.select("file", "start", "next", stretch.alias("s"))
    others = placed.join(chain, ["file", "at"], "left_anti")
    pieces = others.filter("piece is not null").select("file", "at", "piece")
    hidden = cut_lineage(others.filter("piece is null").select("file", "at"))
    if not hidden.isEmpty():
        # A whole record inside a payload: only its digest was kept, so the bytes are read again.
        again = lines.mapInArrow(lambda batches: _candidates(batches, True), CANDIDATE).join(base, ["file", "block"])
        again = again.select("file", (F.col("base") + F.col("rel") - len(MAGIC)).alias("at"), "piece")
        pieces = pieces.unionByName(again.join(hidden, ["file", "at"], "left_semi"))
    pieces = pieces.withColumn("s", F.floor(F.col("at") / STRETCH))
    inner = pieces.join(owners, ["file", "s"]).filter("at > start and at < next").select("file", "start", "at", "piece")
    parts = inner.groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("parts"))
    whole = broken.join(parts, ["file", "start"], "left")
    magic = F.lit(MAGIC).cast("binary")
    joined = F.aggregate(F.coalesce("parts", F.array().cast("array<struct<at:bigint,piece:binary>>")),
                         F.col("head"), lambda s, p: F.concat(s, magic, p["piece"]))
    body = F.substring(joined, F.col("header") + 1, F.col("content"))
    mended = whole.select("file", F.col("start").alias("at"), F.sha2(body, 256).alias("mended"), F.octet_length(body).cast("long").alias("got"))
    out = records.join(cut_lineage(mended), ["file", "at"], "left")
    revisit = F.col("type") == "revisit"
    told = F.regexp_replace("digest", "^sha256:", "")
    return out.select(
        "file", F.col("at").alias("offset"), F.col("type").alias("record_type"), F.col("id").alias("record_id"),
        F.col("refers").alias("refers_to"), F.when(revisit, F.col("told")).otherwise(F.coalesce("got", "content")).alias("payload_bytes"),
        F.when(revisit, told).otherwise(F.coalesce("mended", "own_digest")).alias("payload_digest"), told.alias("header_digest"))


def page_number(urn: Column) -> Column:
    """The number in a record id of ``write_records``; null for a page without one."""
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
