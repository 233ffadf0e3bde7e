"""Merkle fingerprints of documents.

A text is a tree: the root over sections, a section over paragraphs (lines), a paragraph over pieces (clauses). A section ends after a
paragraph whose own hash says so, which keeps the sections away from an edit as they were. A fingerprint is ``root:tree``:
the root is SHA-256 over the section hashes, the tree lists the hashes of the pieces with ``.`` between pieces, ``,`` between
paragraphs and ``;`` between sections. Equal roots mean equal texts; where roots differ, sections that differ lead to
the paragraphs that differ. Column expressions only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadloom.session import cut_lineage

#: A piece of a paragraph: up to 200 characters, its closing marks and the spaces after them.
PIECE = r"[^.!?|,]{1,200}[.!?|,]*[ ]*|[.!?|,]+[ ]*"
#: First hexadecimal digits of a paragraph hash that end a section: one paragraph in four.
ENDS = "0123"


def tree(text: Column) -> Column:
    """The leaves of a text with their separators; null is the empty text."""
    def paragraph(line: Column) -> Column:
        pieces = F.regexp_extract_all(line, F.lit(PIECE), F.lit(0))
        return F.array_join(F.transform(pieces, lambda p: F.substring(F.sha2(p.cast("binary"), 256), 1, 16)), ".")

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), paragraph)
    closed = F.transform(lines, lambda p: F.concat(p, F.when(
        F.substring(F.sha2(p.cast("binary"), 256), 1, 1).isin(*ENDS), F.lit(";")).otherwise(F.lit(","))))
    return F.array_join(closed, "")


def _section_hash(section: Column) -> Column:
    hashes = F.transform(F.split(section, ","), lambda p: F.sha2(p.cast("binary"), 256))
    return F.sha2(F.array_join(hashes, "").cast("binary"), 256)


def fingerprint(leaves: Column) -> Column:
    """``root:tree`` of what ``tree`` gives."""
    root = F.sha2(F.array_join(F.transform(F.split(leaves, ";"), _section_hash), "").cast("binary"), 256)
    return F.concat(root, F.lit(":"), leaves)


def likeness(a: Column, b: Column) -> Column:
    """Shared distinct pieces of two fingerprints, against those of the larger one; 1 where the roots are equal."""
    def pieces(mark: Column) -> Column:
        return F.array_distinct(F.split(F.substring_index(mark, ":", -1), "[.,;]"))

    x, y = pieces(a), pieces(b)
    shared = F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y))
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.lit(1.0)).otherwise(shared)


def edited_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``a`` that ``b`` does not have, found from the root downwards.

    Equal roots give an empty list at once; of sections that ``b`` has too no paragraph is looked at.
    """
    def sections(mark: Column) -> Column:
        return F.split(F.substring_index(mark, ":", -1), ";")

    theirs = sections(b)
    their_lines = F.flatten(F.transform(theirs, lambda s: F.split(s, ",")))
    lines = F.transform(sections(a), lambda s: F.struct(
        F.array_contains(F.transform(theirs, _section_hash), _section_hash(s)).alias("same"), F.split(s, ",").alias("own")))
    marks = F.flatten(F.transform(lines, lambda s: F.transform(
        s["own"], lambda p: ~s["same"] & ~F.array_contains(their_lines, p))))
    numbered = F.transform(marks, lambda m, i: F.when(m, i))
    found = F.filter(numbered, lambda i: i.isNotNull())
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.array().cast("array<int>")).otherwise(found)


def with_next(docs: DataFrame, id_col: str, text: str, rows_per_bucket: int = 50_000) -> DataFrame:
    """Rows (id, text, next_text): the text of the row that follows by id, for the last one that of the first.

    Rows go to ranges of ids; the first row of a range is also sent to the range before it, so that no order of all rows is made in
    one task. There are four ranges per shuffle partition, or more where a range would pass ``rows_per_bucket``. Null ids come first; rows of
    one id follow by the hash of their text. Range bounds are numbers from approximate quantiles; they change sizes, not results.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("at", F.col("id").cast("double"))
    ids = rows.select("at").filter("at is not null")
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // rows_per_bucket + 1)
    bounds = ids.approxQuantile("at", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    place = Bucketizer(splits=splits, inputCol="at", outputCol="bucket", handleInvalid="keep") if len(splits) > 2 else None

    def placed(df: DataFrame) -> DataFrame:
        df = place.transform(df) if place else df.withColumn("bucket", F.lit(0.0))
        return df.withColumn("bucket", F.when(F.col("at").isNull(), F.lit(-1)).otherwise(F.col("bucket").cast("int")))

    narrow = placed(rows.select("id", "h", "at"))
    heads = narrow.groupBy("bucket").agg(F.min(F.struct(F.col("id"), F.col("h"))).alias("head"))
    in_order = W.orderBy("bucket")  # one row per range
    heads = heads.select("head", F.coalesce(
        F.lag("bucket").over(in_order), F.last("bucket").over(in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    ).alias("before"))
    heads = cut_lineage(heads.select(F.col("head.id").alias("head_id"), F.col("head.h").alias("head_h"), "before"))
    dealt = placed(rows).join(heads, F.col("id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    other = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest"))
    dealt = dealt.select("id", "text", "h", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(
        F.array(own, other))).alias("to"))
    order = W.partitionBy("to.bucket").orderBy("to.guest", F.col("id").asc_nulls_first(), "h")
    following = dealt.withColumn("next_text", F.lead("text").over(order)).filter("not to.guest")
    return following.select(F.col("id").alias(id_col), F.col("text").alias(text), "next_text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last quarter (rounded down) replaced by as many first characters of the next document, or
    all of them. Null texts are empty; empty texts are like each other; a single row is its own next one; an empty table
    gives no rows. Every row, repeated ones too, has one result; other columns are not read. A long text is handled as a whole in
    its own row.
    """
    rows = with_next(docs, id_col, text)
    rows = rows.withColumn("n_chars", F.char_length(text).cast("long"))
    part = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col(text), F.lit(1), F.col("n_chars").cast("int") - part),
                      F.substring(F.col("next_text"), F.lit(1), part))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(id_col, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       *[fingerprint(tree(F.col(c))).alias(n) for c, n in (
                           (text, "fingerprint"), ("edited", "edited_fingerprint"), ("next_text", "next_fingerprint"))])
    return rows.select(
        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
