"""Helpers that several operators share: words, running sums, connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadloom.session import cut_lineage

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python workers of all executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="leadloom-package-"), "leadloom.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


_HELD: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What one operator keeps in this Python worker from task to task.

    Spark uses workers again for later stages, so a task of another operator first drops what the others keep and hands
    free memory back to the system. Every task of the text operators asks for its own, also those that keep nothing.
    """
    others = [name for name in _HELD if name != owner]
    for name in others:
        del _HELD[name]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return _HELD.setdefault(owner, {})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def null_safe_key(col: Column) -> Column:
    """A key that is never null and keeps the code point order, null last."""
    return F.when(col.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), col.cast("string")))


def bits_for(rows: int, rows_per_bucket: int) -> int:
    """Bits of a bucket number that give about ``rows_per_bucket`` rows to each of the buckets."""
    bits = 0
    while (rows >> bits) > rows_per_bucket:
        bits += 1
    return bits


def running_before(
    df: DataFrame, group: str, bucket: str, order: list[Column], value: str, out: str, fan: int = 10,
    extra: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group that come earlier.

    The order is that of ``bucket`` (a whole number) and within a bucket that of ``order``. Rows are summed by bucket,
    buckets by blocks of ``2 ** fan``, so no task holds a whole group: one holds the rows of a bucket, the buckets of a
    block or the blocks of a group. ``extra`` (one row per group) is joined to the bucket totals, so that a hot group
    never meets its rows by the group alone. ``df`` should be a stored table; it is read twice.
    """
    block = "__block"
    sums = df.groupBy(group, bucket).agg(F.sum(value).alias("__sum"))
    sums = cut_lineage(sums.withColumn(block, F.shiftright(F.col(bucket), fan)))
    blocks = sums.groupBy(group, block).agg(F.sum("__sum").alias("__block_sum"))
    before = W.partitionBy(group).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("__block_base", F.coalesce(F.sum("__block_sum").over(before), F.lit(0))).drop("__block_sum")
    if extra is not None:
        blocks = blocks.join(extra, group)
    before = W.partitionBy(group, block).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    base = (sums.withColumn("__in_block", F.coalesce(F.sum("__sum").over(before), F.lit(0))).join(blocks, [group, block])
            .withColumn("__base", F.col("__block_base") + F.col("__in_block"))
            .drop("__sum", block, "__block_base", "__in_block"))
    before = W.partitionBy(group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (df.withColumn("__own", F.coalesce(F.sum(value).over(before), F.lit(0))).join(base, [group, bucket])
            .withColumn(out, F.col("__base") + F.col("__own")).drop("__base", "__own"))


#: Bits of a map of keys that tasks get, 2 MB at any size of the corpus; a full map only lets more rows through.
SLOTS = 1 << 24


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of ``SLOTS`` bits with that of every key set, whatever the number of keys."""
    slot = F.col(column).bitwiseAND(F.lit(SLOTS - 1))
    parts = keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    # A bucket covers 32768 slots; bucket numbers start at 1 for slots from 1, so slot 0 lies in bucket 0.
    out = np.zeros(SLOTS, dtype=np.uint8)
    for b, bits in parts:
        low = np.unpackbits(np.frombuffer(bytes(bits), dtype=np.uint8), bitorder="little")
        slots = (b - 1) * 32768 + 1 + np.flatnonzero(low) if b > 0 else -np.flatnonzero(low)
        out[slots] = 1
    return np.packbits(out, bitorder="little")


def has_bit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set in a :func:`bitmap`."""
    slot = keys & (SLOTS - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``edges`` (two columns of ids): rows (node, component), component the smallest id.

    Every round each edge brings the smaller root of its two ends to the other root, then roots jump to their own root,
    until no edge joins two roots. The number of rounds grows with the logarithm of the longest chain. Every round is a
    written table; only the number of open edges reaches the driver. Nodes without an edge are not listed.
    """
    edges = cut_lineage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = cut_lineage(nodes.select("node", F.col("node").alias("root")))
    while True:
        ra, rb = roots.toDF("a", "ra"), roots.toDF("b", "rb")
        open_edges = cut_lineage(
            edges.join(ra, "a").join(rb, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        if open_edges.isEmpty():
            return roots.toDF("node", "component")
        # Roots only ever point to smaller roots, so following them ends; jump until nothing moves.
        up = cut_lineage(open_edges.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("up")))
        while True:
            above = up.toDF("up", "next")
            moved = cut_lineage(up.join(above, "up", "left").select("root", F.coalesce("next", "up").alias("up"),
                                                                    F.col("next").isNotNull().alias("moved")))
            up = moved.select("root", "up")
            if moved.filter("moved").isEmpty():
                break
        roots = cut_lineage(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        edges = open_edges
        # What is left joins roots, not nodes: an edge of roots stays valid because a root is a node of its own.
