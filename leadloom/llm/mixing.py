"""Mixing sources to target weights over the course of training.

Every source has a weight schedule over training time 0 to 1 (straight lines between knots). Its share of the stream at
a time is its weight among all weights; the integral of the share is its demand. A source can be repeated
``max_repeats`` times at most; what a source cannot give is dealt to the others by weight. The cumulative demand of a
source is a rising curve, and a document's place is where that curve reaches the words before it: documents of a source
follow each other in hashed order, all sources run side by side. Sorting by place gives the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadloom.llm.common import bits_for, null_safe_key, running_before, word_count
from leadloom.session import cut_lineage


def cycle_schedule(sources: DataFrame, weights: list[float], tilt: float = 0.0) -> DataFrame:
    """Knots (key, t, weight) for sources that take the weights in turn, by code point, null last.

    ``sources`` has one row per source (``key``). A tilt of 0.5 lets a weight fall from 1.5 to 0.5 times its value for
    the first source, rise for the second, and so on; 0 keeps it level. The place of a source is a window over one row
    per source.
    """
    place = F.row_number().over(W.orderBy("key")) - 1
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.select("key", place.alias("place"))
    sign = F.when(F.pmod("place", F.lit(2)) == 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    weight = F.get(kinds, F.pmod("place", F.lit(len(weights))))
    return ranked.select("key", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), (weight * (1 + sign * tilt * (2 * t - 1))).alias("weight")) for t in (0.0, 1.0)
    ])).alias("knot")).select("key", "knot.t", "knot.weight")


def _curves(sources: DataFrame, schedule: DataFrame, steps: int) -> DataFrame:
    """Per source: ``weight`` (mean over time) and ``curve``, the shares of its demand due by each of the steps.

    Weights of a step are read at its middle, so a straight line is integrated exactly. Sources without a schedule
    weigh nothing.
    """
    knots = schedule.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("t", "weight"))).alias("knots"))
    grid = F.expr(f"transform(sequence(0, {steps - 1}), k -> (k + 0.5D) / {steps})")
    at = sources.select("key").join(knots, "key", "left").select("key", "knots", F.posexplode(grid).alias("step", "at"))
    low = F.expr("element_at(filter(knots, k -> k.t <= at), -1)")
    high = F.expr("get(filter(knots, k -> k.t > at), 0)")
    at = at.withColumn("low", low).withColumn("high", high)
    line = F.col("low.weight") + (F.col("high.weight") - F.col("low.weight")) * (
        (F.col("at") - F.col("low.t")) / (F.col("high.t") - F.col("low.t")))
    at = at.select("key", "step", F.coalesce(line, F.col("low.weight"), F.col("high.weight"), F.lit(0.0)).alias("w"))
    total = at.groupBy("step").agg(F.sum("w").alias("all_w"))
    share = F.when(F.col("all_w") > 0, F.col("w") / F.col("all_w")).otherwise(0.0)
    steps_of = at.join(total, "step").select("key", "step", "w", share.alias("share"))
    each = steps_of.groupBy("key").agg(
        F.avg("w").alias("weight"), F.sum("share").alias("all_share"),
        F.sort_array(F.collect_list(F.struct("step", "share"))).alias("shares"))
    sums = F.expr("transform(sequence(0, size(shares)), k -> aggregate(slice(shares, 1, k), 0D, (s, x) -> s + x.share))")
    return each.select("key", "weight", F.transform(
        sums, lambda s: F.when(F.col("all_share") > 0, s / F.col("all_share")).otherwise(0.0)).alias("curve"))


def targets(totals: DataFrame, max_repeats: float) -> DataFrame:
    """Add ``target`` to rows (key, source_size, weight): the words each source gives.

    All targets sum to the size of all sources. A source's part is by weight, at most ``max_repeats`` times its size;
    what is over is dealt again by weight until no source is above. In order of (limit / weight) the limited sources
    come first, so two running sums over one row per source find them. A source without weight gives nothing, also if
    that leaves the mix short.
    """
    limit = max_repeats * F.col("source_size")
    by_ratio = W.orderBy(limit / F.col("weight"), "key")
    whole = totals.withColumn("all_size", F.sum("source_size").over(W.partitionBy()))
    rows = whole.filter("weight > 0").select(
        "*", F.sum("source_size").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)).alias("size_before"),
        F.sum("weight").over(by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("weight_from"))
    left = F.col("all_size") - max_repeats * F.coalesce("size_before", F.lit(0))
    rows = rows.withColumn("level", left / F.col("weight_from"))
    rows = rows.withColumn("limited", F.col("level") * F.col("weight") > limit)
    level = F.min(F.when(~F.col("limited"), F.struct(limit / F.col("weight"), F.col("key"), F.col("level")))).over(
        W.partitionBy())["level"]
    target = F.when(F.col("limited"), limit.cast("double")).otherwise(level * F.col("weight"))
    found = rows.select("key", target.alias("target"))
    return totals.join(found, "key", "left").withColumn("target", F.coalesce("target", F.lit(0.0)))


def plan(
    docs: DataFrame, weights: list[float], max_repeats: float = 3.0, tilt: float = 0.0, steps: int = 16,
    id_col: str = "doc_id", text: str = "text", source: str = "source", rows_per_bucket: int = 1000,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: its words, its source's words and target, what the mix takes of it and where.

    Columns: id, ``size``, ``source_size``, ``target``, ``taken``, ``pieces`` (array of copy, position, words; one entry
    per copy that is taken) and the columns named in ``keep``. The target is met to the word: the last document that a
    source gives is taken in part. Documents without words are never taken; null is a source of its own, null ids are
    hashed like any other, equal rows are interchangeable. An empty table gives no rows. Other columns are not read.
    """
    order_key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = cut_lineage(docs.select(
        F.col(id_col), *[F.col(c) for c in keep or []], null_safe_key(F.col(source)).alias("key"),
        word_count(F.col(text)).alias("size"), order_key.alias("h")))
    bits = bits_for(rows.count(), rows_per_bucket)
    rows = rows.withColumn("bucket", F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), 32 - bits))
    sources = cut_lineage(rows.groupBy("key").agg(F.sum("size").alias("source_size")))
    curves = _curves(sources, cycle_schedule(sources.select("key"), weights, tilt), steps)
    goals = targets(sources.join(curves, "key"), max_repeats).withColumn("goal", F.floor(F.col("target") + 0.5))
    goals = cut_lineage(goals.select("key", "source_size", "target", "goal", "curve"))
    placed = running_before(rows, "key", "bucket", [F.col("h"), F.col(id_col), F.col("size")], "size", "before", extra=goals)

    def piece(copy: Column) -> Column:
        at = copy * F.col("source_size") + F.col("before")
        words = F.greatest(F.least(F.col("goal") - at, F.col("size")), F.lit(0))
        due = F.transform("curve", lambda s: s * F.col("target"))
        step = F.least(F.greatest(F.size(F.filter(due, lambda d: d <= at)), F.lit(1)), F.lit(steps))
        low, high = F.element_at(due, step), F.element_at(due, step + 1)
        return F.struct(copy.alias("copy"), ((step - 1 + F.when(high > low, (at - low) / (high - low)).otherwise(0.0)) / steps)
                        .alias("position"), words.alias("words"))

    copies = F.sequence(F.lit(0), F.greatest(F.ceil(F.lit(max_repeats)) - 1, F.lit(0)))
    pieces = F.filter(F.transform(copies, piece), lambda p: p["words"] > 0)
    return placed.withColumn("pieces", pieces).select(
        id_col, *(keep or []), "size", "source_size", "target",
        F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["words"]).alias("taken"), "pieces")


MARKS = ["__k0", "__k1"]
#: Options of tables that are written to be small.
SMALL = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def _marks(docs: DataFrame, columns: list[str]) -> list[Column]:
    """Two hashes of a row, as :data:`MARKS`."""
    return [F.xxhash64(F.lit(i), *[F.col(f"`{c}`") for c in columns]).alias(mark) for i, mark in enumerate(MARKS)]


def _plain(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows without columns of the stream's names, and the columns that can be hashed."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("mix_copy", "mix_position", "mix_words")])
    return docs, [c for c, kind in docs.dtypes if "map<" not in kind]


def _marked_plan(docs: DataFrame, weights: list[float], id_col: str, text: str, source: str, options: dict) -> DataFrame:
    docs, plain = _plain(docs)
    keyed = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text"), F.col(f"`{source}`").alias("__source"),
                        *_marks(docs, plain))
    return plan(keyed, weights, id_col="__id", text="__text", source="__source", keep=MARKS, **options)


def _stream(docs: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    docs, plain = _plain(docs)
    # Equal rows are counted with those that nothing is taken of.
    rows = rows.groupBy(*MARKS).agg(F.flatten(F.collect_list("pieces")).alias("__pieces"), F.count("*").alias("__n"))
    rows = cut_lineage(rows.filter(F.size("__pieces") > 0))
    full = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *_marks(docs, plain))
    once = full.join(rows.filter("__n = 1").drop("__n"), MARKS)
    # Of equal rows one stands for all of them.
    again = full.join(rows.filter("__n > 1").drop("__n"), MARKS).dropDuplicates(MARKS)
    out = once.unionByName(again).select("__row", F.explode("__pieces").alias("p"))
    out = out.select("__row.*", F.col("p.copy").alias("mix_copy"), F.col("p.position").alias("mix_position"), F.col("p.words").alias("mix_words"))
    order = ["mix_position", f"`{id_col}`", "mix_copy"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text: str = "text", source: str = "source",
        **options) -> DataFrame:
    """The training stream: one row per copy that is taken, in order of ``mix_position``.

    All columns of ``docs`` come back, with ``mix_copy``, ``mix_position`` and ``mix_words`` (names that ``docs`` already
    has are replaced). The whole text is kept; ``mix_words`` tells how many of its words the source still owes, which is
    less than all only for the last document of a source. Rows are range-partitioned and sorted by position, ties by id.
    The plan is made on narrow rows and meets the texts once, by a hash of the row; equal rows share their copies.
    """
    return _stream(docs, _marked_plan(docs, weights, id_col, text, source, options), id_col)


def mix_counted(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text: str = "text", source: str = "source",
                **options) -> tuple[DataFrame, DataFrame]:
    """The stream of :func:`mix`, written in its order, and a row per document with the words of it that stand there.

    Columns of the second: id, ``size``, ``source_size``, ``target``, ``taken``. Equal rows share their copies in the stream: all have
    the full ones, and the words of the last are dealt to them in turn.
    """
    planned = cut_lineage(_marked_plan(docs, weights, id_col, text, source, options).drop("taken"), **SMALL)
    # Texts are shuffled twice on the way, so that the stream is written small.
    stream = cut_lineage(_stream(docs, planned, id_col), **SMALL)
    plain, columns = _plain(stream)
    words = stream.select("mix_words", *_marks(plain, columns)).groupBy(*MARKS).agg(F.sum("mix_words").alias("words"))
    # Rows without words are never taken; hashes pass over nulls, so they are told by their size.
    rows = planned.select(F.col("__id").alias(id_col), *MARKS, "size", "source_size", "target")
    turn = W.partitionBy(*MARKS)
    filled = rows.filter("size > 0").select(
        "*", (F.row_number().over(turn.orderBy(id_col)) - 1).alias("turn"), F.count(F.lit(1)).over(turn).alias("equal"))
    filled = filled.join(words, MARKS, "left").withColumn("words", F.coalesce("words", F.lit(0)))
    full = F.expr("words div (equal * size)") * F.col("size")
    rest = F.col("words") - full * F.col("equal") - F.col("turn") * F.col("size")
    taken = full + F.greatest(F.least(rest, F.col("size")), F.lit(0))
    kept = [id_col, "size", "source_size", "target"]
    counted = filled.select(*kept, taken.cast("long").alias("taken")).unionByName(
        rows.filter("size <= 0").select(*kept, F.lit(0).cast("long").alias("taken")))
    return stream, counted
