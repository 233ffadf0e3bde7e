"""Global rank, top-k, cumulative tables and exact quantile bins without a single-task sort.

Rows are split into ordered buckets whose edges come from approximate quantiles. Counts per bucket give each bucket
its offset, and only rows inside a bucket are sorted. The edges steer the balance alone: any edges give the same
result. A score that many rows share gets a bucket of its own, which is split again by the unique key.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_BUCKET = 200_000


def bucket_count(df: DataFrame) -> int:
    """Four buckets per shuffle partition, or as many as keep a bucket near ``ROWS_PER_BUCKET`` rows."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(16, 4 * partitions, df.count() // ROWS_PER_BUCKET)


def _bucketize(df: DataFrame, column: str, edges: list[float], out: str) -> DataFrame:
    """Number of edges at or below the value."""
    inner = sorted({e + 0.0 for e in edges if math.isfinite(e)})
    if not inner:
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf, *inner, math.inf]
    # Adding 0.0 turns -0.0 into 0.0, which the edge search would tell apart.
    placed = Bucketizer(splits=splits, inputCol=column, outputCol=out).transform(
        df.withColumn(column, F.col(column) + F.lit(0.0)))
    return placed.withColumn(out, F.col(out).cast("int"))


@dataclass(frozen=True)
class OrderedBuckets:
    """Bucket edges for the order (score descending, key ascending).

    ``hot`` holds the key edges of each score that fills more than one bucket: as many as it fills, so all slots
    together are at most a few times the buckets asked for.
    """

    score: str
    key: str
    score_edges: tuple[float, ...]
    hot: tuple[tuple[float, tuple[float, ...]], ...]

    @property
    def hot_scores(self) -> tuple[float, ...]:
        return tuple(score for score, _ in self.hot)

    @classmethod
    def fit(cls, df: DataFrame, score: str, key: str, buckets: int | None = None) -> OrderedBuckets:
        return cls.fit_many(df, [score], key, buckets)[score]

    @classmethod
    def fit_many(cls, df: DataFrame, scores: list[str], key: str,
                 buckets: int | None = None) -> dict[str, OrderedBuckets]:
        """Edges of several score columns from one pass, and a few more for the columns with hot scores."""
        buckets = buckets or bucket_count(df)
        values = {score: f"_s{i}" for i, score in enumerate(scores)}
        table = df.select(F.col(key).cast("double").alias("_k"),
                          *[F.col(score).cast("double").alias(v) for score, v in values.items()])
        shares = [i / buckets for i in range(1, buckets)]
        found = table.approxQuantile(list(values.values()), shares, 1.0 / (4 * buckets))
        times = {score: Counter(e + 0.0 for e in row) for score, row in zip(values, found)}
        cuts = cls._hot_key_edges(table, values, times)
        return {
            score: cls(
                score, key,
                tuple(sorted(set(counted) | {math.nextafter(s, math.inf) for s, n in counted.items() if n > 1})),
                tuple((s, cuts.get((score, s), ())) for s, n in sorted(counted.items()) if n > 1))
            for score, counted in times.items()
        }

    @staticmethod
    def _hot_key_edges(table: DataFrame, values: dict[str, str],
                       times: dict[str, Counter]) -> dict[tuple[str, float], tuple[float, ...]]:
        """Key quantiles inside each hot score, twice as many as it fills buckets at most.

        Hot scores of like weight share a pass, so there are no more passes than binary digits in the bucket number.
        """
        found: dict[tuple[str, float], tuple[float, ...]] = {}
        sizes = {n.bit_length() for counted in times.values() for n in counted.values() if n > 1}
        for size in sorted(sizes):
            rows = []
            for score, counted in times.items():
                own = [s for s, n in counted.items() if n > 1 and n.bit_length() == size]
                if own:
                    value = F.col(values[score])
                    rows.append(F.struct(F.lit(score).alias("score"), F.when(value.isin(own), value).alias("value")))
            parts = 1 << size
            cuts = (
                table.select("_k", F.inline(F.array(*rows))).filter("value is not null").groupBy("score", "value")
                .agg(F.percentile_approx("_k", [i / parts for i in range(1, parts)], F.lit(10_000)).alias("cuts")).collect()
            )
            for row in cuts:
                found[row["score"], row["value"] + 0.0] = tuple(sorted(set(row["cuts"])))
        return found

    def place(self, df: DataFrame, out: str = "_slot") -> DataFrame:
        """Add the bucket number; lower numbers come first in the order.

        The number of score edges and of key edges below a row make one whole number that rises with the order; edges
        on that number are the starts of the score buckets and, inside hot ones, their own key edges.
        """
        df = df.withColumn("_s", F.col(self.score).cast("double")).withColumn("_k", F.col(self.key).cast("double"))
        df = _bucketize(df, "_s", list(self.score_edges), "_sb")
        last = len(self.score_edges)
        if not self.hot:
            return df.withColumn(out, F.lit(last).cast("bigint") - F.col("_sb")).drop("_s", "_k", "_sb")
        keys = sorted({e + 0.0 for _, own in self.hot for e in own})
        df = _bucketize(df, "_k", keys, "_kb")
        width = len(keys) + 1
        df = df.withColumn("_c", ((F.lit(last) - F.col("_sb")) * F.lit(width) + F.col("_kb")).cast("double"))
        starts = {float(i * width) for i in range(1, last + 1)}
        for score, own in self.hot:
            start = (last - bisect_right(self.score_edges, score)) * width
            starts |= {float(start + bisect_right(keys, e)) for e in own}
        df = _bucketize(df, "_c", sorted(starts), "_place")
        return df.withColumn(out, F.col("_place").cast("bigint")).drop("_s", "_k", "_sb", "_kb", "_c", "_place")

    def order(self) -> list[Column]:
        return [F.col(self.score).desc(), F.col(self.key).asc()]


def _with_offsets(stats: DataFrame, *sums: str) -> DataFrame:
    """Running totals before each bucket. The input holds one row per bucket, a few per ``ROWS_PER_BUCKET`` rows."""
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return stats.select(
        "*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_before") for c in sums]
    )


def rank_rows(df: DataFrame, score: str, key: str, out: str = "row", buckets: int | None = None) -> DataFrame:
    """Row number 1..n by (score descending, key ascending); ``key`` must be unique and ``score`` not null."""
    layout = OrderedBuckets.fit(df, score, key, buckets)
    placed = layout.place(df)
    offsets = _with_offsets(placed.groupBy("_slot").agg(F.count(F.lit(1)).alias("n")), "n")
    inside = Window.partitionBy("_slot").orderBy(*layout.order())
    return (
        placed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets.select("_slot", "_n_before"), "_slot")
        .withColumn(out, F.col("_n_before") + F.col("_inside"))
        .drop("_slot", "_inside", "_n_before")
    )


def flag_top(df: DataFrame, score: str, key: str, k: Column | int, out: str = "in_top",
             buckets: int | None = None) -> DataFrame:
    """Mark the first ``k`` rows by (score descending, key ascending).

    Buckets wholly inside or outside the cut are decided by their number; only the one bucket with the cut is sorted.
    ``k`` may be a number or a scalar subquery.
    """
    layout = OrderedBuckets.fit(df, score, key, buckets)
    placed = layout.place(df)
    stats = _with_offsets(placed.groupBy("_slot").agg(F.count(F.lit(1)).alias("n")), "n")
    limit = k if isinstance(k, Column) else F.lit(k)
    # Slots before the one with the cut are in, those behind it are out: one row tells which it is.
    cut = stats.filter(F.col("_n_before") < limit).agg(
        F.max("_slot").alias("_cut"), F.max_by("_n_before", "_slot").alias("_n"))
    joined = placed.crossJoin(F.broadcast(cut.select("_cut", "_n")))
    at = F.col("_slot") == F.coalesce("_cut", F.lit(-1))
    whole = joined.filter(~at).withColumn(out, F.coalesce(F.col("_slot") < F.col("_cut"), F.lit(False)))
    inside = Window.partitionBy("_slot").orderBy(*layout.order())
    split = (
        joined.filter(at).withColumn("_inside", F.row_number().over(inside))
        .withColumn(out, F.col("_inside") + F.col("_n") <= limit).drop("_inside")
    )
    return whole.unionByName(split).drop("_slot", "_cut", "_n")


def top_rows(df: DataFrame, score: str, key: str, k: Column | int, buckets: int | None = None) -> DataFrame:
    """The first ``k`` rows by (score descending, key ascending)."""
    return flag_top(df, score, key, k, "_in_top", buckets).filter("_in_top").drop("_in_top")


def cut_counts_of(df: DataFrame, scores: dict[str, str], label: str, key: str, percents: list[int],
                  buckets: int | None = None) -> DataFrame:
    """Per model and top percentage: rows selected and positives among them, with the totals.

    Columns ``model, pct, selected, hits, n, positives``; ``scores`` maps a model name to its score column. All models
    share one pass, and only the buckets that hold a cut are sorted.
    """
    layouts = OrderedBuckets.fit_many(df, list(dict.fromkeys(scores.values())), key, buckets)
    base = df.select(F.col(key), F.col(label).cast("bigint").alias("_label"), *layouts)
    rows = []
    for i, (model, score) in enumerate(scores.items()):
        base = layouts[score].place(base, f"_slot{i}")
        rows.append(F.struct(F.lit(model).alias("model"), F.col(score).cast("double").alias("_score"),
                             F.col(f"_slot{i}").alias("_slot")))
    placed = base.select(F.col(key).alias("_key"), "_label", F.inline(F.array(*rows)))
    stats = placed.groupBy("model", "_slot").agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("hits"))
    # One row per model and bucket.
    before = Window.partitionBy("model").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("model")
    cuts = (
        stats.withColumn("_n_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("_total", F.sum("n").over(whole)).withColumn("positives", F.sum("hits").over(whole))
        .withColumn("pct", F.explode(F.array(*[F.lit(int(p)) for p in percents])))
        .withColumn("selected", F.floor(F.col("_total") * F.col("pct") / F.lit(100)).cast("bigint"))
        .withColumn("_room", F.col("selected") - F.col("_n_before"))
    )
    full = cuts.groupBy("model", "pct", "selected", F.col("_total").alias("n"), "positives").agg(
        F.sum(F.when(F.col("_room") >= F.col("n"), F.col("hits")).otherwise(0)).alias("hits"))
    border = cuts.filter((F.col("_room") > 0) & (F.col("_room") < F.col("n"))).select("model", "_slot", "pct", "_room")
    inside = Window.partitionBy("model", "_slot").orderBy(F.col("_score").desc(), "_key")
    part = (
        placed.join(F.broadcast(border.select("model", "_slot").distinct()), ["model", "_slot"], "left_semi")
        .withColumn("_inside", F.row_number().over(inside))
        .join(F.broadcast(border), ["model", "_slot"])
        .filter(F.col("_inside") <= F.col("_room"))
        .groupBy("model", "pct").agg(F.sum("_label").alias("_more"))
    )
    return full.join(F.broadcast(part), ["model", "pct"], "left").select(
        "model", "pct", "selected", (F.col("hits") + F.coalesce("_more", F.lit(0))).alias("hits"), "n", "positives")


def cut_counts(df: DataFrame, score: str, label: str, key: str, percents: list[int],
               buckets: int | None = None) -> DataFrame:
    """:func:`cut_counts_of` for one score column."""
    return cut_counts_of(df, {"": score}, label, key, percents, buckets).drop("model")


def _clean(column: str) -> Column:
    """The value as DOUBLE, null where it is not a number."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def cumulative_by_scores(df: DataFrame, scores: dict[str, str], label: str | None = None, descending: bool = True,
                         buckets: int | None = None) -> DataFrame:
    """One row per model and distinct score with running counts, for all models in one pass.

    ``scores`` maps a model name to its score column. Columns ``model, threshold, n, pos, cum_n, cum_pos``. Equal
    scores collapse before any ordering, so a score shared by many rows costs one row.
    """
    buckets = buckets or bucket_count(df)
    names = list(scores)
    hit = F.col(label).cast("bigint") if label else F.lit(0).cast("bigint")
    values = [f"_v{i}" for i in range(len(names))]
    base = df.select(hit.alias("_hit"), *[_clean(scores[m]).alias(v) for m, v in zip(names, values)])
    shares = [i / buckets for i in range(1, buckets)]
    edges = base.approxQuantile(values, shares, 1.0 / (4 * buckets))
    sign = -1 if descending else 1
    rows = []
    for i, (name, value) in enumerate(zip(names, values)):
        base = _bucketize(base.withColumn(f"_x{i}", F.coalesce(value, F.lit(0.0))), f"_x{i}", edges[i], f"_b{i}")
        rows.append(F.struct(F.lit(name).alias("model"), F.col(value).alias("threshold"),
                             (F.col(f"_b{i}") * sign).alias("_slot")))
    counted = (
        base.select("_hit", F.inline(F.array(*rows))).filter(F.col("threshold").isNotNull())
        .groupBy("model", "_slot", "threshold").agg(F.count(F.lit(1)).alias("n"), F.sum("_hit").alias("pos"))
    )
    return _running(counted, descending)


def _running(counted: DataFrame, descending: bool) -> DataFrame:
    """Running counts from (model, _slot, threshold, n, pos), one row per model and distinct score."""
    # One row per model and bucket.
    sizes = counted.groupBy("model", "_slot").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    before = Window.partitionBy("model").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("model", "_slot", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_before")
                                              for c in ("n", "pos")])
    order = F.col("threshold").desc() if descending else F.col("threshold").asc()
    inside = Window.partitionBy("model", "_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.withColumn("_n", F.sum("n").over(inside)).withColumn("_pos", F.sum("pos").over(inside))
        .join(offsets, ["model", "_slot"])
        .select("model", "threshold", "n", "pos", (F.col("_n") + F.col("_n_before")).alias("cum_n"),
                (F.col("_pos") + F.col("_pos_before")).alias("cum_pos"))
    )


def cumulative_by_group(df: DataFrame, group: str, score: str, label: str | None = None, descending: bool = True,
                        buckets: int | None = None) -> DataFrame:
    """:func:`cumulative_by_scores` for models that stand in rows: ``group`` names the model of a row.

    All groups share bucket edges, which steer the balance alone. ``df`` should be stored, it is read three times.
    """
    buckets = buckets or bucket_count(df)
    hit = F.col(label).cast("bigint") if label else F.lit(0).cast("bigint")
    base = df.select(F.col(group).alias("model"), hit.alias("_hit"), _clean(score).alias("threshold")).filter(
        F.col("threshold").isNotNull())
    edges = base.approxQuantile("threshold", [i / buckets for i in range(1, buckets)], 1.0 / (4 * buckets))
    placed = _bucketize(base, "threshold", edges, "_slot").withColumn("_slot", F.col("_slot") * (-1 if descending else 1))
    return _running(placed.groupBy("model", "_slot", "threshold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_hit").alias("pos")), descending)


def cumulative_by_score(df: DataFrame, score: str, label: str | None = None, descending: bool = True,
                        buckets: int | None = None) -> DataFrame:
    """:func:`cumulative_by_scores` for one score column."""
    return cumulative_by_scores(df, {"": score}, label, descending, buckets).drop("model")


def exact_quantiles_of(df: DataFrame, columns: list[str], parts: int,
                       digits: int | None = None) -> dict[str, list[float]]:
    """The ``parts + 1`` linear-interpolation quantiles of each column; no values where a column has none.

    All columns share their passes. Only the order statistics next to a quantile (at most two per quantile) reach the
    driver.
    """
    names = {column: f"c{i}" for i, column in enumerate(columns)}
    values = df.select(*[_clean(column).alias(name) for column, name in names.items()])
    totals = values.agg(*[F.count(name).alias(name) for name in names.values()]).first()
    filled = {name: name for name in names.values() if totals[name]}
    if not filled:
        return {column: [] for column in columns}
    # A row of equal values covers positions before..last; quantile i sits at position span * i / parts.
    span = F.create_map(*[F.lit(x) for name in filled for x in (name, totals[name] - 1)])[F.col("model")]
    ordered = cumulative_by_scores(values, filled, descending=False).select(
        "model", "threshold", "n", "cum_n", span.alias("span"), F.lit(parts).alias("parts"))

    def covered(side: str, first: str, final: str) -> Column:
        first_index, final_index = F.expr(first).cast("bigint"), F.expr(final).cast("bigint")
        entries = F.transform(F.sequence(first_index, final_index),
                              lambda i: F.struct(F.lit(side).alias("side"), i.alias("i")))
        none = F.array().cast("array<struct<side:string,i:bigint>>")
        return F.when(first_index <= final_index, entries).otherwise(none)

    low_side = covered("low", "IF(span = 0, 0, ((cum_n - n) * parts + span - 1) DIV greatest(span, 1))",
                       "IF(span = 0, parts, least(parts, (cum_n * parts + span - 1) DIV greatest(span, 1) - 1))")
    high_side = covered(
        "high", "IF(cum_n = n, 0, ((cum_n - n - 1) * parts) DIV greatest(span, 1) + 1)",
        "IF(cum_n - 1 = span, parts, ((cum_n - 1) * parts) DIV greatest(span, 1))")
    rows = ordered.select("model", "threshold", F.inline(F.concat(low_side, high_side))).collect()
    found = {(row["model"], row["side"], row["i"]): row["threshold"] for row in rows}
    quantiles: dict[str, list[float]] = {}
    for column, name in names.items():
        quantiles[column] = []
        for i in range(parts + 1 if name in filled else 0):
            low, high = found[name, "low", i], found[name, "high", i]
            share = ((totals[name] - 1) * i % parts) / parts
            edge = low + (high - low) * share if share < 0.5 else high - (high - low) * (1 - share)
            quantiles[column].append(edge if digits is None else round(edge, digits))
    return quantiles


def exact_quantiles(df: DataFrame, column: str, parts: int, digits: int | None = None) -> list[float]:
    """:func:`exact_quantiles_of` for one column."""
    return exact_quantiles_of(df, [column], parts, digits)[column]


@dataclass(frozen=True)
class QuantileBins:
    """Equal-frequency bins (low, high]; repeated edges are dropped."""

    column: str
    edges: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, column: str, parts: int, digits: int | None = None) -> QuantileBins:
        return cls.fit_many(df, [column], parts, digits)[column]

    @classmethod
    def fit_many(cls, df: DataFrame, columns: list[str], parts: int,
                 digits: int | None = None) -> dict[str, QuantileBins]:
        edges = exact_quantiles_of(df, columns, parts, digits)
        return {column: cls(column, tuple(sorted(set(edges[column])))) for column in columns}

    def transform(self, df: DataFrame, out: str = "bin") -> DataFrame:
        """Bin number from 0 (lowest); null where the value is null or all values are the same."""
        value = _clean(self.column)
        known = value.isNotNull()
        if len(self.edges) < 2:
            return df.withColumn(out, F.lit(None).cast("int"))
        inner = list(self.edges[1:-1])
        # Intervals closed on the right are intervals closed on the left of the negated value.
        turned = df.withColumn("_x", F.when(known, -value).otherwise(F.lit(0.0)))
        placed = _bucketize(turned, "_x", [-e for e in inner], "_above")
        return placed.withColumn(out, F.when(known, F.lit(len(inner)) - F.col("_above")).cast("int")).drop(
            "_x", "_above")
