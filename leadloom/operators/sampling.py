"""Seeded splits and samples; every draw is a hash of a unique integer key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.hashing import HASH_RANGE, portable_hash
from leadloom.functions.scalars import one_value, ratio
from leadloom.operators.ranks import flag_top, top_rows
from leadloom.operators.relate import anti_rows, first_per_key


def _with_draw(df: DataFrame, key: str, seed: int) -> DataFrame:
    # The least hash comes first, so the order is by the negated draw.
    return df.withColumn("_draw", -portable_hash(key, seed))


def split_flag(df: DataFrame, key: str, test_size: float, seed: int = 42, exact: bool = True) -> DataFrame:
    """Add ``is_test``. Exact: ceil(n * test_size) rows. Otherwise each row by its own hash, without a shuffle."""
    if not exact:
        return df.withColumn("is_test", portable_hash(key, seed) < int(test_size * HASH_RANGE))
    share = round(test_size * 10_000)
    total = one_value(df.agg(F.count(F.lit(1)).alias("n")), "n")
    wanted = F.ceil(total * F.lit(share) / F.lit(10_000)).cast("bigint")
    return flag_top(_with_draw(df, key, seed), "_draw", key, wanted, "is_test").drop("_draw")


def train_test_split(df: DataFrame, key: str, test_size: float, seed: int = 42,
                     exact: bool = True) -> tuple[DataFrame, DataFrame]:
    flagged = split_flag(df, key, test_size, seed, exact)
    return flagged.filter(~F.col("is_test")).drop("is_test"), flagged.filter("is_test").drop("is_test")


def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by hash order; the trial-run sample."""
    return top_rows(_with_draw(df, key, seed), "_draw", key, n).drop("_draw")


def one_random_per_key(df: DataFrame, key: str, tie: str, seed: int = 0) -> DataFrame:
    """One row per key by a hash of key and ``tie``; ``tie`` is an integer that is unique within the key."""
    draw = portable_hash(portable_hash(key, seed) + F.col(tie), seed)
    return first_per_key(df, [key], [draw, tie])


def downsample(df: DataFrame, customer: str, target: str, tie: str, seed: int = 0) -> DataFrame:
    """All purchase rows, and one row for each customer who never purchased."""
    bought = df.filter(F.col(target) == 1)
    others = anti_rows(df, bought, [customer])
    return bought.unionByName(one_random_per_key(others, customer, tie, seed))


def counts_by_target(df: DataFrame, stratum: str, target: str, customer: str) -> DataFrame:
    """Rows with a customer, per stratum and target."""
    return df.groupBy(stratum, target).agg(F.count(customer).alias("n"))


def pivot_target(counts: DataFrame, stratum: str, target: str, suffix: str) -> DataFrame:
    """Target values as columns; a missing cell stays null."""
    return counts.groupBy(stratum).pivot(target, [0, 1]).agg(F.sum("n")).select(
        stratum, F.col("0").alias(f"nonpurch_{suffix}"), F.col("1").alias(f"purch_{suffix}"))


def compare_event_rates(before: DataFrame, after: DataFrame, stratum: str, target: str, customer: str) -> DataFrame:
    """Event rates per stratum before and after sampling, with their ratio cut to an integer."""
    old = pivot_target(counts_by_target(before, stratum, target, customer), stratum, target, "orig")
    new = pivot_target(counts_by_target(after, stratum, target, customer), stratum, target, "sampled")
    joined = old.join(new, stratum, "left")
    out = joined
    for suffix, name in (("orig", "original"), ("sampled", "sampled")):
        bought, rest = F.col(f"purch_{suffix}"), F.col(f"nonpurch_{suffix}")
        total = F.coalesce(bought, F.lit(0)) + F.coalesce(rest, F.lit(0))
        out = out.withColumn(f"{name}_eventrate", ratio(bought, total))
    lift = ratio(F.col("sampled_eventrate"), F.col("original_eventrate"))
    return out.withColumn("samp_lift", lift.cast("int"))
