"""Joins, set operators and keyed look-ups.

No join carries a broadcast hint unless its small side is bounded by construction; elsewhere Spark compares measured
sizes and splits skewed partitions. Null keys never match.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.scalars import as_column

SMALL_TABLE_ROWS = 10_000
ROWS_PER_TASK = 500_000


def small_side(df: DataFrame, rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Hint a broadcast after checking that the table has at most ``rows`` rows; otherwise leave it to Spark."""
    return F.broadcast(df) if len(df.select(F.lit(1)).take(rows + 1)) <= rows else df


def task_count(df: DataFrame) -> int | None:
    """Tasks among which large tables are dealt, so that none holds many more than ``ROWS_PER_TASK`` rows; None for small ones.

    ``df`` should be stored, as it is counted.
    """
    rows = df.count()
    if rows <= ROWS_PER_TASK:
        return None
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows // ROWS_PER_TASK))


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """The rows dealt by key to so many tasks (None: as Spark likes).

    Adaptive execution merges the tasks of other shuffles down to the number of cores, so that the rows of a task, and the
    memory of its sorts and hash tables, would grow with the table; a number that is given stays.
    """
    return df if tasks is None else df.repartition(tasks, *[F.col(k) for k in keys])


def by_key(df: DataFrame, tasks: int | None) -> DataFrame:
    """The other side of a join with :func:`dealt` rows: moved by key as well, not held whole by every task.

    Compressed files of a few MB pass for small ones but may hold millions of rows.
    """
    return df if tasks is None else df.hint("merge")


def distinct_projection(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def anti_rows(df: DataFrame, other: DataFrame, on: Iterable[str]) -> DataFrame:
    """Rows without a partner; a null among the partner's keys does not empty the result."""
    on = list(on)
    return df.join(other.select(*on).distinct(), on, "left_anti")


def semi_rows(df: DataFrame, other: DataFrame, on: Iterable[str]) -> DataFrame:
    on = list(on)
    return df.join(other.select(*on).distinct(), on, "left_semi")


def union_all(first: DataFrame, *more: DataFrame) -> DataFrame:
    for part in more:
        first = first.unionByName(part)
    return first


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the least by ``order``.

    An aggregate instead of a window: partial results merge before the shuffle, so a key that holds a large share of
    the rows does not land in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    order_key = F.struct(*[as_column(o).alias(f"o{i}") for i, o in enumerate(order)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order_key).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def unique_by(df: DataFrame, keys: list[str], values: list[str], what: str = "look-up table") -> DataFrame:
    """The key/value pairs of ``df``; the query fails where a key has more than one value."""
    checks = []
    for v in values:
        # A null beside a value is a second value too.
        clash = ~F.min(v).eqNullSafe(F.max(v)) | (F.count_if(F.col(v).isNull()).between(1, F.count(F.lit(1)) - 1))
        checks.append(F.when(clash, F.raise_error(F.lit(f"{what}: several values of {v} for one key")))
                      .otherwise(F.max(v)).alias(v))
    return df.groupBy(*keys).agg(*checks)


def look_up(df: DataFrame, table: DataFrame, keys: list[str], values: list[str],
            what: str = "look-up table") -> DataFrame:
    """Add values by key; the query fails on a key the table does not have or has twice with different values."""
    side = unique_by(table, keys, values, what).withColumn("_hit", F.lit(True))
    joined = df.join(side, keys, "left")
    kinds = dict(table.dtypes)
    found = [F.when(F.col("_hit").isNull(), F.raise_error(F.lit(f"{what}: key not found")).cast(kinds[v]))
             .otherwise(F.col(v)).alias(v) for v in values]
    return joined.select(*df.columns, *found)
