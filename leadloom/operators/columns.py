"""Column-set operators: cleaning, imputation, encoding and period tags.

Steps whose result depends on the data have a ``fit`` that brings only names, levels or statistics to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.functions import names
from leadloom.functions.scalars import flag, one_value
from leadloom.session import cut_lineage

# Text that stands for a missing value.
TEXT_SENTINELS = ("NA", "NaN", "others", "missing")
MISSING_LEVEL = "missing"
EXPRESSIONS_PER_PASS = 200


def _chunks(items: list, size: int) -> list[list]:
    return [items[i:i + size] for i in range(0, len(items), size)]


def one_row(df: DataFrame, expressions: list[Column], size: int = EXPRESSIONS_PER_PASS) -> dict:
    """Evaluate many aggregates and return one dict; wide lists take several passes over their own columns."""
    found: dict = {}
    for chunk in _chunks(expressions, size):
        found.update(df.agg(*chunk).first().asDict())
    return found


def quoted(name: str) -> str:
    """A column name that may hold dots, spaces or backticks, as an expression."""
    return "`" + name.replace("`", "``") + "`"


def _columns_of(df: DataFrame, kinds: tuple[type, ...]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return _columns_of(df, (T.NumericType,))


def text_columns(df: DataFrame) -> list[str]:
    return _columns_of(df, (T.StringType,))


def _clean_float(df: DataFrame, name: str) -> Column:
    """The column with NaN read as null."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return column


# Names


def rename_spaces(df: DataFrame) -> DataFrame:
    return df.toDF(*[names.spaces_to_underscores(c) for c in df.columns])


def rename_alnum(df: DataFrame) -> DataFrame:
    renamed = [names.alnum_only(c) for c in df.columns]
    clash = names.duplicates(renamed)
    if clash:
        raise ValueError(f"renaming makes these names collide: {clash}")
    return df.toDF(*renamed)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def drop_timestamps(df: DataFrame) -> DataFrame:
    """Drop date and time columns."""
    return df.drop(*_columns_of(df, (T.TimestampType, T.TimestampNTZType, T.DateType)))


def drop_unexplained(df: DataFrame, parts: Iterable[str] = names.UNEXPLAINED_PARTS) -> DataFrame:
    return df.drop(*names.unexplained(df.columns, parts))


# Values


def bool_to_flag(df: DataFrame, source: str, out: str) -> DataFrame:
    """Replace a boolean column by a 0/1 column; null counts as 0."""
    return df.withColumn(out, flag(F.col(source))).drop(source)


def without_sentinels(df: DataFrame, name: str, words: Iterable[str] = TEXT_SENTINELS) -> Column:
    """The column with infinities, NaN and text sentinels read as null."""
    column = F.col(quoted(name))
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~(F.isnan(column) | F.abs(column).eqNullSafe(F.lit(float("inf")))), column)
    if isinstance(kind, T.StringType):
        return F.when(~column.isin(list(words)), column)
    return column


def null_sentinels(df: DataFrame, words: Iterable[str] = TEXT_SENTINELS) -> DataFrame:
    """Infinities, NaN and text sentinels become null."""
    return df.select(*[without_sentinels(df, c, words).alias(c) for c in df.columns])


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna(values)


def fill_zero(df: DataFrame) -> DataFrame:
    """Fill numeric columns with 0 and text columns with "0"."""
    return df.fillna(0).fillna("0")


def fill_statistic(column: Column, strategy: str) -> Column:
    measures = {"max": F.max, "min": F.min, "mean": F.avg}
    if strategy not in measures:
        raise ValueError(f"unknown strategy {strategy!r}")
    return measures[strategy](column)


@dataclass(frozen=True)
class StatFill:
    """Fill nulls with a statistic of the whole column."""

    values: dict[str, object] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], strategy: str = "max") -> StatFill:
        if strategy == "zeroes":
            return cls({c: 0 for c in columns})
        found = one_row(df, [fill_statistic(_clean_float(df, c), strategy).alias(c) for c in columns])
        return cls({c: v for c, v in found.items() if v is not None})

    def transform(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        out = []
        for name in df.columns:
            column = F.col(quoted(name))
            if name in self.values:
                value = self.values[name]
                # A mean in an integer column makes the column DOUBLE, so nothing is cut off.
                kind = "double" if isinstance(value, float) else kinds[name]
                column = F.coalesce(column.cast(kind), F.lit(value).cast(kind)).alias(name)
            out.append(column)
        return df.select(*out)


# Statistics that steer the column set


def distinct_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Exact number of distinct non-null values per column, one row per column."""
    columns = columns or df.columns
    out = None
    for chunk in _chunks(columns, 16):
        counted = df.agg(*[F.count_distinct(_clean_float(df, c)).alias(f"c{i}") for i, c in enumerate(chunk)])
        part = counted.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("col_name"), F.col(f"c{i}").alias("n_distinct")) for i, c in enumerate(chunk)])))
        out = part if out is None else out.unionByName(part)
    return out


def low_cardinality(df: DataFrame, columns: list[str], limit: int) -> dict[str, int]:
    """Exact distinct counts of the columns that have at most ``limit`` values.

    A sketch of the least hashes per column first finds the columns that may qualify. It is exact up to its size, which
    is above the limit, and its size does not grow with the values. Only the (column, value) pairs of those columns are
    counted then, so what is shuffled is bounded by columns x limit for each task.
    """
    near = few_values(df, columns, limit)
    if not near:
        return {}
    values = F.array(*[F.struct(F.lit(c).alias("column"), _clean_float(df, c).cast("string").alias("value")) for c in near])
    pairs = df.select(F.explode(values).alias("p")).select("p.*").filter(F.col("value").isNotNull()).distinct()
    counted = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
    # A column of nulls alone has no pair.
    found = dict.fromkeys(near, 0) | {r["column"]: r["n"] for r in counted}
    return {c: n for c, n in found.items() if n <= limit}


#: Least and greatest size of a sketch, as powers of 2.
SKETCH_SIZES = (4, 26)


def few_values(df: DataFrame, columns: list[str], limit: int) -> list[str]:
    """The columns with at most ``limit`` distinct values, by sketches; none of them is missed.

    Where hashes of different values agree, or the limit is above the greatest sketch, a column with more values may be
    among them.
    """
    size = max(SKETCH_SIZES[0], limit.bit_length())
    if not columns or size > SKETCH_SIZES[1]:
        return list(columns)
    # The letter in front keeps empty texts, which sketches pass over.
    sketches = [F.theta_sketch_agg(F.concat(F.lit("v"), _clean_float(df, c).cast("string")), size) for c in columns]
    found = one_row(df, [F.theta_sketch_estimate(s).alias(f"c{i}") for i, s in enumerate(sketches)])
    return [c for i, c in enumerate(columns) if (found[f"c{i}"] or 0) <= limit]


def is_constant(df: DataFrame, name: str) -> Column:
    """An aggregate that holds when a column has at most one distinct value."""
    value = _clean_float(df, name)
    return F.min(value).eqNullSafe(F.max(value))


def constant_columns(df: DataFrame, cutoff: int = 1, protect: Iterable[str] = ()) -> list[str]:
    """Columns with at most ``cutoff`` distinct values, the protected ones left out.

    For the usual cutoff of 1 a column qualifies when its least and greatest value agree, which needs no distinct.
    """
    columns = [c for c in df.columns if c not in set(protect)]
    if not columns:
        return []
    if cutoff > 1:
        low = low_cardinality(df, columns, cutoff)
        return [c for c in columns if c in low]
    same = one_row(df, [is_constant(df, c).alias(c) for c in columns])
    return [c for c in columns if same[c]]


def categorical_continuous(df: DataFrame, cutoff: int = 30) -> tuple[list[str], list[str]]:
    """Columns to encode (between 2 and cutoff - 1 values, or text) and numeric columns; the lists overlap."""
    low = low_cardinality(df, df.columns, cutoff - 1)
    text = set(text_columns(df))
    categorical = [c for c in df.columns if low.get(c, 0) > 1 or c in text]
    return categorical, numeric_columns(df)


def columns_with_nulls(df: DataFrame) -> list[str]:
    if not df.columns:
        return []
    found = one_row(df, [F.max(_clean_float(df, c).isNull()).alias(c) for c in df.columns])
    return [c for c in df.columns if found[c]]


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*columns_with_nulls(df))


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


# One-hot encoding


@dataclass(frozen=True)
class OneHot:
    """0/1 columns named ``column_level`` in place of text columns.

    Names that would differ in case alone from a column there is, or from one another, get a number behind them.
    """

    levels: dict[str, tuple[str, ...]]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], max_levels: int | None = None) -> OneHot:
        """Read all levels; a ``max_levels`` that a caller sets is an error for columns with more."""
        if not columns:
            return cls({})
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("level")) for c in columns])).alias("p")).select("p.*")
        rows = pairs.filter(F.col("level").isNotNull()).distinct().collect()
        levels = {c: tuple(sorted(r["level"] for r in rows if r["column"] == c)) for c in columns}
        wide = {c: len(v) for c, v in levels.items() if max_levels is not None and len(v) > max_levels}
        if wide:
            raise ValueError(f"too many levels to encode: {wide}")
        return cls(levels)

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c not in self.levels]
        taken, added = {c.lower() for c in kept}, []
        for column, values in self.levels.items():
            for level in values:
                name, number = f"{column}_{level}", 1
                while name.lower() in taken:
                    number += 1
                    name = f"{column}_{level}_{number}"
                taken.add(name.lower())
                added.append(flag(F.col(quoted(column)) == level).alias(name))
        return df.select(*[F.col(quoted(c)) for c in kept], *added)


@dataclass(frozen=True)
class Vocabulary:
    """The levels of a column of any number of levels, as a table (level, place, n): places 0, 1, ... in the order of the
    levels, and the rows of each. Only the number of levels is known to the driver.
    """

    column: str
    levels: DataFrame
    size: int

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> Vocabulary:
        """Levels go to ranges, which are stored; a level's place is the levels of earlier ranges and those before it."""
        counted = df.select(F.col(quoted(column)).cast("string").alias("level")).filter("level IS NOT NULL").groupBy(
            "level").agg(F.count(F.lit(1)).alias("n"))
        dealt = cut_lineage(counted.repartitionByRange("level").withColumn("part", F.spark_partition_id()))
        # One row per range.
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("held")).select(
            "part", "held", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
        inside = F.row_number().over(Window.partitionBy("part").orderBy("level"))
        placed = dealt.withColumn("inside", inside).join(starts, "part").select(
            "level", (F.col("start") + F.col("inside") - 1).alias("place"), "n")
        levels = cut_lineage(placed)
        return cls(column, levels, levels.count())

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """Add the sparse 0/1 vector ``out``, one place longer than the levels: rows without a level that is known have
        the last place. Columns of the names ``out``_level and ``out``_place must not be in ``df``."""
        place, level = f"{out}_place", f"{out}_level"
        known = self.levels.select(F.col("level").alias(level), F.col("place").cast("double").alias(place))
        joined = df.join(known, F.col(quoted(self.column)).cast("string") == F.col(quoted(level)), "left").drop(level)
        joined = joined.withColumn(place, F.coalesce(F.col(quoted(place)), F.lit(float(self.size))))
        if not self.size:
            return joined.withColumn(out, array_to_vector(F.array(F.lit(1.0)))).drop(place)
        encoder = OneHotEncoder(inputCol=place, outputCol=out, dropLast=False, handleInvalid="keep").fit(known)
        # The encoder names each place in the column's metadata, which would be as long as the levels.
        return encoder.transform(joined).drop(place).withMetadata(out, {})

    def totals(self, encoded: DataFrame, vector: str) -> DataFrame:
        """Rows (level, n) of a table that holds vectors of this vocabulary; places are read from the vectors."""
        held = F.explode(F.unwrap_udt(F.col(quoted(vector)))["indices"].cast("array<long>"))
        counts = encoded.select(held.alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n"))
        return self.levels.select("level", "place").join(counts, "place").select("level", "n")


def one_hot_sparse(df: DataFrame, column: str, out: str) -> tuple[DataFrame, list[str]]:
    """A :class:`Vocabulary` vector ``out`` in place of a look-up, and the levels in the order of its places as a list.

    For columns whose levels the driver can hold; beyond that use the vocabulary itself.
    """
    vocabulary = Vocabulary.fit(df, column)
    levels = [r["level"] for r in vocabulary.levels.orderBy("place").select("level").collect()]
    return vocabulary.transform(df, out), levels


# Periods


def latest_periods(df: DataFrame, time: str, n: int) -> DataFrame:
    """The ``n`` latest distinct periods, latest first."""
    return df.select(time).filter(F.col(time).isNotNull()).distinct().orderBy(F.col(time).desc()).limit(n)


def tag_latest_periods(df: DataFrame, time: str, holdout_periods: int = 2) -> DataFrame:
    """Flag rows of the latest ``holdout_periods`` periods, and of the latest one for scoring."""
    first = one_value(latest_periods(df, time, holdout_periods).agg(F.min(time).alias("edge")), "edge")
    last = one_value(df.agg(F.max(time).alias("edge")), "edge")
    return df.withColumn("for_scoring", flag(F.col(time) == last)).withColumn("holdout", flag(F.col(time) >= first))


def split_by_flags(df: DataFrame, holdout: str = "holdout", scoring: str = "for_scoring") -> dict[str, DataFrame]:
    """Hold-out, scoring and modelling rows; the scoring period is part of the hold-out."""
    return {
        "holdout": df.filter(F.col(holdout) == 1),
        "for_scoring": df.filter(F.col(scoring) == 1),
        "model": df.filter(F.col(holdout) == 0),
    }
