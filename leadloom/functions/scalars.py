"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as DOUBLE, null where the bottom is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or(top: Column, bottom: Column, default: float) -> Column:
    return F.when(bottom == 0, F.lit(float(default))).otherwise(ratio(top, bottom))


def differs(left: Column, right: Column) -> Column:
    """Inequality that holds between a null and a value."""
    return ~left.eqNullSafe(right)


def matches(left: Column, right: Column) -> Column:
    """1 where both sides are known and equal, else 0."""
    return F.when(left == right, 1).otherwise(0)


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def one_value(df: DataFrame, column: str) -> Column:
    """The single value of a one-row frame, as a scalar subquery."""
    return df.select(column).scalar()


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column, so results do not hang on the order of a float sum."""
    return df.select(
        *[F.round(F.col(name), digits).alias(name) if kind == "double" else F.col(name)
          for name, kind in df.dtypes]
    )
