"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder on any file system the cluster can reach."""
    return spark.read.parquet(path)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Pass a schema where it is known: inferring types reads the data twice."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def sink_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def sink_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and without a row index."""
    df.write.mode("overwrite").option("header", True).csv(path)


def sink_lines(leads: DataFrame, path: str, run_date: str, line: str = "line") -> None:
    """One CSV folder per business line below a dated path, in one pass."""
    leads.write.mode("overwrite").option("header", True).partitionBy(line).csv(f"{path.rstrip('/')}/{run_date}")


def read_lines(spark: SparkSession, path: str, run_date: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(f"{path.rstrip('/')}/{run_date}")


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*[F.col(c) for c in order]).limit(n)
