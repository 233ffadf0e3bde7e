"""Token counts kept up to date by signed changes.

A batch of changes (inserts, deletes, revised counts) is turned into signed rows, summed by source, language and
tokenizer version, and added to the totals. Nothing but the batch and the totals is read: the cost follows the change, not
the corpus. A batch is committed once: the new totals are written to a folder of their own, which is then renamed to the number
of the version in one step. The version names the batches it holds, a row each, so a batch that is sent again changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.session import publish_folder

KEYS = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long, batches array<string>, is_log boolean"


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows (keys, docs, tokens) of changes (op, old and new struct of source, lang, tokenizer, tokens).

    ``insert`` counts the new side, ``delete`` takes the old side back, ``revise`` does both, so a document that moves to
    another source or language is moved in the totals. Other values of ``op`` are an error. Null sources and
    languages are groups of their own; null counts are 0.
    """
    known = F.when(F.col("op").isin("insert", "delete", "revise"), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))).cast("boolean"))

    def side(name: str, sign: int) -> Column:
        fields = [F.col(f"{name}.{k}").cast("string").alias(k) for k in KEYS]
        return F.struct(*fields, F.lit(sign).cast("long").alias("docs"),
                        (sign * F.coalesce(F.col(f"{name}.tokens"), F.lit(0))).cast("long").alias("tokens"))

    sides = F.when(F.col("op") == "insert", F.array(side("new", 1))).when(
        F.col("op") == "delete", F.array(side("old", -1))).otherwise(F.array(side("old", -1), side("new", 1)))
    return changes.filter(known).select(F.explode(sides).alias("s")).select("s.*")


class Rollup:
    """Totals by source, language and tokenizer version below ``path``, one folder per version.

    A version appears whole or not at all: a write that broke off leaves a hidden folder that nothing reads. Of writers that
    race for a version one wins; the others read the new totals and try again, so each batch is counted once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, version: int) -> DataFrame | None:
        try:
            self.spark.read.text(f"{self.path}/{version:08d}/_SUCCESS")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return self.spark.read.schema(TOTALS).parquet(f"{self.path}/{version:08d}")

    def version(self) -> int:
        """The last complete version; 0 when nothing was committed."""
        high = 1
        while self._at(high) is not None:
            high *= 2
        low = high // 2
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._at(middle) is not None else (low, middle)
        return low

    def batches(self) -> list[str]:
        """Names of the committed batches in order, a short string each."""
        version = self.version()
        if not version:
            return []
        return [b for row in self._at(version).filter("is_log").orderBy("docs").select("batches").collect() for b in row[0]]

    def totals(self) -> DataFrame:
        """Rows (source, lang, tokenizer, docs, tokens); groups whose counts are all zero are left out."""
        return self._totals(self.version())

    def _totals(self, version: int) -> DataFrame:
        if not version:
            return self.spark.createDataFrame([], TOTALS).select(*KEYS, "docs", "tokens")
        return self._at(version).filter("not is_log and (docs <> 0 or tokens <> 0)").select(*KEYS, "docs", "tokens")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False, and no change, if a batch of that name is already in."""
        while not (done := self._holds(batch, version := self.version())):
            if self._publish(batch, changes, version):
                break
        return not done

    def _holds(self, batch: str, version: int) -> bool:
        return bool(version) and not self._at(version).filter("is_log").filter(
            F.array_contains("batches", F.lit(batch))).isEmpty()

    def _publish(self, batch: str, changes: DataFrame, version: int) -> bool:
        """Write the version after ``version``; False if another writer was first. The log's docs are version numbers."""
        delta = signed(changes).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        totals = self._totals(version).unionByName(delta).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        rows = totals.select("*", F.lit(None).cast("array<string>").alias("batches"), F.lit(False).alias("is_log"))
        if version:
            rows = rows.unionByName(self._at(version).filter("is_log"))
        rows = rows.unionByName(self.spark.createDataFrame([(None, None, None, version + 1, 0, [batch], True)], TOTALS))
        own = f"{self.path}/.write-{uuid.uuid4().hex}"
        rows.write.parquet(own)
        return publish_folder(self.spark, own, f"{self.path}/{version + 1:08d}")
