"""A training corpus from ``documents``: language, recurring lines, near duplicates, source mix, token ids."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import bytebpe, langmix, minmax, mixing, templates
from leadloom.session import MADE_PATHS, cut_lineage, remove_paths

#: Texts whose main language has a smaller part than this are rejected.
LEAST_SHARE = 0.3
#: Weights that sources take in turn; they tilt over the course of training.
WEIGHTS, TILT, REPEATS = [5.0, 2.0, 1.0], 0.5, 3.0
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


_LAST_TABLES: dict[str, list[str]] = {}


def stage(work):
    """A stage that first deletes the working tables of the stage before it.

    What a stage returns is written before the next one is called, so nothing reads those tables any more.
    """
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        remove_paths(spark, _LAST_TABLES.pop(application, []))
        before = set(MADE_PATHS)
        result = work(spark, docs, sf_dir)
        _LAST_TABLES[application] = [p for p in MADE_PATHS if p not in before]
        return result

    return run_stage


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without a letter and those in which no language has a fair part."""
    model = langmix.fit(docs)
    rows = langmix.predict(docs, model, out="__lang", out_score="__share")
    return rows.filter((F.col("__lang") != "und") & (F.col("__share") >= LEAST_SHARE)).select(*docs.columns)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines whose templates recur across documents; the number of characters follows the text."""
    rows = templates.drop_recurring(docs)
    return rows.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by shingles of five words."""
    return minmax.keep_one(docs, k=5, percent=80).select(*docs.columns)


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents to the sources' weights, repeated where a source is short, in training order.

    The last copy that a source gives is taken whole if it is due for half of its words or more.
    """
    rows = mixing.mix(docs, WEIGHTS, max_repeats=REPEATS, tilt=TILT)
    due = F.col("mix_words") * 2 >= mixing.word_count(F.col("text"))
    return rows.filter(due).select(*docs.columns)


@stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives its bytes back."""
    path = public_tokenizers.path(VOCABULARY)
    rows = bytebpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    rows = bytebpe.decode(rows, path)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixture),
    ("byte-level BPE", token_ids),
]

#: Token ids are beyond SQL; the stages are tested against plain versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
