from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from leadloom.llm import mixing

COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]
DOCS = "doc_id long, text string, source string"


def rows(n: int, equal: int) -> list[tuple]:
    own = [(i, " ".join(["w"] * (1 + i * 7 % 23)), ("a", "b", "c", None)[i % 4]) for i in range(n)]
    return [r for r in own for _ in range(equal)] + [(n, None, "a"), (n + 1, "  ", None), (None, "one two", "b")]


def test_taken_words_stand_in_the_stream(spark):
    """The counted words are those of the stream, which is in order of position, and equal those of the plan."""
    docs = spark.createDataFrame(rows(60, 1), DOCS)
    stream, counted = mixing.mix_counted(docs, [5.0, 2.0, 1.0], max_repeats=3.0)
    found = {r["doc_id"]: r["taken"] for r in counted.collect()}
    standing = {r["doc_id"]: r["n"] for r in stream.groupBy("doc_id").agg(F.sum("mix_words").alias("n")).collect()}
    assert {i: n for i, n in found.items() if n} == standing
    places = [r["mix_position"] for r in stream.orderBy("mix_position").collect()]
    assert places == sorted(places) and len(places) == stream.count() and stream.filter("text is null").count() == 0
    plan = mixing.plan(docs, [5.0, 2.0, 1.0], 3.0).select(*COLUMNS)
    assert Counter(map(tuple, counted.select(*COLUMNS).collect())) == Counter(map(tuple, plan.collect()))


def test_equal_rows_of_which_some_are_taken(spark):
    """Where the mix ends among equal rows, their words stand in the stream once."""
    for equal in (2, 3):
        docs = spark.createDataFrame(rows(12, equal), DOCS)
        stream, counted = mixing.mix_counted(docs, [5.0, 2.0, 1.0], max_repeats=3.0)
        plan = mixing.plan(docs, [5.0, 2.0, 1.0], 3.0)
        assert stream.agg(F.sum("mix_words")).first()[0] == plan.agg(F.sum("taken")).first()[0]
        assert Counter(map(tuple, counted.select(*COLUMNS).collect())) == Counter(map(tuple, plan.select(*COLUMNS).collect()))


def test_the_query_writes_the_stream(spark, tmp_path, monkeypatch):
    from leadloom.llm import queries

    spark.createDataFrame(rows(20, 1), DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    counted = mixing.mix_counted
    monkeypatch.setattr(mixing, "mix_counted", lambda *a, **k: made.append(counted(*a, **k)) or made[-1])
    assert queries.op1_mixing(spark, str(tmp_path)).count() == 23
    assert {"mix_copy", "mix_position", "mix_words", "text"} <= set(made[0][0].columns)
