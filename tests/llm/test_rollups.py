"""Writers that race for a version, and writes that break off."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from leadloom.llm import rollups
from leadloom.session import fresh_path

KIND = "struct<source:string,lang:string,tokenizer:string,tokens:bigint>"
SCHEMA = f"op string, old {KIND}, new {KIND}"


def test_racing_writers_lose_no_batch_and_count_none_twice(spark):
    path = fresh_path(spark, "rollup-race")
    batch = spark.createDataFrame([("insert", None, ("a", "en", "t", 10))], SCHEMA)

    def commit(name):
        return rollups.Rollup(spark, path).commit(name, batch)

    names = ["one", "two", "three", "one"]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(commit, names))
    assert done[1] and done[2] and sorted([done[0], done[3]]) == [False, True]
    roll = rollups.Rollup(spark, path)
    assert sorted(roll.batches()) == ["one", "three", "two"] and roll.version() == 3
    assert [tuple(r) for r in roll.totals().collect()] == [("a", "en", "t", 3, 30)]


def test_a_writer_that_comes_late_is_told_and_changes_nothing(spark):
    roll = rollups.Rollup(spark, fresh_path(spark, "rollup-late"))
    batch = spark.createDataFrame([("insert", None, ("a", "en", "t", 10))], SCHEMA)
    assert roll.commit("one", batch)
    assert not roll._publish("late", batch, 0)
    with pytest.raises(Exception, match="unknown change"):
        roll.commit("broken", spark.createDataFrame([("move", None, None)], SCHEMA))
    assert roll.batches() == ["one"] and [tuple(r) for r in roll.totals().collect()] == [("a", "en", "t", 1, 10)]
