from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leadloom.operators import columns as cols
from leadloom.sources.store import Overtaken, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_new_version_takes_over_and_old_ones_can_go(spark, store):
    store.put("t", spark.range(3))
    before = store.get("t")
    assert values(store.put("t", spark.range(5))) == [0, 1, 2, 3, 4]
    assert store.versions("t") == [1, 2] and values(store.get("t")) == [0, 1, 2, 3, 4]
    # Who read the version before still can.
    assert values(before) == [0, 1, 2]
    store.drop_old("t")
    assert store.versions("t") == [2] and values(store.get("t")) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        store.drop_old("t", 0)


def test_a_table_can_be_made_from_itself(spark, store):
    store.put("t", spark.range(3))
    assert values(store.put("t", store.get("t").select(F.col("id") + 1))) == [1, 2, 3]


def test_a_broken_write_leaves_the_version_before(spark, store):
    store.put("t", spark.range(3))
    broken = spark.range(3).select(F.raise_error(F.concat(F.lit("lost "), F.col("id").cast("string"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.put("t", broken)
    assert store.versions("t") == [1] and values(store.get("t")) == [0, 1, 2]


def test_of_racing_writers_one_wins_and_one_is_told(spark, store):
    store.put("t", spark.range(1))

    def slow(path):
        # The other writer publishes while this one still writes.
        store.put("t", spark.range(2))
        spark.range(3).write.parquet(path)

    with pytest.raises(Overtaken):
        store.publish("t", slow)
    assert store.versions("t") == [1, 2] and values(store.get("t")) == [0, 1]


def test_lists_rankings_and_partitioned_tables(spark, store):
    store.put_list("names", ["b", "a"])
    store.put_list("names", [])
    assert store.get_list("names") == []
    ranking = spark.createDataFrame([("x", 2), ("y", 1)], "feature string, ranking long")
    assert {tuple(r) for r in store.put_ranking("r", ranking).collect()} == {("x", 2), ("y", 1)}
    table = spark.createDataFrame([(1, "a"), (2, "b")], "v int, part string")
    assert {tuple(r) for r in store.put("p", table, "part").select("v", "part").collect()} == {(1, "a"), (2, "b")}
    with pytest.raises(FileNotFoundError):
        store.get("none")


def test_few_values_equal_a_plain_count(spark):
    limit = 30
    df = spark.range(20000).select(
        "id", *[(F.col("id") % n).alias(f"m{n}") for n in (1, 2, 29, 30, 31, 32, 33, 64, 500)],
        F.when(F.col("id") % 2 == 0, F.lit("")).otherwise("x").alias("text"), F.lit(None).cast("int").alias("none"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(1.5)).alias("gaps"))
    plain = {c: df.filter(~F.isnan(c)).select(c).distinct().count() if c == "gaps" else
             df.select(c).filter(F.col(c).isNotNull()).distinct().count() for c in df.columns}
    assert cols.low_cardinality(df, df.columns, limit) == {c: n for c, n in plain.items() if n <= limit}
    # The pairs of wide columns are not counted at all.
    assert set(cols.few_values(df, df.columns, limit)) == {c for c, n in plain.items() if n <= limit}
    assert cols.low_cardinality(df.limit(0), ["id", "text"], 1) == {"id": 0, "text": 0}
    assert cols.low_cardinality(df, [], 1) == {}


def test_vocabulary_of_many_levels(spark):
    n = 100000
    df = spark.range(3 * n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 1, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("a.b"))
    vocabulary = cols.Vocabulary.fit(df, "a.b")
    levels = {r["level"]: (r["place"], r["n"]) for r in vocabulary.levels.collect()}
    assert [levels[level][0] for level in sorted(levels)] == list(range(n + 1)) and vocabulary.size == n + 1
    assert levels["hot"][1] == n
    encoded = vocabulary.transform(df, "v")
    assert encoded.columns == ["id", "a.b", "v"]
    assert {r["level"]: r["n"] for r in vocabulary.totals(encoded, "v").collect()} == {k: v[1] for k, v in levels.items()}
    row = {r["id"]: r["v"] for r in encoded.filter("id < 3").collect()}
    assert row[0].size == n + 2 and list(row[0].indices) == [levels["hot"][0]] and list(row[2].indices) == [n + 1]


def test_vocabulary_of_nothing_and_of_unknown_levels(spark):
    none = spark.createDataFrame([(1, None)], "id int, t string")
    assert list(cols.Vocabulary.fit(none, "t").transform(none, "v").first()["v"]) == [1.0]
    known = cols.Vocabulary.fit(spark.createDataFrame([("b",), ("a",), ("",)], "t string"), "t")
    other = spark.createDataFrame([("a",), ("z",), (None,), ("",)], "t string")
    assert {r["t"]: list(r["v"].toArray()) for r in known.transform(other, "v").collect()} == {
        "a": [0.0, 1.0, 0.0, 0.0], "z": [0.0, 0.0, 0.0, 1.0], None: [0.0, 0.0, 0.0, 1.0], "": [1.0, 0.0, 0.0, 0.0]}
