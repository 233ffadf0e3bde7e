from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from leadloom.operators import columns as cols
from leadloom.operators import relate, sampling, scoring
from leadloom.plans.prepare import PanelPrep, Roles, prepare_panel


def test_renaming_fails_on_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a-b"])
    assert cols.rename_spaces(df).columns == ["a_b", "a-b"]
    with pytest.raises(ValueError):
        cols.rename_alnum(df)


def test_sentinels_become_null(spark):
    rows = [(1.0, "x"), (float("inf"), "NA"), (float("-inf"), "others"), (float("nan"), "NaN"), (None, None), (2.0, "missing")]
    found = cols.null_sentinels(spark.createDataFrame(rows, "x double, t string")).collect()
    assert [tuple(r) for r in found] == [(1.0, "x"), (None, None), (None, None), (None, None), (None, None), (2.0, None)]


def test_constant_columns_ignore_nulls_and_nan(spark):
    rows = [(1, None, 1.0, "a", 1), (1, None, float("nan"), None, 2), (1, None, None, "a", 3)]
    df = spark.createDataFrame(rows, "c int, n int, f double, t string, v int")
    assert cols.constant_columns(df) == ["c", "n", "f", "t"]
    assert cols.constant_columns(df, protect=["c"]) == ["n", "f", "t"]
    assert cols.constant_columns(df, cutoff=3) == ["c", "n", "f", "t", "v"]


def test_categorical_and_continuous_overlap(spark):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("five"), F.lit(1).alias("one"), F.lit("x").alias("t"))
    categorical, continuous = cols.categorical_continuous(df, 30)
    assert categorical == ["five", "t"] and continuous == ["id", "five", "one"]


@pytest.mark.parametrize(("strategy", "value"), [("max", 5.0), ("min", 1.0), ("mean", 3.0), ("zeroes", 0.0)])
def test_stat_fill(spark, strategy, value):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,)], "days_x double")
    found = cols.StatFill.fit(df, ["days_x"], strategy).transform(df).collect()
    assert [r[0] for r in found] == [1.0, 5.0, value]


def test_mean_of_an_integer_column_is_not_cut_off(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "days_x int")
    assert cols.StatFill.fit(df, ["days_x"], "mean").transform(df).collect()[2][0] == 1.5


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        cols.StatFill.fit(spark.createDataFrame([(1,)], "days_x int"), ["days_x"], "median")


def test_one_hot_limits_levels(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    wide = cols.OneHot.fit(df, ["t"]).transform(df)
    assert wide.columns == ["t_a", "t_b"] and [tuple(r) for r in wide.collect()] == [(1, 0), (0, 1), (0, 0)]
    with pytest.raises(ValueError):
        cols.OneHot.fit(df, ["t"], max_levels=1)


def test_one_hot_of_awkward_levels(spark):
    rows = [(i, 202001 + i % 3, i % 2, level) for i, level in enumerate(["U.S.", "a", "A", "x y", "b`c", "U.S.", None])]
    panel = spark.createDataFrame(rows, "customerseqid long, monthyearid int, target_flag int, `home.land` string")
    out = prepare_panel(panel).orderBy("customerseqid")
    added = ["home.land_A", "home.land_U.S.", "home.land_a_2", "home.land_b`c", "home.land_x y"]
    assert [c for c in out.columns if c.startswith("home.land_")] == added
    found = [tuple(r)[-5:] for r in out.collect()]
    assert found == [(0, 1, 0, 0, 0), (0, 0, 1, 0, 0), (1, 0, 0, 0, 0), (0, 0, 0, 0, 1), (0, 0, 0, 1, 0), (0, 1, 0, 0, 0),
                     (0, 0, 0, 0, 0)]


def test_one_hot_of_thousands_of_levels(spark):
    df = spark.range(6000).select((F.col("id") % 3000).cast("string").alias("t"))
    encoded, levels = cols.one_hot_sparse(df, "t", "v")
    assert len(levels) == 3000 and encoded.columns == ["t", "v"]
    first = encoded.first()
    assert first["v"].indices.tolist() == [levels.index(first["t"])] and first["v"].size == 3001
    assert len(cols.OneHot.fit(df, ["t"]).levels["t"]) == 3000


def test_scoring_period_is_part_of_the_holdout(spark):
    df = spark.createDataFrame([(202001,), (202002,), (202003,), (None,)], "monthyearid int")
    rows = {r["monthyearid"]: (r["for_scoring"], r["holdout"]) for r in cols.tag_latest_periods(df, "monthyearid", 2).collect()}
    assert rows == {202001: (0, 0), 202002: (0, 1), 202003: (1, 1), None: (0, 0)}


def test_bool_flag_counts_null_as_zero(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "churn boolean")
    assert [r[0] for r in cols.bool_to_flag(df, "churn", "churn_flag").collect()] == [1, 0, 0]


def test_panel_is_prepared_in_order(spark):
    rows = [(1, 202001, 0, 7, None, "NA", datetime.datetime(2020, 1, 1), 1.0, 9, float("inf")),
            (2, 202002, 1, 7, 4, "b", datetime.datetime(2020, 1, 1), None, 9, 2.0),
            (3, 202003, 0, 8, 6, "c", None, 3.0, 9, 3.0)]
    schema = ("customerseqid long, monthyearid int, target_flag int, hid int, days_since int, kind string, "
              "seen timestamp, wealth double, same int, other_amount double")
    out = prepare_panel(spark.createDataFrame(rows, schema), Roles(), holdout_periods=1)
    assert out.columns == ["customerseqid", "monthyearid", "target_flag", "days_since", "wealth", "for_scoring",
                           "holdout", "kind_b", "kind_c"]
    found = [tuple(r) for r in out.orderBy("customerseqid").collect()]
    assert found[0] == (1, 202001, 0, 6, 1.0, 0, 0, 0, 0)
    assert found[1] == (2, 202002, 1, 4, 0.0, 0, 0, 1, 0)
    assert found[2] == (3, 202003, 0, 6, 3.0, 1, 1, 0, 1)


def test_a_fitted_preparation_applies_to_new_rows(spark):
    schema = "customerseqid long, monthyearid int, target_flag int, days_since int, kind string"
    old = spark.createDataFrame([(1, 202001, 0, 3, "a"), (2, 202002, 1, 5, "b")], schema)
    new = spark.createDataFrame([(3, 202003, 0, None, "z")], schema)
    out = PanelPrep.fit(old).transform(new).first()
    assert (out["days_since"], out["kind_a"], out["kind_b"]) == (5, 0, 0)


def test_anti_rows_survive_a_null_partner(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r["k"] for r in relate.anti_rows(left, right, ["k"]).collect()] == [2]


def test_look_up_fails_on_misses_and_clashes(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, v int")
    assert {tuple(r) for r in relate.look_up(df, table, ["k"], ["v"]).collect()} == {("a", 1), ("b", 2)}
    for bad in ([("a", 1)], [("a", 1), ("b", 2), ("b", 3)], [("a", 1), ("b", 2), ("b", None)]):
        with pytest.raises(Exception, match="key not found|several values"):
            relate.look_up(df, spark.createDataFrame(bad, "k string, v int"), ["k"], ["v"]).collect()


def test_first_per_key_on_a_hot_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 0).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("v"))
    out = relate.first_per_key(df, ["k"], ["v"])
    assert out.filter("k = 0").first()["v"] == -14_999 and out.count() == 5001


def test_split_is_a_partition_of_exact_size(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    train, test = sampling.train_test_split(df, "k", 0.3, seed=1)
    train_keys, test_keys = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert len(test_keys) == 301 and not train_keys & test_keys and len(train_keys | test_keys) == 1001
    assert test_keys == {r[0] for r in sampling.train_test_split(df, "k", 0.3, seed=1)[1].collect()}
    assert test_keys != {r[0] for r in sampling.train_test_split(df, "k", 0.3, seed=2)[1].collect()}


def test_downsampling_keeps_purchases_and_one_row_per_other_customer(spark):
    rows = [(c, m, int(c % 4 == 0 and m == 3)) for c in range(40) for m in range(6)]
    df = spark.createDataFrame(rows, "c long, m long, t int")
    out = sampling.downsample(df, "c", "t", "m").toPandas()
    assert len(out) == 40 and out.c.is_unique and (out[out.c % 4 == 0].t == 1).all()
    # Months differ between customers: the draw hangs on the customer too.
    assert out[out.c % 4 != 0].m.nunique() > 2
    table = sampling.compare_event_rates(df, sampling.downsample(df, "c", "t", "m"), "m", "t", "c").toPandas()
    assert len(table) == 6 and table.loc[table.m == 3, "original_eventrate"].iloc[0] == 0.25


def test_no_purchasers(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 0), (2, 1, 0)], "c long, m long, t int")
    assert sampling.downsample(df, "c", "t", "m").count() == 2
    table = sampling.compare_event_rates(df, df, "m", "t", "c").collect()
    assert all(r["samp_lift"] is None for r in table)


def test_sample_is_exact_and_bounded(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    assert sampling.sample_n(df, "k", 200).count() == 200
    assert sampling.sample_n(df, "k", 900).count() == 500


def test_a_lead_can_count_for_both_lines(spark):
    leads = spark.createDataFrame([(1, 0.5), (2, 0.4), (3, 0.3), (4, 0.2)], "customerseqid long, propensity double")
    base = spark.createDataFrame([(1, 202007, 1, 1, 0), (2, 202007, 0, 0, 1), (3, 202007, 0, 0, 0), (4, 202006, 1, 0, 0)],
                                 "customerseqid long, monthyearid int, prod_held_g_only int, prod_held_l_only int, prod_held_l_and_g int")
    out = {(r["customerseqid"], r["line"]) for r in scoring.split_by_line(leads, base, 202007).collect()}
    assert out == {(1, "G"), (1, "L"), (2, "L")}
