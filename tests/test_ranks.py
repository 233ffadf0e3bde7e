from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadloom.operators import metrics, ranks


def scored_frame(n: int, seed: int, hot: float = 0.0) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    score = np.round(rng.beta(1, 20, n), 4)
    score[rng.random(n) < hot] = 0.01
    return pd.DataFrame({"row_id": rng.permutation(n) * 3 + 1, "label": (rng.random(n) < 0.2 + score).astype(int),
                         "prediction": (score > 0.1).astype(int), "prob_1": score})


def in_order(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["prob_1", "row_id"], ascending=[False, True]).reset_index(drop=True)


@pytest.mark.parametrize("hot", [0.0, 0.34, 1.0])
def test_rank_is_the_row_number_of_the_sorted_frame(spark, hot):
    pdf = scored_frame(3000, 1, hot)
    ranked = ranks.rank_rows(spark.createDataFrame(pdf), "prob_1", "row_id").toPandas().sort_values("row")
    assert list(ranked["row"]) == list(range(1, len(pdf) + 1))
    assert list(ranked["row_id"]) == list(in_order(pdf)["row_id"])


def test_a_hot_score_is_split_over_many_buckets(spark):
    df = spark.createDataFrame(scored_frame(4000, 2, 0.5))
    layout = ranks.OrderedBuckets.fit(df, "prob_1", "row_id", 32)
    assert layout.hot_scores == (0.01,)
    largest = layout.place(df).groupBy("_slot").count().agg(F.max("count")).first()[0]
    assert largest < 4000 * 0.1


def test_many_hot_scores_keep_the_slots_few_and_even(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"row_id": rng.permutation(6000) + 1, "prob_1": np.where(rng.random(6000) < 0.5, 0.5, rng.integers(0, 20, 6000) / 40)})
    df = spark.createDataFrame(pdf)
    layout = ranks.OrderedBuckets.fit(df, "prob_1", "row_id", 64)
    assert len(layout.hot_scores) > 10
    sizes = [r["count"] for r in layout.place(df).groupBy("_slot").count().collect()]
    assert len(sizes) <= 4 * 64 and max(sizes) < 4 * 6000 / 64
    ranked = ranks.rank_rows(df, "prob_1", "row_id", buckets=64).toPandas().sort_values("row")
    assert list(ranked["row_id"]) == list(in_order(pdf)["row_id"])


def test_hot_score_with_keys_in_a_narrow_range(spark):
    pdf = scored_frame(3000, 3)
    pdf.loc[pdf["row_id"] > 6000, "prob_1"] = 0.5
    df = spark.createDataFrame(pdf)
    layout = ranks.OrderedBuckets.fit(df, "prob_1", "row_id", 32)
    assert layout.place(df).groupBy("_slot").count().agg(F.max("count")).first()[0] < 450
    ranked = ranks.rank_rows(df, "prob_1", "row_id").toPandas().sort_values("row")
    assert list(ranked["row_id"]) == list(in_order(pdf)["row_id"])


@pytest.mark.parametrize("k", [0, 1, 17, 1500, 2999, 3000, 5000])
def test_top_rows(spark, k):
    pdf = scored_frame(3000, 4, 0.3)
    top = ranks.top_rows(spark.createDataFrame(pdf), "prob_1", "row_id", k).toPandas()
    assert set(top["row_id"]) == set(in_order(pdf)["row_id"][:k])


def test_results_do_not_depend_on_the_number_of_partitions(spark, partitions):
    pdf = scored_frame(2000, 5, 0.3)
    found = []
    for n in (1, 4, 17):
        partitions(n)
        df = spark.createDataFrame(pdf).repartition(n)
        report = metrics.percentile_report(df).orderBy("cut").toPandas()
        edges = ranks.exact_quantiles(df, "prob_1", 20)
        found.append((report.to_dict("list"), edges))
    assert found[0] == found[1] == found[2]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6), st.none(), st.just(float("nan"))),
                min_size=1, max_size=60), st.sampled_from([1, 3, 10, 100]))
def test_quantiles_and_bins_agree_with_pandas(spark, values, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row_id long, x double")
    known = np.array([v for v in values if v is not None and v == v])
    edges = ranks.exact_quantiles(df, "x", parts)
    if len(known) == 0:
        assert edges == []
        return
    np.testing.assert_allclose(edges, np.quantile(known, np.arange(parts + 1) / parts), rtol=1e-9, atol=1e-9)
    if len(set(edges)) > 1:
        placed = ranks.QuantileBins.fit(df, "x", parts).transform(df).orderBy("row_id").toPandas()
        inner = sorted(set(edges))[1:-1]
        for value, found in zip(values, placed["bin"]):
            if value is None or value != value:
                assert pd.isna(found)
            else:
                assert found == sum(e < value for e in inner)


def test_bins_match_qcut(spark):
    pdf = scored_frame(5000, 6)
    df = spark.createDataFrame(pdf)
    ours = ranks.QuantileBins.fit(df, "prob_1", 10).transform(df).toPandas().sort_values("row_id")["bin"]
    theirs = pd.qcut(pdf.sort_values("row_id")["prob_1"], 10, labels=False, duplicates="drop")
    assert list(ours) == list(theirs)


def test_single_value_has_no_bins(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "row_id long, x double")
    assert [r["bin"] for r in ranks.QuantileBins.fit(df, "x", 10).transform(df).collect()] == [None, None]
    row = metrics.score_deciles(df.withColumn("label", F.lit(1)), metrics.Scored(score="x")).first()
    assert (row["bin"], row["ones"], row["population"], row["decile"]) == (0, 2, 2, "99.[2.00,2.00]")
    assert metrics.score_deciles(df.withColumn("label", F.lit(1)).limit(0), metrics.Scored(score="x")).count() == 0


def brute_auc(pdf: pd.DataFrame) -> float:
    pos, neg = pdf.loc[pdf.label == 1, "prob_1"].values, pdf.loc[pdf.label == 0, "prob_1"].values
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_auc_is_the_share_of_ordered_pairs(spark, hot):
    pdf = scored_frame(1500, 7, hot)
    df = spark.createDataFrame(pdf)
    auc = metrics.roc_auc(df).first()["roc_auc"]
    assert auc == pytest.approx(brute_auc(pdf))
    turned = metrics.roc_auc(df.withColumn("prob_1", -F.col("prob_1"))).first()["roc_auc"]
    assert auc + turned == pytest.approx(1.0)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 1, 0.3), (2, 1, 0.4)], "row_id long, label int, prob_1 double")
    assert metrics.roc_auc(df).first()["roc_auc"] is None


def test_roc_curve_ends_at_one_and_rises(spark):
    curve = metrics.roc_points(spark.createDataFrame(scored_frame(1000, 8))).toPandas()
    curve = curve.sort_values("threshold", ascending=False)
    assert curve.tpr.iloc[-1] == pytest.approx(1.0) and curve.fpr.iloc[-1] == pytest.approx(1.0)
    assert (curve.tpr.diff().dropna() >= 0).all() and (curve.fpr.diff().dropna() >= 0).all()


def test_percentile_report_against_a_plain_sort(spark):
    pdf = scored_frame(2345, 9, 0.4)
    report = metrics.percentile_report(spark.createDataFrame(pdf)).toPandas().set_index("cut")
    ordered = in_order(pdf)
    n, positives = len(pdf), pdf.label.sum()
    for cut, pct in [("top_1", 1), ("top_5", 5)] + [(f"decile_{i}", 10 * i) for i in range(1, 11)]:
        selected = n * pct // 100
        tp = ordered.label[:selected].sum()
        row = report.loc[cut]
        assert (row.tp, row.fp, row.fn, row.tn) == (tp, selected - tp, positives - tp, n - selected - positives + tp)
    assert report.loc["decile_10"].coverage == 1.0 and report.loc["decile_10"].lift == pytest.approx(1.0)


def test_nothing_selected_gives_minus_one(spark):
    rows = [(i, i % 2, 0, 0.1 * i) for i in range(5)]
    df = spark.createDataFrame(rows, "row_id long, label int, prediction int, prob_1 double")
    report = {r["cut"]: r for r in metrics.percentile_report(df).collect()}
    for cut in ("overall", "top_1"):
        assert report[cut]["hit_rate"] == -1 and report[cut]["lift"] == -1
    assert metrics.evaluate(df).first()["precision"] == 0


def test_several_models_share_one_pass(spark):
    pdf = scored_frame(2000, 10, 0.3)
    pdf["other"] = np.round(np.random.default_rng(0).random(len(pdf)), 3)
    df = spark.createDataFrame(pdf)
    table = metrics.compare_holdout(df, {"a": "prob_1", "b": "other"}).toPandas()
    for model, score in (("a", "prob_1"), ("b", "other")):
        alone = metrics.lift_top(df, [1, 2, 3, 4, 5], metrics.Scored(score=score)).orderBy("top_n").toPandas()
        both = table[table.model_name == model].sort_values("top_n").reset_index(drop=True)
        assert both[["top_n", "hit_rate", "coverage", "lift"]].equals(alone[["top_n", "hit_rate", "coverage", "lift"]])
    aucs = {r["model"]: r["roc_auc"] for r in metrics.roc_auc_of(df, {"a": "prob_1", "b": "other"}, "label").collect()}
    assert aucs["a"] == pytest.approx(brute_auc(pdf))
    assert aucs["b"] == pytest.approx(brute_auc(pdf.assign(prob_1=pdf.other)))


def test_deciles_keep_empty_bins_and_end_at_one(spark):
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(5)], "row_id long, label int, prob_1 double")
    table = metrics.score_deciles(df).toPandas()
    assert len(table) == 100 and table.population.sum() == 5
    best_last = table.sort_values("bin")
    assert best_last.targets_captured.iloc[0] == pytest.approx(1.0)
