from __future__ import annotations

import threading
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leadloom.catalog import models_q
from leadloom.models import autofit, folds, learners, selection
from leadloom.models.autofit import auto_fit
from leadloom.operators import metrics
from leadloom.plans.cuts import CutOptions
from leadloom.plans.train_score import TrainConfig, train_score
from leadloom.sources.runlog import RunLog
from leadloom.sources.store import Store

FEATURES = ["strong", "weak", "noise"]
SCORED = metrics.Scored(label="y", key="k")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n = 600
    strong, weak = rng.normal(size=n), rng.normal(size=n)
    y = (2 * strong + 0.5 * weak + rng.normal(size=n) > 1).astype(int)
    pdf = pd.DataFrame({"k": np.arange(n), "y": y, "strong": strong, "weak": weak, "noise": rng.normal(size=n)})
    df = spark.createDataFrame(pdf).repartition(2).persist()
    yield df
    df.unpersist()


def auc(model, df) -> float:
    return metrics.roc_auc(model.predict(df), SCORED).first()["roc_auc"]


def test_elimination_keeps_the_strong_feature(data):
    ranking = selection.rfe_rank(data, FEATURES, "y", step=1, keep=1, trees=5, depth=4)
    found = {r["feature"]: r["ranking"] for r in ranking.collect()}
    assert found["strong"] == 1 and sorted(found.values()) == [1, 2, 3] and found["noise"] == 3
    half = selection.rfe_rank(data, FEATURES, "y", step=10, trees=5, depth=4).collect()
    assert sorted(r["ranking"] for r in half) == [1, 2, 2]
    chosen = selection.rfe_select(ranking, 2, ["weak", "noise"], ["strong"])
    assert (chosen.features, chosen.wanted_in, chosen.wanted_out) == (["weak", "noise"], ["weak", "noise"], [])


def test_folds_are_stratified(data):
    counts = folds.stratified_folds(data, "y", "k", 3).groupBy("y", "fold").count().toPandas()
    assert len(counts) == 6
    for _label, part in counts.groupby("y"):
        assert part["count"].max() - part["count"].min() <= 1
    rough = folds.stratified_folds(data, "y", "k", 3, exact=False).groupBy("fold").count().toPandas()
    assert rough["count"].sum() == 600 and len(rough) == 3


def test_tuning_is_repeatable_and_takes_the_best_trial(data):
    space = {"regParam": folds.Span(0.001, 1.0), "maxIter": [5, 20]}
    first = folds.tune(data, "logit", space, FEATURES, "y", "k", iterations=3, cv=2)
    again = folds.candidates(space, 3)
    trials = first.trials.toPandas()
    assert first.best_params in again and list(trials["params"]) == [str(c) for c in again]
    assert trials.loc[trials["params"] == str(first.best_params), "mean_score"].iloc[0] == trials["mean_score"].max()
    assert auc(first.best, data) > 0.85


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibration_removes_bias(data, method):
    model = folds.calibrate(data, "forest_small", FEATURES, "y", "k", method, cv=2, numTrees=3)
    row = model.predict(data).agg(F.min("prob_1"), F.max("prob_1"), F.avg("prob_1") - F.avg("y")).first()
    assert row[0] >= 0 and row[1] <= 1 and abs(row[2]) < 0.03


def test_vote_is_the_mean(data):
    vote = learners.soft_vote(data, ["forest_small", "logit"], FEATURES, "y")
    out = data
    for i, model in enumerate(vote.models):
        out = model.predict(out, f"p{i}", f"c{i}")
    both = vote.predict(out).select(F.abs(F.col("prob_1") - (F.col("p0") + F.col("p1")) / 2).alias("d"),
                                    (F.col("prediction") == (F.col("prob_1") > 0.5).cast("int")).alias("ok"))
    assert both.agg(F.max("d")).first()[0] < 1e-12 and both.filter("not ok").count() == 0


def test_importance_finds_the_strong_feature(data):
    model = learners.fit(data, "logit", FEATURES, "y")
    found = selection.permutation_importance(model, data, FEATURES, "y", "k").collect()
    assert found[0]["feature"] == "strong" and found[0]["importance"] > 0.2
    assert abs({r["feature"]: r["importance"] for r in found}["noise"]) < 0.02


def test_features_are_ranked_where_no_ranking_is_given(data):
    given = selection.rfe_rank(data, FEATURES, "y", step=1, keep=1, trees=5, depth=4)
    by_given = selection.select_features(data, FEATURES, "y", 1, ranking=given, check=["noise", "strong"])
    computed = selection.select_features(data, FEATURES, "y", 1, check=["noise", "strong"], trees=5, depth=4)
    assert computed == by_given == selection.Selected(["strong"], ["strong"], ["noise"])


def test_areas_of_groups_in_rows_equal_those_of_columns(data, spark):
    scores = data.select("y", *[(F.col(f) * 1).alias(f) for f in FEATURES])
    by_column = {r["model"]: r["roc_auc"] for r in metrics.roc_auc_of(scores, {f: f for f in FEATURES}, "y").collect()}
    rows = scores.select("y", F.inline(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("double").alias("s")) for f in FEATURES])))
    by_row = {r["model"]: r["roc_auc"] for r in metrics.roc_auc_by(rows, "f", "s", "y").collect()}
    assert by_row == pytest.approx(by_column)


def test_importance_of_many_features_by_one_transform(data):
    """300 features: the plan does not grow with them, and the strong one stands out."""
    wide = data.select("k", "y", *[(F.col("strong") if i == 7 else F.rand(i)).alias(f"x{i}") for i in range(300)])
    names = [f"x{i}" for i in range(300)]

    class OneFeature:
        def predict_vectors(self, df, score, prediction):
            return df.select(*df.columns, vector_to_array(learners.FEATURES)[7].alias(score), F.lit(0).alias(prediction))

    found = selection.permutation_importance(OneFeature(), wide, names, "y", "k").collect()
    assert found[0]["feature"] == "x7" and found[0]["importance"] > 0.2
    assert all(r["importance"] == 0 for r in found[1:])


def test_auto_fit_stacks_and_ranks(data, spark):
    model = auto_fit(data, FEATURES, "y", "k", ("forest_small", "logit"), cv=2, max_fits=8)
    board = model.leaderboard(data).toPandas()
    assert set(board["model"]) == {"forest_small_l0", "logit_l0", "forest_small_l1", "logit_l1", "weighted_ensemble"}
    summary = model.fit_summary(spark).toPandas().set_index("model")
    assert summary.loc["weighted_ensemble", "score_val"] >= summary["score_val"].max() - 1e-9
    assert auc(model, data) > 0.85
    assert model.evaluate(data, "k").first()["accuracy"] > 0.75


def test_budget_drops_the_stacked_level(data):
    model = auto_fit(data, FEATURES, "y", "k", ("logit",), cv=2, max_fits=2)
    assert len(model.levels) == 1
    with pytest.raises(ValueError):
        auto_fit(data, FEATURES, "y", "k", ("logit",), cv=3, max_fits=2)


def test_fits_of_a_level_run_side_by_side(data, monkeypatch):
    folded = data.withColumn("fold", (F.col("k") % 2).cast("int"))
    plain, meet = folds.fit, threading.Barrier(2)

    def fit(*args, **named):
        meet.wait(60)  # broken unless two fits are under way
        return plain(*args, **named)

    monkeypatch.setattr(folds, "fit", fit)
    scored, models, seconds = folds.out_of_fold(folded, {"a": "logit", "b": "forest_small"}, FEATURES, "y", 2, at_once=2)
    assert {name: [m.name for m in own] for name, own in models.items()} == {"a": ["logit"] * 2, "b": ["forest_small"] * 2}
    assert all(s > 0 for s in seconds.values())
    rows = {r["k"]: r for r in scored.collect()}
    assert len(rows) == data.count() and scored.columns == [*folded.columns, "a", "b"]
    # Each row has the score of the model that did not see its fold.
    for k in range(2):
        for name in "ab":
            own = models[name][k].predict(folded.filter(F.col("fold") == k)).collect()
            assert all(rows[r["k"]][name] == r["prob_1"] for r in own)


def test_large_fits_run_alone(data, monkeypatch):
    assert learners.side_by_side(data) == learners.FITS_SIDE_BY_SIDE
    monkeypatch.setattr(learners, "ROWS_PER_CORE_SIDE_BY_SIDE", 1)
    assert learners.side_by_side(data) == 1


def test_weights_reuse_the_areas_of_single_models(data, monkeypatch):
    calls, plain = [], autofit._auc_of
    monkeypatch.setattr(autofit, "_auc_of", lambda df, mixes, label: calls.append(1) or plain(df, mixes, label))
    names = ["strong", "weak"]
    single = plain(data, {n: F.col(n) for n in names}, "y")
    whole = autofit.greedy_weights(data, names, "y")
    turns = len(calls)
    assert autofit.greedy_weights(data, names, "y", single) == whole
    assert len(calls) == 2 * turns - 1


def test_prepared_panel_is_read_from_a_stored_one(spark, monkeypatch):
    panel = spark.createDataFrame([(i, 199801 + j, j % 2, float(i)) for i in range(4) for j in range(3)],
                                  "customerseqid long, monthyearid int, target_flag int, price double")
    seen, plain = [], models_q.prepare_panel
    monkeypatch.setattr(models_q, "prepare_panel", lambda df: seen.append(df) or plain(df))
    assert models_q.model_table(lambda name: panel).count() == 12
    assert seen[0].inputFiles() and sorted(seen[0].collect()) == sorted(panel.collect())


def test_rows_of_a_fit_lie_next_to_their_neighbours(spark, monkeypatch):
    # No task holds more than one file, so a task shows the order in which its file was written.
    rows = [(i, 199801 + j, (i + j) % 2, float(i * 7919 % 1000)) for i in range(500) for j in range(2)]
    panel = spark.createDataFrame(rows, "customerseqid long, monthyearid int, target_flag int, price double")
    train, test = models_q.split_table(lambda name: panel, ["price"])
    found = train.select("price", models_q.KEY, F.input_file_name().alias("file")).collect()
    files = {}
    for r in found:
        files.setdefault(r["file"], []).append((r["price"], r[models_q.KEY]))
    assert len(found) == 800 and test.count() == 200 and all(own == sorted(own) for own in files.values())
    frames, plain = [], autofit.out_of_fold
    monkeypatch.setattr(autofit, "out_of_fold", lambda frame, *rest: frames.append(frame) or plain(frame, *rest))
    auto_fit(train, ["price"], "target_flag", models_q.KEY, ("logit",), cv=2, max_fits=2)
    files = {}
    for r in frames[0].select("price", models_q.KEY, F.input_file_name().alias("file")).collect():
        files.setdefault(r["file"], []).append((r["price"], r[models_q.KEY]))
    assert sum(map(len, files.values())) == 800 and all(own == sorted(own) for own in files.values())


def test_automatic_fit_prepares_the_panel_once(data, spark, monkeypatch):
    made = []
    board = spark.createDataFrame([("weighted_ensemble", "weighted", 1, 0.9)],
                                  "model string, kind string, stack_level int, score_val double")
    monkeypatch.setattr(models_q, "_AUTO", {})
    monkeypatch.setattr(models_q, "split_table", lambda src: made.append(src) or (data, data.limit(1)))
    monkeypatch.setattr(models_q, "auto_fit", lambda *_: SimpleNamespace(fit_summary=lambda _: board))
    found = models_q.m22(SimpleNamespace(spark=spark, sf_dir="own")).first()
    assert len(made) == 1 and found["n_train"] == data.count()


def test_areas_side_by_side_read_stored_scores(data, monkeypatch):
    model, seen, plain = learners.fit(data, "logit", FEATURES, "y"), [], selection.roc_auc_of
    monkeypatch.setattr(selection, "roc_auc_of", lambda df, *rest: seen.append(df) or plain(df, *rest))
    areas = {r["classifier"]: r["roc_auc"] for r in selection.stack_check({"a": model, "b": model}, data, "y").collect()}
    assert areas["a"] == areas["b"] == auc(model, data) and seen[0].inputFiles()


def test_store_and_run_log_round_trip(data, spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    model = learners.fit(data, "logit", FEATURES, "y")
    store.put_model("m", model.model, model.features)
    loaded = learners.Fitted("logit", *store.get_model("m"))
    assert auc(loaded, data) == pytest.approx(auc(model, data))
    store.put_list("names", ["b", "a"])
    assert store.get_list("names") == ["b", "a"]
    with pytest.raises(ValueError):
        store.path("../other")
    log = RunLog(spark, str(tmp_path / "runs"))
    with log.start_run("e", "one") as run:
        run.log_param("n", 5)
        run.log_metric("auc", 0.5)
        run.log_model("base", model.model, FEATURES)
    with pytest.raises(RuntimeError), log.start_run("e", "two"):
        raise RuntimeError
    assert {r["run_name"]: r["status"] for r in log.read("runs").collect()} == {"one": "FINISHED", "two": "FAILED"}
    assert {r["key"] for r in log.read("params").collect()} == {"n", "model.base"}


def test_train_and_score_end_to_end(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(150):
        for m in (202001, 202002, 202003, 202004):
            x = float(rng.normal())
            rows.append((c, m, int(x + rng.normal() > 1.2), x, x + float(rng.normal()) * 0.01, float(rng.normal()),
                         None if rng.random() < 0.2 else int(rng.integers(30)), ("a", "b", None)[rng.integers(3)]))
    panel = spark.createDataFrame(
        rows, "customerseqid long, monthyearid int, target_flag int, x double, a3m_x double, z double, days_last int, kind string")
    config = TrainConfig("demo", estimators=("logit", "forest_small"), iterations=2, cv=2, calibration="sigmoid",
                         cuts=CutOptions(n_features=6, rfe_test_size=0.5, corr_threshold=0.8,
                                         rfe={"step": 2, "trees": 5, "depth": 4, "keep": 4}))
    store = Store(spark, str(tmp_path))
    result = train_score(panel, config, store)
    assert "x" in result.cuts.features and "a3m_x" not in result.cuts.features
    leads = result.leads.toPandas()
    assert len(leads) == 150 and leads["percentile"].between(1, 100).all()
    ordered = leads.sort_values("propensity", ascending=False)["percentile"]
    assert ordered.is_monotonic_increasing
    assert result.best in {"logit", "forest_small", "vote"}
    assert store.get("leads_demo").count() == 150
    assert result.comparison.count() == 15
    holdout = store.get("holdout_df_demo")
    assert holdout.select("monthyearid").distinct().count() == 2


@pytest.mark.parametrize("part", ["tune", "calibrate"])
def test_fits_have_tasks_by_rows_and_not_by_shuffle_partitions(spark, partitions, monkeypatch, part):
    """Rows in folds come from a shuffle; each of its partitions would send statistics of all nodes of a level."""
    partitions(64)
    rows = spark.range(3000).selectExpr("id k", "cast(hash(id) % 2 <> 0 as int) y", "cast(id as double) a")
    seen = []

    class Stop(Exception):
        pass

    def stop(df, *_args, **_named):
        seen.append((df.rdd.getNumPartitions(), df.count()))
        raise Stop

    monkeypatch.setattr(folds.CrossValidator, "fit", lambda _self, df: stop(df))
    monkeypatch.setattr(folds, "fit", stop)
    with pytest.raises(Stop):
        if part == "tune":
            folds.tune(rows, "forest", {"maxDepth": folds.Span(2, 3, whole=True)}, ["a"], "y", "k")
        else:
            folds.calibrate(rows, "forest", ["a"], "y", "k")
    found, n = seen[0]
    assert found == 1 and n in (2000, 3000)


def test_tasks_of_fits_follow_rows_and_cores(monkeypatch):
    def tasks(rows: int, cores: int = 12) -> int:
        session = SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=cores))
        return learners.fit_tasks(SimpleNamespace(count=lambda: rows, sparkSession=session))

    assert [tasks(n) for n in (0, 1, 50_001, 600_000, 5_000_000, 50_000_000)] == [1, 1, 2, 12, 24, 100]


def test_searched_forests_keep_nodes_and_are_the_same(data, monkeypatch):
    """Of few rows the forests of a search keep the node of every row, which does not change a tree."""
    asked = []
    real = folds.make
    monkeypatch.setattr(folds, "make", lambda *args, **params: asked.append(real(*args, **params)) or asked[-1])
    space, found = {"maxDepth": folds.Span(3, 6, whole=True), "numTrees": folds.Span(3, 5, whole=True)}, []
    for rows_per_core in (learners.ROWS_PER_CORE_SIDE_BY_SIDE, 0):
        monkeypatch.setattr(learners, "ROWS_PER_CORE_SIDE_BY_SIDE", rows_per_core)
        found.append(folds.tune(data, "forest", space, FEATURES, "y", "k", iterations=2, cv=2))
    assert [estimator.getCacheNodeIds() for estimator in asked] == [True, False]
    kept, plain = [(t.best.model.stages[-1].toDebugString.split("\n", 1)[1], t.best_params, t.trials.collect()) for t in found]
    assert kept == plain
    assert learners.node_options("logit", data) == {}
