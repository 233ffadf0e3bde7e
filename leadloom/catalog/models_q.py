"""Queries for preparation, feature selection, model fitting and the full runs.

A fitted model has no SQL twin. These queries do the whole fit and return what must hold for it on any engine, as numbers of
rows and flags computed from the rows; the statements count the same rows from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.catalog import fragments as sqlf
from leadloom.catalog.columns_q import AMOUNTS, RANKING_SQL, SEGMENT_SQL, TAGS_SQL, target_ranking
from leadloom.catalog.registry import Source, query
from leadloom.models import folds, learners, selection
from leadloom.models.autofit import AutoModel, auto_fit
from leadloom.operators import correlation, metrics, sampling
from leadloom.plans.cuts import KEY, CutOptions, make_cuts, with_row_key
from leadloom.plans.prepare import PanelPrep, Roles, prepare_panel
from leadloom.plans.train_score import DEFAULT_SPACES, TrainConfig, train_score
from leadloom.session import cut_lineage, fresh_path
from leadloom.sources.runlog import RunLog
from leadloom.sources.store import Store

LABEL = "target_flag"
FEATURES = ["n_orders", "sum_price", "max_price", "days_since_prev", "acctbal"]
COLS = metrics.Scored(label=LABEL, key=KEY)


def model_table(src: Source) -> DataFrame:
    """The prepared panel with an integer row key, written once.

    The panel is stored first: the preparation reads it several times, and each time would join and sort all orders again.
    """
    return cut_lineage(with_row_key(prepare_panel(cut_lineage(src("panel"))), Roles()))


def split_table(src: Source, features: list[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    table = model_table(src).select(KEY, LABEL, *features)
    train, test = sampling.train_test_split(table, KEY, 0.2, seed=42)
    return cut_lineage(learners.neighbours(train, features, KEY)), cut_lineage(test)


#: The prepared panel dealt to train and test rows.
SPLIT_SQL = f"""
keyed AS (SELECT customerseqid * 1048576 + monthyearid AS k, target_flag FROM panel),
dealt AS (SELECT *, row_number() OVER (ORDER BY {sqlf.h('k', 42)}, k) <= ceil(count(*) OVER () * 0.2) AS is_test FROM keyed),
test AS (SELECT count(*) AS n, CAST(sum(target_flag) AS BIGINT) AS positives FROM dealt WHERE is_test),
train AS (SELECT count(*) AS n, CAST(sum(target_flag) AS BIGINT) AS positives FROM dealt WHERE NOT is_test)"""


def holds(condition: Column) -> Column:
    """1 if something holds, 0 if not or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def judged(model, test: DataFrame, name: str) -> DataFrame:
    """Test rows, positives, and whether scores are probabilities, classes follow them, and measures agree with a recount."""
    scored = cut_lineage(model.predict(test))
    found = metrics.evaluate(scored, COLS).first()
    counted = scored.agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("positives"),
                         holds(F.min("prob_1") >= 0).alias("low"), holds(F.max("prob_1") <= 1).alias("high"),
                         F.avg((F.col(LABEL) == F.col("prediction")).cast("double")).alias("accuracy"),
                         holds(F.min((F.col("prob_1") > 0.5).cast("int") + F.col("prediction") != 1)).alias("classes"))
    row = counted.first()
    # The area again, from the steps of the curve.
    points = metrics.roc_points(scored, COLS)
    area = points.agg(F.sum(F.col("fpr_step") * (F.col("tpr") - F.col("tpr_step") / 2)).alias("a")).first()["a"]
    same = (area is None) == (found["roc_auc"] is None) and (area is None or abs(area - found["roc_auc"]) < 1e-9)
    return test.sparkSession.createDataFrame(
        [(name, row["n"], row["positives"], int(row["low"] and row["high"]), row["classes"],
          int(abs(row["accuracy"] - found["accuracy"]) < 1e-9), int(same))],
        "model string, n long, positives long, probabilities int, classes int, same_accuracy int, same_area int")


def judged_sql(*names: str) -> str:
    values = ", ".join(f"('{n}')" for n in names)
    return f"""WITH {SPLIT_SQL}
SELECT m.model, test.n, test.positives, 1 AS probabilities, 1 AS classes, 1 AS same_accuracy, 1 AS same_area
FROM (VALUES {values}) m(model), test"""


@query("s5_model_put_get", f"WITH {SPLIT_SQL} SELECT n, CAST(0 AS BIGINT) AS differ FROM test")
def s5(src: Source) -> DataFrame:
    """Scores of a stored and reloaded model against those of the model itself."""
    train, test = split_table(src)
    store = Store(src.spark, fresh_path(src.spark, "store"))
    fitted = learners.fit(train, "logit", FEATURES, LABEL)
    store.put_model("model_demo_logit", fitted.model, fitted.features)
    model, names = store.get_model("model_demo_logit")
    again = learners.Fitted("logit", model, names)
    both = again.predict(fitted.predict(test, "p", "c"), "q", "d")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("p") - F.col("q")) > 1e-12).alias("differ"))


@query("m5_rfe_rank", f"""
WITH {SPLIT_SQL}, pool AS (SELECT 6 + count(DISTINCT segment) FILTER (WHERE segment IN ('BUILDING', 'MACHINERY')) AS n FROM panel)
SELECT train.n AS n_train, pool.n AS features, pool.n // 2 AS first, 2 AS last, 1 AS without_gaps FROM train, pool""")
def m5(src: Source) -> DataFrame:
    """Half of the features keep rank 1, the others follow without a gap."""
    train, _test = split_table(src, [*FEATURES, "delta_price", "segment_BUILDING", "segment_MACHINERY"])
    pool = [c for c in train.columns if c not in (KEY, LABEL)]
    return selection.rfe_rank(train, pool, LABEL).agg(
        F.lit(train.count()).alias("n_train"), F.count_distinct("feature").alias("features"),
        F.count_if(F.col("ranking") == 1).alias("first"), F.max("ranking").alias("last"),
        holds(F.count_distinct("ranking") == F.max("ranking")).alias("without_gaps"))


@query("m6_rfe_select", f"""
WITH {RANKING_SQL},
chosen AS (SELECT feature FROM ranking WHERE feature <> 'days_since_prev' ORDER BY ranking LIMIT 3),
wanted(feature) AS (VALUES ('n_orders'), ('acctbal'), ('max_price'))
SELECT feature, 'selected' AS kind FROM chosen
UNION ALL SELECT feature, CASE WHEN feature IN (SELECT feature FROM chosen) THEN 'wanted_in' ELSE 'wanted_out' END FROM wanted""")
def m6(src: Source) -> DataFrame:
    found = selection.rfe_select(target_ranking(src), 3, ["n_orders", "acctbal", "max_price"], ["days_since_prev"])
    rows = [(c, "selected") for c in found.features] + [(c, "wanted_in") for c in found.wanted_in] + [
        (c, "wanted_out") for c in found.wanted_out]
    return src.spark.createDataFrame(rows, "feature string, kind string")


@query("m7_make_model_cuts", f"""
WITH {TAGS_SQL}, keyed AS (SELECT *, customerseqid * 1048576 + monthyearid AS k FROM tagged),
dealt AS (SELECT *, row_number() OVER (ORDER BY {sqlf.h('k', 42)}, k) <= ceil(count(*) OVER () * 0.3) AS is_test
  FROM keyed WHERE holdout = 0),
train AS (SELECT * FROM dealt WHERE NOT is_test),
never AS (SELECT count(DISTINCT customerseqid) AS n FROM train WHERE customerseqid NOT IN
  (SELECT customerseqid FROM train WHERE target_flag = 1)),
parts AS (SELECT 'train' AS part, (SELECT n FROM never) + sum(target_flag) AS n, sum(target_flag) AS positives FROM train
  UNION ALL SELECT 'test', count(*), sum(target_flag) FROM dealt WHERE is_test
  UNION ALL SELECT 'holdout', count(*), sum(target_flag) FROM tagged WHERE holdout = 1
  UNION ALL SELECT 'for_scoring', count(*), sum(target_flag) FROM tagged WHERE for_scoring = 1)
SELECT part, CAST(n AS BIGINT) AS n, CAST(positives AS BIGINT) AS positives, 1 AS some_features, 0 AS high_pairs FROM parts""")
def m7(src: Source) -> DataFrame:
    cuts = make_cuts(prepare_panel(src("panel")), Roles(), CutOptions(), Store(src.spark, fresh_path(src.spark, "store")))
    high = correlation.high_pairs(correlation.pearson_pairs(cuts.train.select(*cuts.features)), 0.9999).count()
    parts = {"train": cuts.train, "test": cuts.test, "holdout": cuts.holdout, "for_scoring": cuts.for_scoring}
    out = None
    for name, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("positives")).select(
            F.lit(name).alias("part"), "n", "positives", holds(F.lit(len(cuts.features) > 0)).alias("some_features"),
            F.lit(high).cast("int").alias("high_pairs"))
        out = row if out is None else out.unionByName(row)
    return out


def judged_trials(tuned: folds.Tuned, space: dict, train: DataFrame) -> DataFrame:
    """Per trial, whether all its parameters lie in their ranges and its score is an area; whether the best one was taken."""
    inside = holds(F.col("mean_score").between(0, 1) & (F.col("std_score") >= 0))
    for name, span in space.items():
        value = F.regexp_extract("params", f"'{name}': ([0-9.e-]+)", 1).cast("double")
        inside = inside * holds(value.between(span.low, span.high))
    trials = cut_lineage(tuned.trials)
    best = trials.orderBy(F.col("mean_score").desc(), "trial").first()["params"]
    return trials.select("trial", inside.alias("inside"), holds(F.lit(best == str(tuned.best_params))).alias("best_taken"),
                         F.lit(train.count()).alias("n_train"))


TRIALS_SQL = f"""WITH {SPLIT_SQL}
SELECT CAST(t.trial AS BIGINT) AS trial, 1 AS inside, 1 AS best_taken, train.n AS n_train FROM range(10) t(trial), train"""


@query("m8_tune", TRIALS_SQL)
def m8(src: Source) -> DataFrame:
    train, _test = split_table(src)
    space = DEFAULT_SPACES["forest"]
    return judged_trials(folds.tune(train, "forest", space, FEATURES, LABEL, KEY), space, train)


@query("m9_tune_folds", TRIALS_SQL)
def m9(src: Source) -> DataFrame:
    train, _test = split_table(src)
    space = {"regParam": folds.Span(0.0001, 0.1), "maxIter": folds.Span(5, 20, whole=True)}
    return judged_trials(folds.tune(train, "logit", space, FEATURES, LABEL, KEY, seed=1, guided=True), space, train)


@query("m10_calibrate", judged_sql("isotonic", "sigmoid"))
def m10(src: Source) -> DataFrame:
    train, test = split_table(src)
    out = None
    for method in ("sigmoid", "isotonic"):
        row = judged(folds.calibrate(train, "forest", FEATURES, LABEL, KEY, method), test, method)
        out = row if out is None else out.unionByName(row)
    return out


@query("m11_fit_predict", judged_sql("gbt", "forest", "logit"))
def m11(src: Source) -> DataFrame:
    train, test = split_table(src)
    out = None
    for name in ("gbt", "forest", "logit"):
        row = judged(learners.fit(train, name, FEATURES, LABEL), test, name)
        out = row if out is None else out.unionByName(row)
    return out


@query("m12_soft_vote_fit", judged_sql("vote"))
def m12_fit(src: Source) -> DataFrame:
    train, test = split_table(src)
    return judged(learners.soft_vote(train, ["gbt", "forest", "logit"], FEATURES, LABEL), test, "vote")


@query("m13_stack_check", f"""WITH {SPLIT_SQL}
SELECT c.classifier, test.n, 1 AS same_area FROM (VALUES ('gbt'), ('forest'), ('logit')) c(classifier), test""")
def m13(src: Source) -> DataFrame:
    """The areas of models scored side by side are those of each model alone."""
    train, test = split_table(src)
    models = {name: learners.fit(train, name, FEATURES, LABEL) for name in ("gbt", "forest", "logit")}
    alone = src.spark.createDataFrame(
        [(name, metrics.evaluate(cut_lineage(model.predict(test)), COLS).first()["roc_auc"]) for name, model in models.items()],
        "classifier string, alone double")
    return selection.stack_check(models, test, LABEL).join(alone, "classifier").select(
        "classifier", F.lit(test.count()).alias("n"),
        holds(F.col("roc_auc").eqNullSafe(F.col("alone")) | (F.abs(F.col("roc_auc") - F.col("alone")) < 1e-9)).alias("same_area"))


_AUTO: dict[tuple[str, str], tuple[AutoModel, DataFrame, DataFrame]] = {}


def auto_model(src: Source) -> tuple[AutoModel, DataFrame, DataFrame]:
    """The model of the three queries below, fitted once per application and folder, with its training and test rows."""
    name = (src.spark.sparkContext.applicationId, src.sf_dir)
    if name not in _AUTO:
        train, test = split_table(src)
        _AUTO[name] = auto_fit(train, FEATURES, LABEL, KEY), train, test
    return _AUTO[name]


AUTO_SQL = f"""WITH {SPLIT_SQL},
single AS (SELECT learner || '_l' || level AS model, learner AS kind, CAST(level AS INTEGER) AS stack_level
  FROM (VALUES ('gbt'), ('forest'), ('logit')) l(learner), range(2) r(level)),
models AS (SELECT * FROM single UNION ALL SELECT 'weighted_ensemble', 'weighted', 2)"""


@query("m22_auto_fit", AUTO_SQL + """
SELECT model, kind, stack_level, 1 AS scored, CASE WHEN kind = 'weighted' THEN 1 END AS best_of_all, train.n AS n_train FROM models, train""")
def m22(src: Source) -> DataFrame:
    """Every learner on both levels has a score, and the ensemble is at least as good as any of them."""
    model, train, _test = auto_model(src)
    board = model.fit_summary(src.spark)
    greatest = board.agg(F.max("score_val").alias("v")).first()["v"]
    best = F.when(F.col("kind") == "weighted", holds(F.col("score_val") >= greatest - 1e-9))
    return board.select("model", "kind", "stack_level", holds(F.col("score_val").between(0, 1)).alias("scored"),
                        best.alias("best_of_all"), F.lit(train.count()).alias("n_train"))


@query("m23_predict", judged_sql("auto"))
def m23(src: Source) -> DataFrame:
    model, _train, test = auto_model(src)
    return judged(model, test, "auto")


@query("m24_leaderboard", AUTO_SQL + """
SELECT model, kind, stack_level, 1 AS scored, 1 AS same_area, test.n AS n_test FROM models, test""")
def m24(src: Source) -> DataFrame:
    """Test scores of all models; that of the ensemble equals the area of its own predictions."""
    model, _train, test = auto_model(src)
    area = metrics.roc_auc(cut_lineage(model.predict(test)), COLS).first()["roc_auc"]
    same = holds((F.col("kind") != "weighted") | (F.abs(F.col("score_test") - F.lit(area)) < 1e-9))
    return model.leaderboard(test).select("model", "kind", "stack_level", holds(F.col("score_test").between(0, 1)).alias("scored"),
                                          same.alias("same_area"), F.lit(test.count()).alias("n_test"))


@query("m25_permutation_importance", f"""WITH {SPLIT_SQL}
SELECT feature, 1 AS difference_of_areas, test.n AS n_test FROM (VALUES {", ".join(f"('{f}')" for f in FEATURES)}) f(feature), test""")
def m25(src: Source) -> DataFrame:
    train, test = split_table(src)
    model = learners.fit(train, "logit", FEATURES, LABEL)
    found = selection.permutation_importance(model, test, FEATURES, LABEL, KEY)
    return found.select("feature", holds(F.col("importance").between(-1, 1)).alias("difference_of_areas"),
                        F.lit(test.count()).alias("n_test"))


@query("m26_regress_fit", f"""WITH {SPLIT_SQL}
SELECT 'mse' AS key, 1 AS same_error, 1 AS param_kept, test.n AS n_test FROM test""")
def m26(src: Source) -> DataFrame:
    """A logged run: its metric, parameter and model are read back, and the model read back has the logged error."""
    train, test = split_table(src)
    log = RunLog(src.spark, fresh_path(src.spark, "runs"))
    with log.start_run("sample", "forest") as run:
        run.log_param("n_estimators", 5)
        model = learners.fit_regressor(train, FEATURES, LABEL, trees=5)
        run.log_model("baseline", model, FEATURES)
        mse = learners.mean_squared_error(model.transform(test), LABEL).first()["mse"]
        run.log_metric("mse", mse)
    again, _names = log.get_model(run.run_id, "baseline")
    error = learners.mean_squared_error(again.transform(test), LABEL).first()["mse"]
    kept = log.get_params(run.run_id)
    return log.read("metrics").select("key", holds(F.abs(F.col("value") - F.lit(error)) < 1e-12).alias("same_error"),
                                      holds(F.lit(kept.get("n_estimators") == "5")).alias("param_kept"),
                                      F.lit(test.count()).alias("n_test"))


AMOUNTS_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in AMOUNTS)


@query("m27_prepare_panel", f"""
WITH {TAGS_SQL}
SELECT customerseqid, monthyearid, target_flag, n_orders, {AMOUNTS_SQL},
  coalesce(days_since_prev, (SELECT max(days_since_prev) FROM panel)) AS days_since_prev,
  CASE WHEN status = 'O' THEN 1 ELSE 0 END AS "status_O", {SEGMENT_SQL}, for_scoring, holdout FROM tagged""")
def m27(src: Source) -> DataFrame:
    return PanelPrep.fit(src("panel")).transform(src("panel"))


@query("m28_train_score", f"""
WITH {TAGS_SQL}, fresh AS (SELECT count(*) AS n FROM tagged WHERE for_scoring = 1)
SELECT model_name, CAST(top_n AS INTEGER) AS top_n, 1 AS shares, 1 AS best_named, fresh.n AS n_leads, 1 AS percentiles
FROM (VALUES ('gbt'), ('forest'), ('logit'), ('vote')) m(model_name), range(1, 6) t(top_n), fresh""")
def m28(src: Source) -> DataFrame:
    """The full run: hit rate, coverage and lift of each model at each cut, and a lead for every row to score."""
    config = TrainConfig("demo", estimators=("gbt", "forest", "logit"))
    result = train_score(src("panel"), config, Store(src.spark, fresh_path(src.spark, "store")))
    leads = result.leads.agg(F.count(F.lit(1)).alias("n"), F.min("percentile").alias("low"), F.max("percentile").alias("high")).first()
    best = metrics.best_model(result.comparison, config.reference_percentile).first()["model_name"]
    # A rate is null where its rows are missing, as on very small tables.
    rates = [F.col("hit_rate").between(0, 1), F.col("coverage").between(0, 1), F.col("lift") >= 0]
    shares = holds(F.forall(F.array(*rates), lambda x: F.coalesce(x, F.lit(True))))
    return result.comparison.select(
        "model_name", F.col("top_n").cast("int").alias("top_n"), shares.alias("shares"),
        holds(F.lit(result.best == best)).alias("best_named"), F.lit(leads["n"]).alias("n_leads"),
        holds(F.lit(leads["low"] is None or 1 <= leads["low"] <= leads["high"] <= 100)).alias("percentiles"))
