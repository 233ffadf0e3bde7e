"""Queries for aggregates, ranks, quantiles, sampling and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.catalog import fragments as sqlf
from leadloom.catalog.columns_q import LINES_SQL, NUMERIC, PANEL, split_lines
from leadloom.catalog.registry import Source, query
from leadloom.functions.hashing import portable_hash
from leadloom.models.folds import fold_summary, stratified_folds
from leadloom.models.learners import average_scores, mean_squared_error
from leadloom.operators import columns as cols
from leadloom.operators import correlation, metrics, ranks, relate, sampling, scoring
from leadloom.session import cut_lineage

DIGITS = 9
CORR_COLUMNS = ("n_orders", "sum_price", "max_price", "delta_price", "days_since_prev", "acctbal", "target_flag")
THRESHOLD = 0.1

# Aggregates


@query("a1_nunique_cols", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count(DISTINCT {c}) AS n_distinct FROM panel" for c in PANEL))
def a1(src: Source) -> DataFrame:
    return cols.distinct_counts(src("panel"), list(PANEL))


@query("a2_value_counts", "SELECT target_flag, count(*) AS n FROM panel GROUP BY target_flag")
def a2(src: Source) -> DataFrame:
    return src("panel").groupBy("target_flag").agg(F.count(F.lit(1)).alias("n"))


@query("a3_count_by_two_keys", """
SELECT monthyearid, target_flag, count(customerseqid) AS n FROM panel GROUP BY monthyearid, target_flag""")
def a3(src: Source) -> DataFrame:
    return sampling.counts_by_target(src("panel"), "monthyearid", "target_flag", "customerseqid")


@query("a4_pivot_sum", """
SELECT monthyearid, CAST(sum(CASE WHEN target_flag = 0 THEN 1 END) AS BIGINT) AS nonpurch_orig,
  CAST(sum(CASE WHEN target_flag = 1 THEN 1 END) AS BIGINT) AS purch_orig FROM panel GROUP BY monthyearid""")
def a4(src: Source) -> DataFrame:
    counts = sampling.counts_by_target(src("panel"), "monthyearid", "target_flag", "customerseqid")
    return sampling.pivot_target(counts, "monthyearid", "target_flag", "orig")


SAMPLED_SQL = f"""
never AS (SELECT p.*, row_number() OVER (PARTITION BY customerseqid
    ORDER BY {sqlf.h(sqlf.h('customerseqid', 5) + ' + monthyearid', 5)}, monthyearid) AS rn
  FROM panel p WHERE customerseqid NOT IN (SELECT customerseqid FROM panel WHERE target_flag = 1)),
sampled AS (SELECT customerseqid, monthyearid, target_flag FROM panel WHERE target_flag = 1
  UNION ALL SELECT customerseqid, monthyearid, target_flag FROM never WHERE rn = 1)"""

RATES_SQL = SAMPLED_SQL + """,
o AS (SELECT monthyearid, CAST(sum(CASE WHEN target_flag = 0 THEN 1 END) AS BIGINT) AS nonpurch_orig,
    CAST(sum(CASE WHEN target_flag = 1 THEN 1 END) AS BIGINT) AS purch_orig FROM panel GROUP BY monthyearid),
s AS (SELECT monthyearid, CAST(sum(CASE WHEN target_flag = 0 THEN 1 END) AS BIGINT) AS nonpurch_sampled,
    CAST(sum(CASE WHEN target_flag = 1 THEN 1 END) AS BIGINT) AS purch_sampled FROM sampled GROUP BY monthyearid),
both_rates AS (SELECT o.monthyearid, nonpurch_orig, purch_orig, nonpurch_sampled, purch_sampled,
    CAST(purch_orig AS DOUBLE) / nullif(coalesce(purch_orig, 0) + coalesce(nonpurch_orig, 0), 0) AS ro,
    CAST(purch_sampled AS DOUBLE) / nullif(coalesce(purch_sampled, 0) + coalesce(nonpurch_sampled, 0), 0) AS rs
  FROM o LEFT JOIN s ON s.monthyearid = o.monthyearid)"""


def sampled_panel(src: Source) -> DataFrame:
    panel = src("panel").select("customerseqid", "monthyearid", "target_flag")
    return sampling.downsample(panel, "customerseqid", "target_flag", "monthyearid", seed=5)


@query("a5_event_rate_compare", f"""
WITH {RATES_SQL} SELECT monthyearid, nonpurch_orig, purch_orig, nonpurch_sampled, purch_sampled,
  round(ro, 6) AS original_eventrate, round(rs, 6) AS sampled_eventrate,
  CAST(floor(rs / nullif(ro, 0)) AS INT) AS samp_lift FROM both_rates""")
def a5(src: Source) -> DataFrame:
    return sampling.compare_event_rates(src("panel"), sampled_panel(src), "monthyearid", "target_flag", "customerseqid")


BINS_SQL = sqlf.bins("scored", "prob_1", 100, "s")
BINNED_SQL = BINS_SQL + f""",
binned AS (SELECT label, {sqlf.bin_of('prob_1', 's')} AS bin FROM scored),
sums AS (SELECT bin, CAST(sum(label) AS BIGINT) AS ones, CAST(sum(1 - label) AS BIGINT) AS zeros, count(*) AS population
  FROM binned GROUP BY bin)"""


@query("a6_sum_by_bin", f"WITH {BINNED_SQL} SELECT CAST(bin AS INT) AS bin, ones, zeros, population FROM sums")
def a6(src: Source) -> DataFrame:
    return metrics.score_bins(src("scored"), digits=DIGITS).drop("decile")


@query("a7_global_stats", """
SELECT max(days_since_prev) AS greatest, min(days_since_prev) AS least, round(avg(days_since_prev), 6) AS mean FROM panel""")
def a7(src: Source) -> DataFrame:
    days = "days_since_prev"
    return src("panel").agg(F.max(days).alias("greatest"), F.min(days).alias("least"), F.avg(days).alias("mean"))


@query("a13_conditional_means", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(avg(CASE WHEN target_flag = 1 THEN {c} END), 6) AS positive_mean,
  round(avg(CASE WHEN target_flag = 0 THEN {c} END), 6) AS negative_mean,
  round(avg(CASE WHEN target_flag = 1 THEN {c} END) - avg(CASE WHEN target_flag = 0 THEN {c} END), 6) AS difference
FROM panel""" for c in (*NUMERIC, "target_flag")))
def a13(src: Source) -> DataFrame:
    return metrics.conditional_means(src("panel"), list(NUMERIC), "target_flag")


@query("a14_base_rate", "SELECT round(avg(CAST(label AS DOUBLE)), 6) AS base_rate FROM scored")
def a14(src: Source) -> DataFrame:
    return metrics.base_rate(src("scored"))


CONFUSION_SQL = """
SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
FROM scored"""


@query("a15_confusion", CONFUSION_SQL)
def a15(src: Source) -> DataFrame:
    return metrics.confusion(src("scored"))


@query("a16_hit_cov_lift", f"SELECT tn, fp, fn, tp, {sqlf.measures()} FROM ({CONFUSION_SQL})")
def a16(src: Source) -> DataFrame:
    return metrics.with_hit_coverage_lift(metrics.confusion(src("scored")))


PAIRS_SQL = "pairs AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS fea1, '{b}' AS fea2, abs(corr({a}, {b})) AS coeff FROM panel"
    for a in CORR_COLUMNS for b in CORR_COLUMNS if a != b) + ")"
HIGH_SQL = PAIRS_SQL + f""",
high AS (SELECT fea1, fea2, coeff FROM pairs WHERE coeff >= {THRESHOLD} AND coeff < 1 - 1e-12)"""


RAW_COLUMNS = ("n_orders", "sum_price", "days_since_prev", "scaled_price", "acctbal")
KNOWN_SQL = "known AS (SELECT n_orders, sum_price, days_since_prev, acctbal, CASE WHEN isfinite(scaled_price) THEN scaled_price END AS scaled_price FROM raw_panel)"
RAW_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS fea1, '{b}' AS fea2, round(abs(corr({a}, {b})), 6) AS coeff FROM known HAVING isfinite(corr({a}, {b}))"
    for a in RAW_COLUMNS for b in RAW_COLUMNS if a != b)


@query("a17_pearson_raw", f"WITH {KNOWN_SQL} {RAW_SQL}")
def a17_raw(src: Source) -> DataFrame:
    """A column with NaN and infinities: both are unknown."""
    return correlation.pearson_pairs(cols.null_sentinels(src("raw_panel").select(*RAW_COLUMNS)))


@query("a17_pearson_matrix", f"WITH {HIGH_SQL} SELECT fea1, fea2, round(coeff, 6) AS coeff FROM high")
def a17(src: Source) -> DataFrame:
    return correlation.high_pairs(correlation.pearson_pairs(src("panel"), list(CORR_COLUMNS)), THRESHOLD)


FOLDS_SQL = f"""
dealt AS (SELECT s.*, row_number() OVER (ORDER BY label, {sqlf.h('row_id', 42)}, row_id) % 3 AS fold FROM scored s),
by_fold AS (SELECT fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS score,
    avg(CAST(label AS DOUBLE)) AS positives FROM dealt GROUP BY fold)"""


@query("a18_means_of_folds", f"""
WITH {FOLDS_SQL} SELECT 'accuracy' AS measure, round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score
FROM by_fold UNION ALL SELECT 'positives', round(avg(positives), 6), round(stddev_pop(positives), 6) FROM by_fold""")
def a18(src: Source) -> DataFrame:
    folded = stratified_folds(src("scored"), "label", "row_id", 3, seed=42)
    right = F.when(F.col("label") == F.col("prediction"), 1.0).otherwise(0.0)
    scores = folded.groupBy("fold").agg(F.avg(right).alias("accuracy"), F.avg("label").alias("positives"))
    return fold_summary(scores.unpivot("fold", ["accuracy", "positives"], "measure", "score"), ["measure"])


# Ranks and quantiles


@query("w1_rank_by_score", """
SELECT row_id, round(prob_1, 6) AS prob_1, row_number() OVER (ORDER BY prob_1 DESC, row_id) AS "row" FROM scored""")
def w1(src: Source) -> DataFrame:
    return ranks.rank_rows(src("scored"), "prob_1", "row_id").select("row_id", "prob_1", "row")


@query("w2_top_pct_flag", """
WITH r AS (SELECT row_id, row_number() OVER (ORDER BY prob_1 DESC, row_id) AS rnk, count(*) OVER () AS n FROM scored)
SELECT row_id, rnk * 100 <= n * 5 AS in_top FROM r""")
def w2(src: Source) -> DataFrame:
    scored = src("scored")
    wanted = scored.agg(F.floor(F.count(F.lit(1)) * 5 / 100).alias("k")).scalar()
    return ranks.flag_top(scored, "prob_1", "row_id", wanted).select("row_id", "in_top")


DECILES = list(metrics.DECILES)


@query("w3_cum_decile_confusion", f"""
WITH {sqlf.cuts(DECILES)} SELECT pct, tn, fp, fn, tp, {sqlf.measures()} FROM cut""")
def w3(src: Source) -> DataFrame:
    return metrics.top_percent_confusion(src("scored"), DECILES)


@query("w4_qcut_labels", f"""
WITH {BINS_SQL} SELECT row_id, CAST({sqlf.bin_of('prob_1', 's')} AS INT) AS bin FROM scored""")
def w4(src: Source) -> DataFrame:
    scored = src("scored").select("row_id", "prob_1")
    return ranks.QuantileBins.fit(scored, "prob_1", 100, DIGITS).transform(scored, "bin").select("row_id", "bin")


DECILE_TABLE_SQL = BINNED_SQL + """,
spans AS (SELECT edge AS low, lead(edge) OVER (ORDER BY edge) AS high, row_number() OVER (ORDER BY edge) - 1 AS bin,
    count(*) OVER () AS edges FROM s_edges),
named AS (SELECT CAST(bin AS INT) AS bin,
    CAST(99 - bin AS VARCHAR) || '.' || CASE WHEN bin = 0 THEN '[' ELSE '(' END
    || printf('%.2f', low - CASE WHEN bin = 0 THEN 0.0001 ELSE 0 END) || ','
    || printf('%.2f', high + CASE WHEN bin = edges - 2 THEN 0.0001 ELSE 0 END) || ']' AS decile
  FROM spans WHERE high IS NOT NULL),
decile_rows AS (SELECT n.bin, n.decile, coalesce(s.ones, 0) AS ones, coalesce(s.zeros, 0) AS zeros,
    coalesce(s.population, 0) AS population FROM named n LEFT JOIN sums s ON s.bin = n.bin)"""


@query("w5_score_bins_100", f"WITH {DECILE_TABLE_SQL} SELECT bin, decile, ones, zeros, population FROM decile_rows")
def w5(src: Source) -> DataFrame:
    return metrics.score_bins(src("scored"), digits=DIGITS)


DECILE_RATES_SQL = """
SELECT bin, decile, ones, zeros, population,
  round(ones / nullif(CAST(population AS DOUBLE), 0), 6) AS target_rate,
  round(CAST(sum(ones) OVER w AS DOUBLE) / nullif(CAST(sum(population) OVER w AS DOUBLE), 0), 6) AS cumulative_target_rate,
  round(CAST(sum(ones) OVER w AS DOUBLE) / nullif(CAST(sum(ones) OVER () AS DOUBLE), 0), 6) AS targets_captured
FROM decile_rows WINDOW w AS (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query("w6_cumulative_rate", f"""
WITH {DECILE_TABLE_SQL} SELECT bin, cumulative_target_rate, targets_captured FROM ({DECILE_RATES_SQL})""")
def w6(src: Source) -> DataFrame:
    return metrics.score_deciles(src("scored"), digits=DIGITS).select("bin", "cumulative_target_rate", "targets_captured")


@query("w7_sample_one_per_key", f"""
SELECT customerseqid, monthyearid FROM (SELECT customerseqid, monthyearid, row_number() OVER (PARTITION BY customerseqid
  ORDER BY {sqlf.h(sqlf.h('customerseqid', 3) + ' + monthyearid', 3)}, monthyearid) AS rn FROM panel) WHERE rn = 1""")
def w7(src: Source) -> DataFrame:
    panel = src("panel").select("customerseqid", "monthyearid")
    return sampling.one_random_per_key(panel, "customerseqid", "monthyearid", seed=3)


PERCENTILE_SQL = f"WITH {BINS_SQL} SELECT row_id, CAST(100 - {sqlf.bin_of('prob_1', 's')} AS INT) AS percentile FROM scored"


@query("w8_percentile_best_first", PERCENTILE_SQL)
def w8(src: Source) -> DataFrame:
    scored = src("scored").select("row_id", "prob_1")
    return scoring.percentile_best_first(scored, "prob_1", "percentile", DIGITS).select("row_id", "percentile")


MODELS = {"gbt": "prob_gbt", "forest": "prob_forest", "logit": "prob_logit"}


def _holdout_sql() -> str:
    parts = []
    for name, score in MODELS.items():
        body = sqlf.cuts([1, 2, 3, 4, 5], "model_scores", score)
        for cte in ("ranked", "pcts", "cut"):
            body = body.replace(f"{cte} AS", f"{cte}_{name} AS").replace(f"{cte}(pct)", f"{cte}_{name}(pct)")
        body = body.replace("FROM ranked CROSS JOIN pcts", f"FROM ranked_{name} CROSS JOIN pcts_{name}")
        parts.append(body)
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS model_name, pct AS top_n, {sqlf.measures()} FROM cut_{name}" for name in MODELS)
    return ",".join(parts) + f", comparison AS ({union})"


HOLDOUT_SQL = _holdout_sql()


@query("w9_idxmax_model", f"""
WITH {HOLDOUT_SQL} SELECT model_name, lift FROM comparison WHERE top_n = 3 ORDER BY lift DESC, model_name LIMIT 1""")
def w9(src: Source) -> DataFrame:
    return metrics.best_model(metrics.compare_holdout(src("model_scores"), MODELS), 3)


@query("w10_roc_points", f"""
WITH {sqlf.ROC} SELECT round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM rates_by_score""")
def w10(src: Source) -> DataFrame:
    return metrics.roc_points(src("scored")).select("threshold", "fpr", "tpr")


AUC_SQL = "sum(fpr_step * (tpr - tpr_step / 2))"


@query("w11_roc_auc", f"WITH {sqlf.ROC} SELECT round({AUC_SQL}, 6) AS roc_auc FROM rates_by_score")
def w11(src: Source) -> DataFrame:
    return metrics.roc_auc(src("scored"))


@query("w12_gains_curve", f"""
WITH {sqlf.ROC} SELECT round(threshold, 6) AS threshold, round(ppr, 6) AS ppr, round(tpr, 6) AS tpr FROM rates_by_score""")
def w12(src: Source) -> DataFrame:
    return metrics.gains_curve(src("scored"))


@query("w13_lift_series", f"""
WITH {sqlf.cuts(DECILES)} SELECT CAST(pct / 10 AS INT) AS decile, lift, takeup
FROM (SELECT pct, tp AS takeup, {sqlf.measures()} FROM cut)""")
def w13(src: Source) -> DataFrame:
    return metrics.lift_series(src("scored"))


# Sampling and selection


@query("m1_train_test_split", f"""
SELECT row_id, row_number() OVER (ORDER BY {sqlf.h('row_id', 42)}, row_id) <= ceil(count(*) OVER () * 0.3) AS is_test
FROM scored""")
def m1(src: Source) -> DataFrame:
    return sampling.split_flag(src("scored"), "row_id", 0.3, seed=42).select("row_id", "is_test")


@query("m1_train_test_split_hash", f"""
SELECT row_id, {sqlf.h('row_id', 42)} < 858993459 AS is_test FROM scored""")
def m1_hash(src: Source) -> DataFrame:
    return sampling.split_flag(src("scored"), "row_id", 0.2, seed=42, exact=False).select("row_id", "is_test")


@query("m2_downsample", f"WITH {SAMPLED_SQL} SELECT customerseqid, monthyearid, target_flag FROM sampled")
def m2(src: Source) -> DataFrame:
    return sampled_panel(src)


# Cliques as lists: every pair grows by the neighbours of its second feature in name order.
CLIQUES_SQL = HIGH_SQL + """,
near AS (SELECT fea1, list_sort(list(DISTINCT fea2)) AS near FROM high GROUP BY fea1),
grown AS (SELECT list_sort(list_reduce(
    list_transform(n.near, lambda x: [x]),
    lambda have, x: CASE WHEN NOT list_contains(have, x[1]) AND list_has_all(
        k.known[x[1]], have) THEN list_concat(have, x) ELSE have END,
    [h.fea1, h.fea2])) AS members
  FROM high h JOIN near n ON n.fea1 = h.fea2
  CROSS JOIN (SELECT map_from_entries(list((fea1, near))) AS known FROM near) k),
cliques AS (SELECT DISTINCT members FROM grown),
flat AS (SELECT members AS clique, unnest(members) AS feature FROM cliques),
often AS (SELECT feature, count(*) AS cliques FROM flat GROUP BY feature),
tiers AS (SELECT f.clique, f.feature, o.cliques,
    CASE WHEN regexp_matches(f.feature, 'mob_avg_|tv_avg_|fl_avg_|bb_avg_|delta_|ratio_')
         THEN CASE WHEN starts_with(f.feature, 'delta_') OR starts_with(f.feature, 'ratio_') THEN 3 ELSE 4 END
         WHEN NOT regexp_matches(f.feature, 'a6m_|a3m_') THEN 0
         WHEN starts_with(f.feature, 'a3m_') THEN 1 ELSE 2 END AS tier
  FROM flat f JOIN often o ON o.feature = f.feature),
keep AS (SELECT DISTINCT feature FROM (SELECT feature, row_number() OVER (PARTITION BY clique
    ORDER BY tier, cliques DESC, feature) AS rn FROM tiers) WHERE rn = 1),
removed AS (SELECT DISTINCT fea1 AS feature FROM high WHERE fea1 NOT IN (SELECT feature FROM keep))"""


@query("m3_corr_filter", f"WITH {CLIQUES_SQL} SELECT feature FROM removed")
def m3(src: Source) -> DataFrame:
    panel = src("panel").select(*CORR_COLUMNS, "monthyearid")
    _high, removed = correlation.corr_filter(panel, ["monthyearid"], THRESHOLD)
    return src.spark.createDataFrame([(c,) for c in removed], "feature string")


@query("m4_trim_clusters", f"WITH {CLIQUES_SQL} SELECT feature, 'kept' AS decision FROM keep UNION ALL "
                           "SELECT feature, 'removed' FROM removed")
def m4(src: Source) -> DataFrame:
    high = cut_lineage(correlation.high_pairs(
        correlation.pearson_pairs(src("panel"), list(CORR_COLUMNS), THRESHOLD), THRESHOLD))
    return relate.union_all(
        correlation.kept_features(high).withColumn("decision", F.lit("kept")),
        correlation.trim_clusters(high).withColumn("decision", F.lit("removed")))


# Evaluation


@query("m12_soft_vote", """
SELECT row_id, round((prob_gbt + prob_forest + prob_logit) / CAST(3 AS DOUBLE), 6) AS prob_1,
  CASE WHEN (prob_gbt + prob_forest + prob_logit) / CAST(3 AS DOUBLE) > 0.5 THEN 1 ELSE 0 END AS prediction
FROM model_scores""")
def m12(src: Source) -> DataFrame:
    return average_scores(src("model_scores"), list(MODELS.values())).select("row_id", "prob_1", "prediction")


@query("m14_evaluate", f"""
WITH {sqlf.ROC}, conf AS ({CONFUSION_SQL})
SELECT round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END, 6) AS "precision",
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END, 6) AS recall,
  (SELECT round({AUC_SQL}, 6) FROM rates_by_score) AS roc_auc FROM conf""")
def m14(src: Source) -> DataFrame:
    return metrics.evaluate(src("scored"))


@query("m15_percentile_report", f"""
WITH {sqlf.cuts([1, 5, *DECILES])}, parts AS (
  SELECT 'overall' AS cut_name, tn, fp, fn, tp FROM ({CONFUSION_SQL})
  UNION ALL SELECT CASE WHEN pct < 10 THEN 'top_' || pct ELSE 'decile_' || (pct // 10) END, tn, fp, fn, tp FROM cut)
SELECT cut_name AS cut, tn, fp, fn, tp, {sqlf.measures()} FROM parts""")
def m15(src: Source) -> DataFrame:
    return metrics.percentile_report(src("scored"))


@query("m16_lift_top", f"""
WITH {sqlf.cuts([1, 2, 3, 4, 5])} SELECT pct AS top_n, {sqlf.measures()} FROM cut""")
def m16(src: Source) -> DataFrame:
    return metrics.lift_top(src("scored"), [1, 2, 3, 4, 5])


@query("m17_score_deciles", f"WITH {DECILE_TABLE_SQL} {DECILE_RATES_SQL}")
def m17(src: Source) -> DataFrame:
    return metrics.score_deciles(src("scored"), digits=DIGITS)


@query("m18_feature_direction", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(avg(CASE WHEN target_flag = 1 THEN {c} END), 6) AS positive_mean,
  round(avg(CASE WHEN target_flag = 0 THEN {c} END), 6) AS negative_mean,
  round(avg(CASE WHEN target_flag = 1 THEN {c} END) - avg(CASE WHEN target_flag = 0 THEN {c} END), 6) AS difference
FROM panel""" for c in ("max_price", "n_orders", "target_flag")))
def m18(src: Source) -> DataFrame:
    return metrics.feature_direction(src("panel"), ["max_price", "n_orders", "acctbal"], 2, "target_flag")


@query("m19_holdout_compare", f"WITH {HOLDOUT_SQL} SELECT model_name, top_n, hit_rate, coverage, lift FROM comparison")
def m19(src: Source) -> DataFrame:
    return metrics.compare_holdout(src("model_scores"), MODELS)


CUSTOMER_BINS = sqlf.bins("customer_scores", "prob_1", 100, "c")


@query("m20_score_leads", f"""
WITH {CUSTOMER_BINS} SELECT customerseqid, round(prob_1, 6) AS propensity,
  CAST(100 - {sqlf.bin_of('prob_1', 'c')} AS INT) AS percentile FROM customer_scores""")
def m20(src: Source) -> DataFrame:
    return scoring.score_leads(src("customer_scores"), digits=DIGITS)


@query("m21_split_leads", LINES_SQL)
def m21(src: Source) -> DataFrame:
    return split_lines(src)


@query("m26_regress_mse", """
SELECT round(avg((label - prob_1) * (label - prob_1)), 6) AS mse FROM scored""")
def m26(src: Source) -> DataFrame:
    return mean_squared_error(src("scored"), "label", "prob_1")


@query("hash_draw", f"SELECT o_orderkey, {sqlf.h('o_orderkey', 11)} AS draw FROM orders")
def hash_draw(src: Source) -> DataFrame:
    return src("orders").select("o_orderkey", portable_hash("o_orderkey", 11).alias("draw"))
