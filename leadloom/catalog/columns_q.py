"""Queries for sources, sinks and column-set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.catalog import fragments as sqlf
from leadloom.catalog.registry import Source, query
from leadloom.functions import names
from leadloom.functions.scalars import differs, one_value
from leadloom.models.selection import top_features
from leadloom.operators import columns as cols
from leadloom.operators import metrics, relate, sampling, scoring
from leadloom.operators.correlation import pearson_pairs
from leadloom.session import fresh_path
from leadloom.sources import tables
from leadloom.sources.runlog import RunLog
from leadloom.sources.store import Store

PANEL = ("customerseqid", "monthyearid", "target_flag", "n_orders", "sum_price", "max_price", "delta_price", "const_col",
         "days_since_prev", "status", "segment", "acctbal")
AMOUNTS = ("sum_price", "max_price", "delta_price", "acctbal")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
NUMERIC = ("n_orders", "sum_price", "max_price", "delta_price", "days_since_prev", "acctbal")


def _plain(column: str) -> str:
    return f"round({column}, 6) AS {column}" if column in AMOUNTS else column


def without(*dropped: str) -> str:
    return ", ".join(_plain(c) for c in PANEL if c not in dropped)


PANEL_SQL = without()


# Sources and sinks


@query("s1_scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders")
def s1(src: Source) -> DataFrame:
    return tables.scan_parquet(src.spark, f"{src.sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("s2_scan_csv", "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer")
def s2(src: Source) -> DataFrame:
    path = fresh_path(src.spark, "csv")
    customer = src("customer")
    tables.sink_csv(customer, path)
    return tables.scan_csv(src.spark, path, customer.schema)


@query("s3_sink_csv", "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier")
def s3(src: Source) -> DataFrame:
    path = fresh_path(src.spark, "csv")
    tables.sink_csv(src("supplier"), path)
    return tables.scan_csv(src.spark, path)


@query("s4_dataset_put_get", f"SELECT {PANEL_SQL} FROM panel")
def s4(src: Source) -> DataFrame:
    store = Store(src.spark, fresh_path(src.spark, "store"))
    return store.put("training_demo", src("panel"), partition_by="monthyearid").select(*PANEL)


@query("s6_list_put_get", """
SELECT row_number() OVER (ORDER BY name) AS position, name AS value FROM (
  SELECT DISTINCT 'segment_' || segment AS name FROM panel
  UNION SELECT DISTINCT 'status_' || status FROM panel WHERE status IS NOT NULL)""")
def s6(src: Source) -> DataFrame:
    store = Store(src.spark, fresh_path(src.spark, "store"))
    levels = cols.OneHot.fit(src("panel"), ["segment", "status"]).levels
    store.put_list("levels", sorted(f"{c}_{v}" for c, values in levels.items() for v in values))
    return store.get("levels").select((F.col("position") + 1).alias("position"), "value")


def target_ranking(src: Source) -> DataFrame:
    """Features ranked by their correlation with the target: a ranking that Spark derives from the panel."""
    pairs = pearson_pairs(src("panel"), ["target_flag", *NUMERIC])
    # As many rows as there are features.
    order = F.row_number().over(Window.orderBy(F.round("coeff", 9).desc(), F.col("fea1")))
    return pairs.filter(F.col("fea2") == "target_flag").select(F.col("fea1").alias("feature"), order.alias("ranking"))


RANKING_SQL = """
scores AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, target_flag)) AS r FROM panel" for c in NUMERIC) + """),
ranking AS (SELECT feature, row_number() OVER (ORDER BY round(r, 9) DESC, feature) AS ranking FROM scores)"""


@query("s7_ranking_csv", f"WITH {RANKING_SQL} SELECT feature, CAST(ranking AS INT) AS ranking FROM ranking")
def s7(src: Source) -> DataFrame:
    return Store(src.spark, fresh_path(src.spark, "store")).put_ranking("feat_rfe", target_ranking(src))


@query("s8_run_log", f"""
WITH {sqlf.ROC}
SELECT 'base_rate' AS key, round(avg(CAST(label AS DOUBLE)), 6) AS value FROM scored
UNION ALL SELECT 'roc_auc', round(sum(fpr_step * (tpr - tpr_step / 2)), 6) FROM rates_by_score""")
def s8(src: Source) -> DataFrame:
    log = RunLog(src.spark, fresh_path(src.spark, "runs"))
    scored = src("scored")
    with log.start_run("demo", "holdout") as run:
        run.log_param("dataset", "scored")
        run.log_metric("base_rate", metrics.base_rate(scored).first()["base_rate"])
        run.log_metric("roc_auc", metrics.roc_auc(scored).first()["roc_auc"])
    return log.read("metrics").join(log.read("runs").filter(F.col("status") == "FINISHED"), "run_id", "left_semi").select(
        "key", "value")


LINES_SQL = """
SELECT s.customerseqid, round(s.prob_1, 6) AS propensity, 'G' AS line FROM customer_scores s
JOIN base_flags b ON b.customerseqid = s.customerseqid WHERE b.monthyearid = 199807 AND b.prod_held_g_only = 1
UNION ALL
SELECT s.customerseqid, round(s.prob_1, 6), 'L' FROM customer_scores s
JOIN base_flags b ON b.customerseqid = s.customerseqid
WHERE b.monthyearid = 199807 AND (b.prod_held_l_and_g = 1 OR b.prod_held_l_only = 1)"""


def split_lines(src: Source) -> DataFrame:
    leads = src("customer_scores").select("customerseqid", F.col("prob_1").alias("propensity"))
    return scoring.split_by_line(leads, src("base_flags"), 199807)


@query("s9_split_csv_sink", LINES_SQL)
def s9(src: Source) -> DataFrame:
    path = fresh_path(src.spark, "lines")
    tables.sink_lines(split_lines(src), path, "2020-07-01")
    return tables.read_lines(src.spark, path, "2020-07-01", "customerseqid bigint, propensity double, line string")


@query("s10_sample_n", f"""
SELECT o_orderkey, o_custkey FROM orders ORDER BY {sqlf.h('o_orderkey', 7)}, o_orderkey LIMIT 200""")
def s10(src: Source) -> DataFrame:
    return sampling.sample_n(src("orders").select("o_orderkey", "o_custkey"), "o_orderkey", 200, seed=7)


# Names


@query("p1_clean_names_space", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def p1(src: Source) -> DataFrame:
    spaced = src("orders").select("o_orderkey", "o_custkey", "o_orderstatus").toDF("o orderkey", "o custkey", "o orderstatus")
    return cols.rename_spaces(spaced)


@query("p2_clean_names_alnum", "SELECT o_orderkey AS o_orderkey, o_custkey AS cust_id__main_ FROM orders")
def p2(src: Source) -> DataFrame:
    return cols.rename_alnum(src("orders").select("o_orderkey", "o_custkey").toDF("o-orderkey", "cust id (main)"))


@query("p3_bool_flag", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS churn_flag
FROM orders""")
def p3(src: Source) -> DataFrame:
    churn = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 200000)
    return cols.bool_to_flag(src("orders").select("o_orderkey", churn.alias("churn")), "churn", "churn_flag")


@query("p4_drop_cols", f"SELECT {without('customerseqid', 'monthyearid', 'target_flag')} FROM panel")
def p4(src: Source) -> DataFrame:
    return cols.drop_columns(src("panel"), ["customerseqid", "monthyearid", "target_flag"])


@query("p5_drop_by_type", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderpriority FROM orders""")
def p5(src: Source) -> DataFrame:
    return cols.drop_timestamps(src("orders"))


def encoded_status(src: Source) -> DataFrame:
    filled = src("panel").select("customerseqid", "monthyearid", "status").fillna("missing", subset=["status"])
    return cols.OneHot.fit(filled, ["status"]).transform(filled)


@query("p6_drop_by_name", """
SELECT customerseqid, monthyearid, CASE WHEN status = 'O' THEN 1 ELSE 0 END AS "status_O" FROM panel""")
def p6(src: Source) -> DataFrame:
    return cols.drop_unexplained(encoded_status(src))


@query("p7_match_cols", """
SELECT 'customerseqid' AS col_name, count(customerseqid) AS n FROM panel
UNION ALL SELECT 'monthyearid', count(monthyearid) FROM panel
UNION ALL SELECT 'days_since_prev', count(days_since_prev) FROM panel""")
def p7(src: Source) -> DataFrame:
    panel = src("panel")
    found = names.matching(panel.columns, ["seqid", "yearid", "^days_"])
    counts = panel.agg(*[F.count(c).alias(c) for c in found])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("n")) for c in found])))


DISTINCT_SQL = " UNION ALL ".join(f"SELECT '{c}' AS col_name, count(DISTINCT {c}) AS n_distinct FROM panel" for c in PANEL)


@query("p8_zero_variance", f"SELECT col_name FROM ({DISTINCT_SQL}) WHERE n_distinct <= 1")
def p8(src: Source) -> DataFrame:
    found = cols.constant_columns(src("panel"))
    return src.spark.createDataFrame([(c,) for c in found], "col_name string")


@query("p9_cat_cont_split", f"""
SELECT col_name, 'categorical' AS kind FROM ({DISTINCT_SQL})
WHERE (n_distinct > 1 AND n_distinct < 30) OR col_name IN ('status', 'segment')
UNION ALL SELECT col_name, 'continuous' FROM ({DISTINCT_SQL}) WHERE col_name NOT IN ('status', 'segment')""")
def p9(src: Source) -> DataFrame:
    categorical, continuous = cols.categorical_continuous(src("panel"), 30)
    rows = [(c, "categorical") for c in categorical] + [(c, "continuous") for c in continuous]
    return src.spark.createDataFrame(rows, "col_name string, kind string")


# Values


@query("p10_null_sentinels", """
SELECT customerseqid, monthyearid, CASE WHEN status IN ('NA', 'NaN', 'others', 'missing') THEN NULL ELSE status END AS status,
  CASE WHEN isinf(scaled_price) OR isnan(scaled_price) THEN NULL ELSE round(scaled_price, 6) END AS scaled_price
FROM raw_panel""")
def p10(src: Source) -> DataFrame:
    return cols.null_sentinels(src("raw_panel").select("customerseqid", "monthyearid", "status", "scaled_price"))


@query("p11_fill_const", """
SELECT customerseqid, agentseqid, usecase, round(coalesce(wpi, 0), 6) AS wpi,
  round(coalesce(days_underserved, 9999), 6) AS days_underserved FROM leads_master""")
def p11(src: Source) -> DataFrame:
    leads = src("leads_master").select("customerseqid", "agentseqid", "usecase", "wpi", "days_underserved")
    return cols.fill_constants(leads, {"wpi": 0.0, "days_underserved": 9999.0})


@query("p12_fill_stat", """
SELECT customerseqid, monthyearid,
  coalesce(days_since_prev, (SELECT max(days_since_prev) FROM panel)) AS by_max,
  coalesce(days_since_prev, (SELECT min(days_since_prev) FROM panel)) AS by_min,
  round(coalesce(CAST(days_since_prev AS DOUBLE), (SELECT avg(days_since_prev) FROM panel)), 6) AS by_mean,
  coalesce(days_since_prev, 0) AS by_zeroes
FROM panel""")
def p12(src: Source) -> DataFrame:
    out = src("panel").select("customerseqid", "monthyearid", *[F.col("days_since_prev").alias(f"by_{s}")
                                                            for s in ("max", "min", "mean", "zeroes")])
    for strategy in ("max", "min", "mean", "zeroes"):
        out = cols.StatFill.fit(out, [f"by_{strategy}"], strategy).transform(out)
    return out


@query("p13_drop_null_cols", f"SELECT {without('days_since_prev', 'status')} FROM panel")
def p13(src: Source) -> DataFrame:
    return cols.drop_null_columns(src("panel"))


@query("p14_drop_null_rows", f"SELECT {PANEL_SQL} FROM panel WHERE days_since_prev IS NOT NULL AND status IS NOT NULL")
def p14(src: Source) -> DataFrame:
    return cols.drop_null_rows(src("panel"), ["days_since_prev", "status"])


SEGMENT_SQL = ", ".join(f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS \"segment_{s}\"" for s in SEGMENTS)


@query("p15_one_hot", f"SELECT customerseqid, monthyearid, {SEGMENT_SQL} FROM panel")
def p15(src: Source) -> DataFrame:
    panel = src("panel").select("customerseqid", "monthyearid", "segment")
    return cols.OneHot.fit(panel, ["segment"]).transform(panel)


TAGS_SQL = """
tagged AS (SELECT p.*,
  CASE WHEN monthyearid IN (SELECT monthyearid FROM panel GROUP BY 1 ORDER BY 1 DESC LIMIT 1) THEN 1 ELSE 0 END
    AS for_scoring,
  CASE WHEN monthyearid IN (SELECT monthyearid FROM panel GROUP BY 1 ORDER BY 1 DESC LIMIT 2) THEN 1 ELSE 0 END
    AS holdout FROM panel p)"""


@query("p16_tag_latest_periods", f"WITH {TAGS_SQL} SELECT customerseqid, monthyearid, for_scoring, holdout FROM tagged")
def p16(src: Source) -> DataFrame:
    return cols.tag_latest_periods(src("panel").select("customerseqid", "monthyearid"), "monthyearid", 2)


@query("p17_split_by_flag", f"""
WITH {TAGS_SQL}
SELECT 'holdout' AS part, customerseqid, monthyearid FROM tagged WHERE holdout = 1
UNION ALL SELECT 'for_scoring', customerseqid, monthyearid FROM tagged WHERE for_scoring = 1
UNION ALL SELECT 'model', customerseqid, monthyearid FROM tagged WHERE holdout = 0""")
def p17(src: Source) -> DataFrame:
    tagged = cols.tag_latest_periods(src("panel").select("customerseqid", "monthyearid"), "monthyearid", 2)
    parts = cols.split_by_flags(tagged)
    return relate.union_all(*[df.select(F.lit(name).alias("part"), "customerseqid", "monthyearid")
                              for name, df in parts.items()])


@query("p18_row_predicates", """
SELECT customerseqid, agentseqid, usecase FROM leads_master
WHERE (customertype IN ('notorphan', 'partialorphan') OR underservedflag = 'Y')
  AND wpi IS DISTINCT FROM 0 AND NOT (days_underserved IS NULL AND channel = 'orphan')""")
def p18(src: Source) -> DataFrame:
    attached = F.col("customertype").isin("notorphan", "partialorphan") | (F.col("underservedflag") == "Y")
    return src("leads_master").filter(
        attached & differs(F.col("wpi"), F.lit(0.0))
        & ~(F.col("days_underserved").isNull() & (F.col("channel") == "orphan"))
    ).select("customerseqid", "agentseqid", "usecase")


MEANS_SQL = "means AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) AS mean FROM panel" for c in NUMERIC) + ")"


@query("p19_top_feature_projection", f"""
WITH {RANKING_SQL}, {MEANS_SQL}
SELECT m.feature, round(m.mean, 6) AS mean FROM means m JOIN ranking r ON r.feature = m.feature WHERE r.ranking <= 3""")
def p19(src: Source) -> DataFrame:
    chosen = [r["feature"] for r in top_features(target_ranking(src), 3).collect()]
    means = src("panel").select(*chosen).agg(*[F.avg(c).alias(c) for c in chosen])
    return means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean")) for c in chosen])))


@query("p20_id_reattach", """
SELECT round(max_price, 6) AS max_price, n_orders, customerseqid, monthyearid, target_flag FROM panel""")
def p20(src: Source) -> DataFrame:
    return src("panel").select("max_price", "n_orders", *("customerseqid", "monthyearid", "target_flag"))


# Sort and limit


@query("t1_top_n_distinct", "SELECT DISTINCT monthyearid FROM panel ORDER BY monthyearid DESC LIMIT 3")
def t1(src: Source) -> DataFrame:
    return cols.latest_periods(src("panel"), "monthyearid", 3)


@query("t2_sort_ranking", f"WITH {RANKING_SQL} SELECT feature, CAST(ranking AS INT) AS ranking FROM ranking ORDER BY ranking")
def t2(src: Source) -> DataFrame:
    return target_ranking(src).orderBy("ranking", "feature")


@query("t3_top_n_features", f"""
WITH {RANKING_SQL} SELECT feature, CAST(ranking AS INT) AS ranking FROM ranking
WHERE feature NOT IN ('max_price') ORDER BY ranking LIMIT 3""")
def t3(src: Source) -> DataFrame:
    return top_features(target_ranking(src), 3, exclude=["max_price"])


@query("t4_sort_propensity", """
SELECT customerseqid, round(prob_1, 6) AS propensity FROM customer_scores ORDER BY prob_1 DESC, customerseqid""")
def t4(src: Source) -> DataFrame:
    return src("customer_scores").select("customerseqid", F.col("prob_1").alias("propensity")).orderBy(
        F.col("propensity").desc(), "customerseqid")


@query("t5_head_preview", "SELECT row_id, label, round(prob_1, 6) AS prob_1 FROM scored ORDER BY row_id LIMIT 5")
def t5(src: Source) -> DataFrame:
    return tables.head(src("scored").select("row_id", "label", "prob_1"), ["row_id"], 5)


# Names against names


@query("u4_except_names", f"""
WITH {RANKING_SQL} SELECT feature FROM ranking WHERE ranking > 2""")
def u4(src: Source) -> DataFrame:
    ranking = target_ranking(src)
    return relate.anti_rows(ranking.select("feature"), ranking.filter("ranking <= 2"), ["feature"])


@query("u5_intersect_names", f"""
WITH {RANKING_SQL} SELECT feature, CASE WHEN ranking <= 3 THEN 1 ELSE 0 END AS selected FROM ranking
WHERE feature IN ('n_orders', 'acctbal', 'max_price')""")
def u5(src: Source) -> DataFrame:
    ranking = target_ranking(src)
    wanted = ranking.filter(F.col("feature").isin("n_orders", "acctbal", "max_price")).select("feature")
    chosen = ranking.filter("ranking <= 3")
    return relate.semi_rows(wanted, chosen, ["feature"]).withColumn("selected", F.lit(1)).unionByName(
        relate.anti_rows(wanted, chosen, ["feature"]).withColumn("selected", F.lit(0)))


@query("u6_hstack", f"""
SELECT customerseqid, monthyearid, {SEGMENT_SQL}, n_orders * 2 AS n_twice,
  CAST((SELECT count(*) FROM panel) AS BIGINT) AS n_rows FROM panel""")
def u6(src: Source) -> DataFrame:
    panel = src("panel").select("customerseqid", "monthyearid", "segment", "n_orders")
    total = panel.agg(F.count(F.lit(1)).alias("n"))
    wide = cols.OneHot.fit(panel, ["segment"]).transform(panel)
    return wide.withColumn("n_twice", F.col("n_orders") * 2).withColumn("n_rows", one_value(total, "n")).drop("n_orders")


@query("p15_one_hot_wide", """
SELECT CAST(o_custkey AS VARCHAR) AS level, count(*) AS n FROM orders GROUP BY o_custkey""")
def p15_wide(src: Source) -> DataFrame:
    """A column of thousands of levels as one sparse vector; rows per level."""
    keyed = src("orders").select(F.col("o_custkey").cast("string").alias("customer"))
    vocabulary = cols.Vocabulary.fit(keyed, "customer")
    return vocabulary.totals(vocabulary.transform(keyed, "v"), "v")
