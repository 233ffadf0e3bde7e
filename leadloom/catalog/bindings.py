"""Views that give the star-schema tables the shape of the operators' inputs.

Each view is one SELECT that Spark and any ANSI engine read alike, so both sides of a check start from equal rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from leadloom.operators.relate import by_key, dealt, task_count

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {
    # Customer-month panel with nulls, text sentinels, a constant column and a scaled twin.
    "panel": """
SELECT m.customerseqid, m.monthyearid, m.target_flag, m.n_orders,
       round(m.sum_price, 2) AS sum_price, m.max_price,
       round(m.sum_price * CAST(2.0 AS DOUBLE), 2) AS delta_price,
       CAST(1 AS INT) AS const_col,
       m.monthyearid - lag(m.monthyearid) OVER (PARTITION BY m.customerseqid ORDER BY m.monthyearid)
         AS days_since_prev,
       CASE WHEN m.st = 'P' THEN 'others' WHEN m.st = 'F' THEN NULL ELSE m.st END AS status,
       c.c_mktsegment AS segment, c.c_acctbal AS acctbal
FROM (SELECT o_custkey AS customerseqid,
             CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS monthyearid,
             max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS target_flag,
             count(*) AS n_orders, sum(o_totalprice) AS sum_price, max(o_totalprice) AS max_price,
             min(o_orderstatus) AS st
      FROM orders GROUP BY o_custkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT)) m
JOIN customer c ON c.c_custkey = m.customerseqid""",
    # The panel with a column that holds infinities and NaN.
    "raw_panel": """
SELECT p.*, CASE WHEN n_orders > 2 THEN CAST('inf' AS DOUBLE) WHEN n_orders = 2 THEN CAST('-inf' AS DOUBLE)
                 WHEN days_since_prev IS NULL THEN CAST('nan' AS DOUBLE)
                 ELSE round(sum_price / CAST(1000.0 AS DOUBLE), 3) END AS scaled_price
FROM panel p""",
    # One score per customer.
    "customer_scores": """
SELECT o_custkey AS customerseqid, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS label,
       round(max(o_totalprice) / CAST(1000000.0 AS DOUBLE), 3) AS prob_1
FROM orders GROUP BY o_custkey""",
    # Scored set with many tied scores; row_id is unique.
    "scored": """
SELECT o_orderkey AS row_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label,
       CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS prediction,
       round(o_totalprice / CAST(1000000.0 AS DOUBLE), 3) AS prob_1
FROM orders""",
    # Scores of three stand-in models on the same rows.
    "model_scores": """
SELECT o_orderkey AS row_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label,
       round(o_totalprice / CAST(1000000.0 AS DOUBLE), 3) AS prob_gbt,
       round((o_custkey % 97) / CAST(97.0 AS DOUBLE), 4) AS prob_forest,
       round((o_orderkey % 1009) / CAST(1009.0 AS DOUBLE), 4) AS prob_logit
FROM orders""",
    "leads_master": """
SELECT pr.c AS customerseqid, pr.a AS agentseqid,
  CASE pr.u WHEN 0 THEN 'fpp' WHEN 1 THEN 'maturity' WHEN 2 THEN 'hnw' WHEN 3 THEN 'upsell_life_hp'
            WHEN 4 THEN 'xsell_health_gi' WHEN 5 THEN 'upsell_life_rp' WHEN 6 THEN 'xsell_health_life'
            ELSE 'xsell_life_hi' END AS usecase,
  CASE cu.c_mktsegment WHEN 'BUILDING' THEN 'fullyorphan' WHEN 'MACHINERY' THEN 'partialorphan'
            ELSE 'notorphan' END AS customertype,
  CASE WHEN pr.a % 3 = 0 THEN 'Y' ELSE 'N' END AS orphanoptinflag,
  CASE WHEN cu.c_acctbal < 0 THEN 'Y' ELSE 'N' END AS underservedflag,
  CASE WHEN pr.a % 5 = 0 THEN 'orphan' WHEN pr.a % 5 < 3 THEN 'rfs' ELSE 'agency' END AS channel,
  CAST((pr.c * 31 + pr.u * 7) % 100 + 1 AS INT) AS percentile,
  CASE WHEN pr.c % 7 = 0 THEN NULL ELSE CAST(pr.c % 400 AS DOUBLE) END AS days_underserved,
  CASE WHEN pr.c % 11 = 0 THEN NULL ELSE cu.c_acctbal END AS wpi
FROM (SELECT DISTINCT o.o_custkey AS c, l.l_suppkey AS a, l.l_partkey % 8 AS u
      FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) pr
JOIN customer cu ON cu.c_custkey = pr.c""",
    "cust_master": """
SELECT c_custkey AS customerseqid, c_nationkey AS customer_hid,
  CASE c_nationkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' ELSE NULL END AS customer_language,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS customer_postal_sector,
  CAST(20 + c_custkey % 50 AS INT) AS customer_age
FROM customer""",
    # Several households per agent.
    "agent_master": """
SELECT s.s_suppkey AS agentseqid, n.n_nationkey AS agent_hid,
  CASE s.s_nationkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' ELSE 'de' END AS agent_language,
  s.s_nationkey AS agent_postal_sector, CAST(25 + s.s_suppkey % 40 AS INT) AS agent_age
FROM supplier s JOIN nation n ON n.n_regionkey = s.s_nationkey % 5""",
    "agent_capacity": """
SELECT s_suppkey AS agentseqid,
       CAST(100 + ((s_suppkey % 2147483648 * 2654435761 + 97) % 4294967296) % 20 AS INT) AS capa_max
FROM supplier""",
    "agent_warming": """
SELECT s_suppkey AS agentseqid, s_suppkey % 10 < 2 AS opt_out, s_suppkey % 10 >= 8 AS compulsory
FROM supplier""",
    "base_flags": """
SELECT customerseqid, monthyearid,
  CASE WHEN customerseqid % 3 = 0 THEN 1 ELSE 0 END AS prod_held_g_only,
  CASE WHEN customerseqid % 3 = 1 THEN 1 ELSE 0 END AS prod_held_l_only,
  CASE WHEN customerseqid % 3 = 2 THEN 1 ELSE 0 END AS prod_held_l_and_g
FROM panel""",
}

#: Tables that a view reads by tasks of bounded size, as its DISTINCT holds the rows of a task in memory, and their key.
DEALT = {"leads_master": {"lineitem": "l_orderkey"}}


def _words(text: str) -> set[str]:
    return set(re.findall(r"[a-z_]+", re.sub(r"'[^']*'", " ", text)))


def needed_views(text: str) -> list[str]:
    """Views a statement reads, each after the views it builds on."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in VIEWS:
            if name in _words(body) and name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(text)
    return order


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view, or the table itself, as a DataFrame."""
    if name in BASE_TABLES:
        return table(spark, sf_dir, name)
    body = VIEWS[name]
    words = _words(body)
    inputs = {n: view(spark, sf_dir, n) for n in (*BASE_TABLES, *VIEWS) if n != name and n in words}
    for source, key in DEALT.get(name, {}).items():
        tasks = task_count(inputs[source])
        inputs[source] = by_key(dealt(inputs[source], tasks, key), tasks)
    text = body
    for source in inputs:
        text = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", text)
    return spark.sql(text, **inputs)


def with_views(text: str) -> str:
    """Prefix a SELECT with the views it reads, as common table expressions.

    ``text`` may start with its own ``WITH`` list, which then follows the views.
    """
    parts = [f"{name} AS MATERIALIZED ({VIEWS[name].strip()})" for name in needed_views(text)]
    body = text.strip()
    if not parts:
        return body
    joined = ",\n".join(parts)
    if body[:5].upper() == "WITH ":
        return f"WITH {joined},\n{body[5:]}"
    return f"WITH {joined}\n{body}"
