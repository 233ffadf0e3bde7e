"""SQL pieces that several oracle statements share."""

from __future__ import annotations

from leadloom.operators.scores import EXPECTED_VALUE_RATES, USECASE_PRIORITIES


def h(key: str, seed: int) -> str:
    """The portable hash of a non-negative integer key."""
    a = f"((({key}) % 2147483648 * 2654435761 + {seed * 1000003}) % 4294967296)"
    b = f"xor({a}, {a} >> 15)"
    c = f"(({b} * 99338871 + {seed}) % 4294967296)"
    return f"xor({c}, {c} >> 13)"


def fractions(parts: int) -> str:
    return "[" + ", ".join(str(i / parts) for i in range(parts + 1)) + "]"


def bins(source: str, column: str, parts: int, prefix: str, digits: int = 9) -> str:
    """CTEs ``<prefix>_edges``, ``<prefix>_inner``: quantile edges without repeats, and those between the ends."""
    return f"""
{prefix}_edges AS (SELECT DISTINCT edge FROM (
    SELECT round(unnest(quantile_cont({column}, {fractions(parts)})), {digits}) AS edge FROM {source})),
{prefix}_inner AS (SELECT edge FROM {prefix}_edges
    WHERE edge > (SELECT min(edge) FROM {prefix}_edges) AND edge < (SELECT max(edge) FROM {prefix}_edges))"""


def bin_of(column: str, prefix: str) -> str:
    return f"(SELECT count(*) FROM {prefix}_inner WHERE edge < {column})"


def measures(tn: str = "tn", fp: str = "fp", fn: str = "fn", tp: str = "tp") -> str:
    total = f"({tn} + {fp} + {fn} + {tp})"
    return f"""
  round(CASE WHEN {tp} + {fp} = 0 THEN -1 ELSE {tp} / CAST({tp} + {fp} AS DOUBLE) END, 6) AS hit_rate,
  round(CASE WHEN {tp} + {fn} = 0 THEN -1 ELSE {tp} / CAST({tp} + {fn} AS DOUBLE) END, 6) AS coverage,
  round(CASE WHEN {tp} + {fp} = 0 THEN -1
        ELSE ({tp} / CAST({tp} + {fp} AS DOUBLE)) / nullif(({tp} + {fn}) / CAST({total} AS DOUBLE), 0) END, 6) AS lift"""


def cuts(percents: list[int], source: str = "scored", score: str = "prob_1", key: str = "row_id") -> str:
    """CTEs ``ranked`` and ``cut``: confusion counts for each top percentage."""
    wanted = ", ".join(f"({p})" for p in percents)
    return f"""
ranked AS (SELECT label, row_number() OVER (ORDER BY {score} DESC, {key}) AS rnk, count(*) OVER () AS n FROM {source}),
pcts(pct) AS (VALUES {wanted}),
cut AS (SELECT pct,
    CAST(count(*) FILTER (WHERE rnk * 100 > n * pct AND label = 0) AS BIGINT) AS tn,
    CAST(count(*) FILTER (WHERE rnk * 100 <= n * pct AND label = 0) AS BIGINT) AS fp,
    CAST(count(*) FILTER (WHERE rnk * 100 > n * pct AND label = 1) AS BIGINT) AS fn,
    CAST(count(*) FILTER (WHERE rnk * 100 <= n * pct AND label = 1) AS BIGINT) AS tp
  FROM ranked CROSS JOIN pcts GROUP BY pct)"""


ROC = """
steps AS (SELECT prob_1 AS threshold, count(*) AS n, sum(label) AS pos FROM scored GROUP BY prob_1),
curve AS (SELECT threshold, n, pos,
    sum(n) OVER (ORDER BY threshold DESC) AS cum_n, sum(pos) OVER (ORDER BY threshold DESC) AS cum_pos,
    sum(n) OVER () AS total, sum(pos) OVER () AS positives FROM steps),
rates_by_score AS (SELECT threshold, n, pos,
    CAST(cum_n - cum_pos AS DOUBLE) / nullif(total - positives, 0) AS fpr,
    CAST(cum_pos AS DOUBLE) / nullif(positives, 0) AS tpr,
    CAST(n - pos AS DOUBLE) / nullif(total - positives, 0) AS fpr_step,
    CAST(pos AS DOUBLE) / nullif(positives, 0) AS tpr_step,
    CAST(cum_n AS DOUBLE) / total AS ppr FROM curve)"""

CA = """
orphan_c AS (SELECT DISTINCT customerseqid FROM leads_master WHERE customertype = 'fullyorphan'),
optin_a AS (SELECT DISTINCT agentseqid FROM leads_master WHERE orphanoptinflag = 'Y'),
attached_ca AS (SELECT DISTINCT customerseqid, agentseqid FROM leads_master
    WHERE customertype IN ('notorphan', 'partialorphan')),
ca AS (SELECT customerseqid, agentseqid FROM attached_ca
    UNION SELECT customerseqid, agentseqid FROM orphan_c CROSS JOIN optin_a)"""

CAP = CA + """,
cp AS (SELECT DISTINCT customerseqid, usecase FROM leads_master),
cw AS (SELECT DISTINCT customerseqid FROM leads_master WHERE customertype = 'fullyorphan' OR underservedflag = 'Y'),
cap AS (SELECT ca.customerseqid, ca.agentseqid, cp.usecase FROM ca JOIN cp ON cp.customerseqid = ca.customerseqid),
cwap AS (SELECT * FROM cap WHERE customerseqid IN (SELECT customerseqid FROM cw))"""

_RATES = ", ".join(f"('{u}', CAST({cr} AS DOUBLE), CAST({wp} AS DOUBLE))" for u, cr, wp in EXPECTED_VALUE_RATES)
EV = f"""
rates(usecase, cr, wp) AS (VALUES {_RATES}),
ev AS (SELECT DISTINCT l.customerseqid, l.usecase,
    (1 - CAST(l.percentile AS DOUBLE) / CAST(20 AS DOUBLE)) * r.wp * r.cr * CAST(1000 AS DOUBLE) AS expected_value
  FROM leads_master l JOIN rates r ON r.usecase = l.usecase)"""

_PRIORITIES = ", ".join(f"('{u}', {p})" for u, p in USECASE_PRIORITIES)
PRIORITIES = f"priorities(usecase, priority) AS (VALUES {_PRIORITIES})"


def affinity(pairs: str = "ca", age: str = "1") -> str:
    return f"""
hh AS (SELECT x.customerseqid, x.agentseqid, max(CASE WHEN am.agentseqid IS NULL THEN 0 ELSE 1 END) AS hh_service
  FROM {pairs} x LEFT JOIN cust_master cm ON cm.customerseqid = x.customerseqid
  LEFT JOIN agent_master am ON am.agentseqid = x.agentseqid AND am.agent_hid = cm.customer_hid
  GROUP BY x.customerseqid, x.agentseqid),
traits AS (SELECT DISTINCT agentseqid, agent_language, agent_postal_sector, agent_age FROM agent_master),
aff AS (SELECT hh.customerseqid, hh.agentseqid,
    100 * (CASE WHEN customer_language = agent_language THEN 1 ELSE 0 END
         + CASE WHEN customer_postal_sector = agent_postal_sector THEN 1 ELSE 0 END + {age} + hh_service) AS affinity
  FROM hh LEFT JOIN traits ON traits.agentseqid = hh.agentseqid
  LEFT JOIN cust_master cm ON cm.customerseqid = hh.customerseqid)"""


AGE_DIFFERENCE = "CASE WHEN abs(customer_age - agent_age) <= 5 THEN 1 ELSE 0 END"

ALLOCATION = CAP + "," + EV + "," + affinity() + """,
classes AS (SELECT customerseqid, CASE WHEN min(customertype) = 'fullyorphan' THEN 0 ELSE 1 END AS priority
  FROM leads_master GROUP BY customerseqid),
offers AS (SELECT cap.customerseqid, cap.agentseqid, cap.usecase, ev.expected_value, aff.affinity,
    row_number() OVER (PARTITION BY cap.customerseqid
      ORDER BY ev.expected_value + aff.affinity DESC, cap.usecase, cap.agentseqid) AS rn
  FROM cap JOIN ev ON ev.customerseqid = cap.customerseqid AND ev.usecase = cap.usecase
  JOIN aff ON aff.customerseqid = cap.customerseqid AND aff.agentseqid = cap.agentseqid),
chosen AS (SELECT o.customerseqid, o.agentseqid, o.usecase, o.expected_value, o.affinity, c.priority
  FROM offers o JOIN classes c ON c.customerseqid = o.customerseqid
  WHERE rn = 1 AND o.expected_value + o.affinity >= 0)"""

WARMING_BINS = """
filled AS (SELECT customerseqid, agentseqid, coalesce(wpi, 0) AS wpi, coalesce(days_underserved, 9999) AS days
  FROM leads_master),""" + bins("filled", "wpi", 10, "w") + "," + bins("filled", "days", 10, "d") + f""",
pair_bins AS (SELECT customerseqid, agentseqid, max({bin_of('filled.wpi', 'w')}) AS wpi_score,
    max({bin_of('filled.days', 'd')}) AS serving_score
  FROM filled GROUP BY customerseqid, agentseqid)"""

WARMING_SCORES = WARMING_BINS + ",\n" + PRIORITIES + """,
warming AS (SELECT x.customerseqid, x.agentseqid, x.usecase,
    CAST(coalesce(b.wpi_score, 0) * coalesce(b.serving_score, 9999) * (10 - p.priority) AS BIGINT) AS warming_score
  FROM cwap x LEFT JOIN pair_bins b ON b.customerseqid = x.customerseqid AND b.agentseqid = x.agentseqid
  JOIN priorities p ON p.usecase = x.usecase)"""


def warming(rfs: int, agency: int) -> str:
    """CTEs up to ``done``: the closed form of the second program, written over all warm triples."""
    return ALLOCATION + "," + WARMING_SCORES + f""",
load AS (SELECT agentseqid, count(DISTINCT customerseqid) AS allocated FROM chosen GROUP BY agentseqid),
channel_of AS (SELECT DISTINCT agentseqid, channel FROM leads_master WHERE channel <> 'orphan'),
cand AS (SELECT c.customerseqid, c.agentseqid, c.usecase, ch.channel, w.warming_score, aw.compulsory,
    c.expected_value * w.warming_score + l.allocated AS gain
  FROM chosen c JOIN warming w ON w.customerseqid = c.customerseqid AND w.agentseqid = c.agentseqid
    AND w.usecase = c.usecase
  JOIN load l ON l.agentseqid = c.agentseqid
  LEFT JOIN channel_of ch ON ch.agentseqid = c.agentseqid
  JOIN agent_warming aw ON aw.agentseqid = c.agentseqid WHERE NOT aw.opt_out),
caps(channel, cap) AS (VALUES ('rfs', {rfs}), ('agency', {agency})),
must AS (SELECT channel, count(*) AS m FROM cand WHERE compulsory GROUP BY channel),
feasible AS (SELECT count(*) = 0 AS ok FROM must JOIN caps ON caps.channel = must.channel WHERE m > cap),
open_rows AS (SELECT cand.*, row_number() OVER (PARTITION BY cand.channel ORDER BY gain DESC, customerseqid) AS rn
  FROM cand WHERE NOT compulsory AND gain > 0),
done AS (
  SELECT customerseqid, agentseqid, usecase, warming_score FROM cand WHERE compulsory
  UNION ALL
  SELECT o.customerseqid, o.agentseqid, o.usecase, o.warming_score FROM open_rows o
  LEFT JOIN caps ON caps.channel = o.channel LEFT JOIN must ON must.channel = o.channel
  WHERE caps.cap IS NULL OR o.rn <= caps.cap - coalesce(must.m, 0))"""
