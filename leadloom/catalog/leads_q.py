"""Queries for joins, sets, domains, scores, allocation and warming.

The statements on the SQL side build all customer x agent pairs; the Spark side works on the factors of the domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.catalog import fragments as sqlf
from leadloom.catalog.metrics_q import RATES_SQL, sampled_panel
from leadloom.catalog.registry import Source, query
from leadloom.functions.scalars import flag
from leadloom.operators import allocation as al
from leadloom.operators import domains as dm
from leadloom.operators import relate, sampling, scores
from leadloom.plans.lead_run import LeadRun, build_helpers, run_allocation
from leadloom.session import cut_lineage

C, A, P = dm.C, dm.A, dm.P
DIGITS = 9


def leads_and_domains(src: Source) -> tuple[DataFrame, dm.Domains]:
    """The lead table, written once because every factor reads it, and its domains."""
    leads = cut_lineage(src("leads_master"))
    return leads, dm.build_domains(leads)


# Joins


@query("j1_join_leads_base", """
SELECT s.customerseqid, round(s.prob_1, 6) AS prob_1, b.prod_held_g_only, b.prod_held_l_only, b.prod_held_l_and_g
FROM customer_scores s JOIN base_flags b ON b.customerseqid = s.customerseqid WHERE b.monthyearid = 199807""")
def j1(src: Source) -> DataFrame:
    base = src("base_flags").filter(F.col("monthyearid") == 199807).drop("monthyearid")
    return src("customer_scores").select(C, "prob_1").join(base, C)


@query("j2_join_ca_usecase", f"""
WITH {sqlf.CA}, cp AS (SELECT DISTINCT customerseqid, usecase FROM leads_master)
SELECT a.agentseqid, cp.usecase, count(*) AS n_customers FROM attached_ca a
JOIN cp ON cp.customerseqid = a.customerseqid GROUP BY a.agentseqid, cp.usecase""")
def j2(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    return d.attached.join(d.wants, C).groupBy(A, P).agg(F.count(F.lit(1)).alias("n_customers"))


@query("j3_cross_orphans_agents", f"""
WITH {sqlf.CA}
SELECT o.customerseqid, count(*) AS n_agents, min(a.agentseqid) AS first_agent, max(a.agentseqid) AS last_agent
FROM orphan_c o CROSS JOIN optin_a a GROUP BY o.customerseqid""")
def j3(src: Source) -> DataFrame:
    """The orphan product from its sides: each orphan sees the same agents."""
    _leads, d = leads_and_domains(src)
    ends = d.optin.agg(F.min(A).alias("first"), F.max(A).alias("last"))
    return d.orphans.select(C, d.n_optin.alias("n_agents"), ends.select("first").scalar().alias("first_agent"),
                            ends.select("last").scalar().alias("last_agent")).filter("n_agents > 0")


@query("j4_join_left_dim", f"""
WITH {sqlf.CA}
SELECT a.customerseqid, a.agentseqid, m.customer_hid, m.customer_language, m.customer_age
FROM attached_ca a LEFT JOIN cust_master m ON m.customerseqid = a.customerseqid""")
def j4(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    master = src("cust_master").select(C, "customer_hid", "customer_language", "customer_age")
    return d.attached.join(master, C, "left")


HOUSEHOLD_SQL = f"""
WITH {sqlf.CA},
hh AS (SELECT a.customerseqid, a.agentseqid, CASE WHEN am.agentseqid IS NULL THEN 0 ELSE 1 END AS hh_service
  FROM attached_ca a LEFT JOIN cust_master cm ON cm.customerseqid = a.customerseqid
  LEFT JOIN agent_master am ON am.agentseqid = a.agentseqid AND am.agent_hid = cm.customer_hid)"""


def served_households(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    homes = d.attached.join(src("cust_master").select(C, F.col("customer_hid").alias("hid")), C, "left")
    served = src("agent_master").select(A, F.col("agent_hid").alias("hid"), F.lit(True).alias("_h"))
    return homes.join(served, [A, "hid"], "left").select(C, A, flag(F.col("_h")).alias("hh_service"))


@query("j5_join_left_composite", f"{HOUSEHOLD_SQL} SELECT customerseqid, agentseqid, hh_service FROM hh")
def j5(src: Source) -> DataFrame:
    return served_households(src)


@query("j6_join_left_agg", f"""
{HOUSEHOLD_SQL} SELECT a.customerseqid, a.agentseqid, m.hh_service FROM attached_ca a LEFT JOIN (
  SELECT customerseqid, agentseqid, max(hh_service) AS hh_service FROM hh GROUP BY 1, 2) m
ON m.customerseqid = a.customerseqid AND m.agentseqid = a.agentseqid""")
def j6(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    return scores.household_pairs(d.attached, src("cust_master"), src("agent_master"))


@query("j7_join_left_distinct_dim", f"""
WITH {sqlf.CA}
SELECT a.customerseqid, a.agentseqid, t.agent_language, t.agent_postal_sector, t.agent_age FROM attached_ca a
LEFT JOIN (SELECT DISTINCT agentseqid, agent_language, agent_postal_sector, agent_age FROM agent_master) t
ON t.agentseqid = a.agentseqid""")
def j7(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    traits = relate.distinct_projection(src("agent_master"), A, "agent_language", "agent_postal_sector", "agent_age")
    return d.attached.join(traits, A, "left")


IN_LEADS = """
pairs_in_leads AS (SELECT DISTINCT customerseqid, agentseqid FROM leads_master)"""


@query("j8_join_left_leads", f"""
WITH {sqlf.CAP}, {sqlf.WARMING_BINS}, {IN_LEADS}
SELECT x.customerseqid, x.agentseqid, x.usecase, b.wpi_score, b.serving_score FROM cwap x
JOIN pairs_in_leads l ON l.customerseqid = x.customerseqid AND l.agentseqid = x.agentseqid
LEFT JOIN pair_bins b ON b.customerseqid = x.customerseqid AND b.agentseqid = x.agentseqid""")
def j8(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    return scores.lead_triples(leads, d).join(scores.warming_bins(leads, DIGITS), [C, A], "left")


@query("j9_join_priority", f"""
WITH {sqlf.PRIORITIES} SELECT l.customerseqid, l.agentseqid, l.usecase, p.priority FROM leads_master l
JOIN priorities p ON p.usecase = l.usecase""")
def j9(src: Source) -> DataFrame:
    leads = src("leads_master").select(C, A, P)
    return leads.join(relate.small_side(scores.priority_table(src.spark)), P)


@query("j10_join_compare_summary", f"""
WITH {RATES_SQL} SELECT monthyearid, nonpurch_orig, purch_orig, nonpurch_sampled, purch_sampled FROM both_rates""")
def j10(src: Source) -> DataFrame:
    table = sampling.compare_event_rates(src("panel"), sampled_panel(src), "monthyearid", "target_flag", C)
    return table.select("monthyearid", "nonpurch_orig", "purch_orig", "nonpurch_sampled", "purch_sampled")


@query("j12_lookup_map", f"""
WITH {sqlf.PRIORITIES} SELECT x.customerseqid, x.usecase, p.priority FROM (
  SELECT DISTINCT customerseqid, usecase FROM leads_master) x JOIN priorities p ON p.usecase = x.usecase""")
def j12(src: Source) -> DataFrame:
    pairs = src("leads_master").select(C, P).distinct()
    return scores.with_priority(pairs, scores.priority_table(src.spark)).select(C, P, "priority")


@query("j13_anti_key", """
SELECT customerseqid, monthyearid FROM panel p
WHERE NOT EXISTS (SELECT 1 FROM panel q WHERE q.customerseqid = p.customerseqid AND q.target_flag = 1)""")
def j13(src: Source) -> DataFrame:
    panel = src("panel").select(C, "monthyearid", "target_flag")
    return relate.anti_rows(panel, panel.filter("target_flag = 1"), [C]).select(C, "monthyearid")


@query("j15_semi_key", """
SELECT customerseqid, agentseqid, usecase FROM leads_master WHERE customerseqid IN (
  SELECT customerseqid FROM leads_master WHERE customertype = 'fullyorphan' OR underservedflag = 'Y')""")
def j15(src: Source) -> DataFrame:
    leads = src("leads_master").select(C, A, P, "customertype", "underservedflag")
    return relate.semi_rows(leads, leads.filter(dm.is_warm()), [C]).select(C, A, P)


# Set operators


@query("u1_union_all", """
SELECT customerseqid, agentseqid FROM leads_master WHERE customertype IN ('notorphan', 'partialorphan')
UNION ALL SELECT customerseqid, agentseqid FROM leads_master WHERE customertype = 'fullyorphan' AND orphanoptinflag = 'Y'""")
def u1(src: Source) -> DataFrame:
    leads = src("leads_master")
    own = leads.filter(F.col("customertype").isin(*dm.ATTACHED_TYPES)).select(C, A)
    return relate.union_all(own, leads.filter(dm.is_orphan() & (F.col("orphanoptinflag") == "Y")).select(C, A))


@query("u2_distinct_rows", "SELECT DISTINCT customerseqid, usecase FROM leads_master")
def u2(src: Source) -> DataFrame:
    return relate.distinct_projection(src("leads_master"), C, P)


@query("u3_dedup_key_first", """
SELECT customerseqid, agentseqid, usecase, customertype FROM (SELECT *, row_number() OVER (PARTITION BY customerseqid
  ORDER BY customertype, agentseqid, usecase) AS rn FROM leads_master) WHERE rn = 1""")
def u3(src: Source) -> DataFrame:
    leads = src("leads_master").select(C, A, P, "customertype")
    return relate.first_per_key(leads, [C], ["customertype", A, P])


# Aggregates of the lead tables


@query("a8_max_by_pair", f"""
{HOUSEHOLD_SQL} SELECT customerseqid, agentseqid, max(hh_service) AS hh_service FROM hh GROUP BY customerseqid, agentseqid""")
def a8(src: Source) -> DataFrame:
    return served_households(src).groupBy(C, A).agg(F.max("hh_service").alias("hh_service"))


@query("a9_nunique_by_agent", f"""
WITH {sqlf.CAP},
got AS (SELECT agentseqid, count(DISTINCT customerseqid) AS n, count(DISTINCT CASE WHEN customerseqid IN (
    SELECT customerseqid FROM cw) THEN customerseqid END) AS nw FROM leads_master GROUP BY agentseqid)
SELECT x.agentseqid, coalesce(n, 0) AS allocated, coalesce(nw, 0) AS allocated_warm
FROM (SELECT DISTINCT agentseqid FROM cap) x LEFT JOIN got ON got.agentseqid = x.agentseqid""")
def a9(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    return al.allocated_counts(leads.select(C, A), d)


@query("a10_collect_domains", f"""
WITH {sqlf.CAP} SELECT agentseqid, usecase, count(DISTINCT customerseqid) AS n_customers FROM cap GROUP BY 1, 2""")
def a10(src: Source) -> DataFrame:
    return dm.customers_per_agent_usecase(leads_and_domains(src)[1])


ATTACHED_SIZES_SQL = f"""
WITH {sqlf.CAP},
first_type AS (SELECT customerseqid, min(customertype) AS t FROM leads_master GROUP BY customerseqid)
SELECT agentseqid, count(*) FILTER (WHERE t <> 'fullyorphan') AS n_attached,
  count(*) FILTER (WHERE t = 'fullyorphan') AS n_orphan
FROM cap JOIN first_type f ON f.customerseqid = cap.customerseqid GROUP BY agentseqid"""


@query("a11_collect_attached_orphan", ATTACHED_SIZES_SQL)
def a11(src: Source) -> DataFrame:
    return dm.attached_orphan_sizes(*leads_and_domains(src))


@query("a12_collect_warm_domains", f"""
WITH {sqlf.CAP} SELECT agentseqid, count(*) AS n_choices FROM cwap GROUP BY agentseqid""")
def a12(src: Source) -> DataFrame:
    return dm.warm_sizes(leads_and_domains(src)[1], "agent")


# Domains


@query("d1_domain_ca", f"WITH {sqlf.CA} SELECT agentseqid, count(*) AS n_customers FROM ca GROUP BY agentseqid")
def d1(src: Source) -> DataFrame:
    return dm.customers_per_agent(leads_and_domains(src)[1])


@query("d1_domain_ca_by_customer", f"WITH {sqlf.CA} SELECT customerseqid, count(*) AS n_agents FROM ca GROUP BY customerseqid")
def d1_customer(src: Source) -> DataFrame:
    return dm.agents_per_customer(leads_and_domains(src)[1])


@query("d2_domain_cap", f"""
WITH {sqlf.CAP} SELECT customerseqid, count(DISTINCT agentseqid) AS n_agents, count(DISTINCT usecase) AS n_usecases,
  count(*) AS n_triples FROM cap GROUP BY customerseqid""")
def d2(src: Source) -> DataFrame:
    return dm.triples_per_customer(leads_and_domains(src)[1])


@query("d3_domain_warm", f"""
WITH {sqlf.CAP} SELECT customerseqid, count(DISTINCT agentseqid) AS n_agents, count(DISTINCT usecase) AS n_usecases,
  count(*) AS n_triples FROM cwap GROUP BY customerseqid""")
def d3(src: Source) -> DataFrame:
    return dm.triples_per_customer(leads_and_domains(src)[1], warm_only=True)


@query("d4_domain_proj", f"""
WITH {sqlf.CAP}
SELECT DISTINCT 'C' AS domain, customerseqid, CAST(NULL AS BIGINT) AS agentseqid, CAST(NULL AS VARCHAR) AS usecase,
  CAST(NULL AS VARCHAR) AS channel FROM cap
UNION ALL SELECT DISTINCT 'A', NULL, agentseqid, NULL, NULL FROM cap
UNION ALL SELECT DISTINCT 'P', NULL, NULL, usecase, NULL FROM cap
UNION ALL SELECT DISTINCT 'AP', NULL, agentseqid, usecase, NULL FROM cap
UNION ALL SELECT DISTINCT 'CP', customerseqid, NULL, usecase, NULL FROM cap
UNION ALL SELECT DISTINCT 'AT', NULL, agentseqid, NULL, channel FROM leads_master WHERE channel <> 'orphan'""")
def d4(src: Source) -> DataFrame:
    sets = dm.projections(leads_and_domains(src)[1])
    kinds = {C: "bigint", A: "bigint", P: "string", "channel": "string"}
    return relate.union_all(*[
        df.select(F.lit(name).alias("domain"),
                  *[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()])
        for name, df in sets.items()])


@query("d5_build_domains", f"""
WITH {sqlf.CAP}
SELECT 'CA' AS domain, count(*) AS n FROM ca UNION ALL SELECT 'CAP', count(*) FROM cap
UNION ALL SELECT 'Cw', count(*) FROM cw UNION ALL SELECT 'CwAP', count(*) FROM cwap""")
def d5(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    total = {"CA": dm.agents_per_customer(d).agg(F.sum("n_agents").alias("n")),
             "CAP": dm.triples_per_customer(d).agg(F.sum("n_triples").alias("n")),
             "Cw": d.warm.agg(F.count(F.lit(1)).alias("n")),
             "CwAP": dm.triples_per_customer(d, warm_only=True).agg(F.sum("n_triples").alias("n"))}
    return relate.union_all(*[df.select(F.lit(name).alias("domain"), F.col("n")) for name, df in total.items()])


@query("d6_capacity_bounds", f"""
WITH {sqlf.CAP}, {sqlf.PRIORITIES}
SELECT 'agent' AS kind, CAST(a.agentseqid AS VARCHAR) AS name, 0 AS least, a.capa_max AS most FROM agent_capacity a
WHERE a.agentseqid IN (SELECT agentseqid FROM cap)
UNION ALL SELECT 'usecase', usecase, 0, 4000 FROM priorities WHERE usecase IN (SELECT usecase FROM cap)
UNION ALL SELECT DISTINCT 'channel', channel, 0, CASE channel WHEN 'rfs' THEN 10000 ELSE 5000 END FROM leads_master
WHERE channel <> 'orphan'""")
def d6(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    sets = dm.projections(d)
    agents = src("agent_capacity").join(sets["A"], A, "left_semi").select(
        F.lit("agent").alias("kind"), F.col(A).cast("string").alias("name"), F.lit(0).alias("least"),
        F.col("capa_max").alias("most"))
    cases = sets["P"].select(F.lit("usecase").alias("kind"), F.col(P).alias("name"),
                             F.lit(al.DEFAULT_LIMITS[0]).alias("least"), F.lit(al.DEFAULT_LIMITS[1]).alias("most"))
    cap = F.create_map(*[F.lit(v) for item in al.WARMING_CAPACITY.items() for v in item])
    channels = d.channels.select("channel").distinct().select(
        F.lit("channel").alias("kind"), F.col("channel").alias("name"), F.lit(0).alias("least"),
        cap[F.col("channel")].alias("most"))
    return relate.union_all(agents, cases, channels)


@query("d7_expected_value", f"""
WITH {sqlf.EV} SELECT customerseqid, usecase, round(expected_value, 6) AS expected_value FROM ev""")
def d7(src: Source) -> DataFrame:
    return scores.expected_value(src("leads_master"), scores.rates_table(src.spark))


@query("d8_affinity", f"""
WITH {sqlf.CA}, {sqlf.affinity('attached_ca')} SELECT customerseqid, agentseqid, affinity FROM aff""")
def d8(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    return scores.affinity(d.attached, src("cust_master"), src("agent_master"))


@query("d8_affinity_age_difference", f"""
WITH {sqlf.CA}, {sqlf.affinity('attached_ca', sqlf.AGE_DIFFERENCE)} SELECT customerseqid, agentseqid, affinity FROM aff""")
def d8_difference(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    return scores.affinity(d.attached, src("cust_master"), src("agent_master"), "difference")


BEST_SQL = """SELECT customerseqid, agentseqid, affinity FROM (SELECT a.*, row_number() OVER (
  PARTITION BY customerseqid ORDER BY affinity DESC, agentseqid) AS rn FROM aff a) WHERE rn = 1"""


@query("d8_affinity_best_agent", f"WITH {sqlf.CA}, {sqlf.affinity()} {BEST_SQL}")
def d8_best(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    return scores.best_agent(d, src("cust_master"), src("agent_master"))


@query("d8_affinity_best_agent_age_difference", f"WITH {sqlf.CA}, {sqlf.affinity('ca', sqlf.AGE_DIFFERENCE)} {BEST_SQL}")
def d8_best_difference(src: Source) -> DataFrame:
    _leads, d = leads_and_domains(src)
    return scores.best_agent(d, src("cust_master"), src("agent_master"), "difference")


@query("d9_priority", """
SELECT customerseqid, min(customertype) AS customertype,
  CASE WHEN min(customertype) = 'fullyorphan' THEN 0 ELSE 1 END AS priority FROM leads_master GROUP BY customerseqid""")
def d9(src: Source) -> DataFrame:
    return dm.customer_class(src("leads_master"))


@query("d10_duo_domains", f"WITH {sqlf.CAP} SELECT usecase, count(*) AS n_pairs FROM cap GROUP BY usecase")
def d10(src: Source) -> DataFrame:
    return dm.pairs_per_usecase(leads_and_domains(src)[1])


@query("d11_attached_orphan", ATTACHED_SIZES_SQL)
def d11(src: Source) -> DataFrame:
    return dm.attached_orphan_sizes(*leads_and_domains(src))


@query("d12_warming_flags", """
SELECT CASE WHEN opt_out THEN 'opt_out' ELSE 'compulsory' END AS kind, agentseqid FROM agent_warming
WHERE opt_out OR compulsory""")
def d12(src: Source) -> DataFrame:
    agents = src("agent_warming").filter("opt_out or compulsory")
    return agents.select(F.when(F.col("opt_out"), "opt_out").otherwise("compulsory").alias("kind"), A)


@query("d13_warming_score", f"""
WITH {sqlf.CAP}, {sqlf.WARMING_SCORES}
SELECT customerseqid, agentseqid, usecase, warming_score FROM warming WHERE warming_score <> 0""")
def d13(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    rows = scores.lead_triples(leads, d)
    return scores.warming_score(leads, rows, scores.priority_table(src.spark), DIGITS).filter("warming_score <> 0")


@query("d14_warming_domains", f"""
WITH {sqlf.CAP}, ch AS (SELECT DISTINCT agentseqid, channel FROM leads_master WHERE channel <> 'orphan')
SELECT ch.channel, count(*) AS n_choices FROM cwap JOIN ch ON ch.agentseqid = cwap.agentseqid GROUP BY ch.channel""")
def d14(src: Source) -> DataFrame:
    return dm.warm_sizes(leads_and_domains(src)[1], "channel")


@query("d15_build_helpers", f"""
WITH {sqlf.ALLOCATION}, best AS ({BEST_SQL})
SELECT ev.customerseqid, b.agentseqid, ev.usecase, round(ev.expected_value, 6) AS expected_value, b.affinity, c.priority,
  round(ev.expected_value + b.affinity, 6) AS score
FROM ev JOIN best b ON b.customerseqid = ev.customerseqid JOIN classes c ON c.customerseqid = ev.customerseqid""")
def d15(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    return helpers.options.select(C, A, P, "expected_value", "affinity", "priority", "score")


# Allocation and warming


def default_limits() -> al.Limits:
    """The limits of every run, for each use case with a rate."""
    return al.Limits({u: al.DEFAULT_LIMITS for u, _cr, _wp in scores.EXPECTED_VALUE_RATES})


def run(src: Source, capacity: dict[str, int] | None = None) -> LeadRun:
    return run_allocation(cut_lineage(src("leads_master")), src("cust_master"), src("agent_master"), src("agent_warming"),
                          limits=default_limits(), capacity=capacity, digits=DIGITS)


CHOSEN_SQL = "round(expected_value, 6) AS expected_value, affinity, priority"


@query("o1_allocate", f"""
WITH {sqlf.ALLOCATION} SELECT customerseqid, agentseqid, usecase, {CHOSEN_SQL} FROM chosen""")
def o1(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    return al.allocate(helpers.options, default_limits())


@query("o1_allocation_status", f"""
WITH {sqlf.ALLOCATION}
SELECT 'optimal' AS status, count(*) AS leads, round(sum(expected_value + affinity), 6) AS value,
  round(sum(expected_value + affinity), 6) AS bound, CAST(0 AS DOUBLE) AS gap FROM chosen""")
def o1_status(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    chosen = cut_lineage(al.allocate(helpers.options, default_limits()))
    return al.allocation_status(helpers.options, chosen, default_limits())


ONE_LIMIT = 100


@query("o1_allocate_one_limit", f"""
WITH {sqlf.ALLOCATION}, best AS ({BEST_SQL}),
opt AS (SELECT ev.customerseqid, ev.usecase, ev.expected_value + b.affinity AS score
  FROM ev JOIN best b ON b.customerseqid = ev.customerseqid),
two AS (SELECT customerseqid, usecase, score, greatest(coalesce(lead(score) OVER w, 0), 0) AS other,
  row_number() OVER w AS place FROM opt WINDOW w AS (PARTITION BY customerseqid ORDER BY score DESC, usecase)),
first AS (SELECT *, row_number() OVER (PARTITION BY usecase ORDER BY score - other DESC, customerseqid) AS turn
  FROM two WHERE place = 1 AND score >= 0)
SELECT least(count(*) FILTER (WHERE usecase = 'maturity'), {ONE_LIMIT}) AS maturity,
  round(sum(CASE WHEN usecase = 'maturity' AND turn > {ONE_LIMIT} THEN other ELSE score END), 6) AS value FROM first""")
def o1_one_limit(src: Source) -> DataFrame:
    """A single limit that binds: those who lose least by it give way."""
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    chosen = al.allocate(helpers.options, al.Limits({"maturity": (0, ONE_LIMIT)}))
    return chosen.agg(F.count_if(F.col(P) == "maturity").alias("maturity"),
                      F.round(F.sum(F.col("expected_value") + F.col("affinity")), 6).alias("value"))


TIGHT = {"maturity": (0, 100), "hnw": (50, 60), "fpp": (0, 120)}


@query("o1_allocate_tight", f"""
WITH {sqlf.ALLOCATION},
wanted AS (SELECT usecase, count(*) AS n FROM ev WHERE customerseqid IN (SELECT customerseqid FROM chosen) GROUP BY usecase)
SELECT count(*) AS customers, round(sum(expected_value + affinity), 6) AS best_without_limits, 0 AS several, 0 AS outside_limits,
  CASE WHEN (SELECT coalesce(sum(n), 0) FROM wanted WHERE usecase = 'hnw') >= 50 THEN 'optimal' ELSE 'infeasible' END AS status,
  0 AS above_best, 0 AS repeated_differs FROM chosen""")
def o1_tight(src: Source) -> DataFrame:
    """Limits of three use cases that bind: kept, and the value reaches the bound that prices give without the allocation."""
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    options, limits = cut_lineage(helpers.options), al.Limits(TIGHT)
    free, chosen = cut_lineage(al.allocate(options)), cut_lineage(al.allocate(options, limits))
    status = al.allocation_status(options, chosen, limits).first()
    best = free.agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum(F.col("expected_value") + F.col("affinity")), 6).alias("v"))
    counts = {r[P]: r["n"] for r in chosen.groupBy(P).agg(F.count(F.lit(1)).alias("n")).collect()}
    met = status["status"] != "infeasible"
    outside = sum(not low <= counts.get(u, 0) <= high for u, (low, high) in TIGHT.items()) if met else chosen.count()
    several = chosen.groupBy(C).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count()
    again = al.allocate(options, limits)
    differs = chosen.exceptAll(again).count()
    return best.select("customers", F.col("v").alias("best_without_limits"), F.lit(several).cast("int").alias("several"),
                       F.lit(outside).cast("int").alias("outside_limits"), F.lit(status["status"]).alias("status"),
                       F.when(F.lit(status["value"]) > F.col("v") + 1e-6, 1).otherwise(0).alias("above_best"),
                       F.lit(differs).cast("int").alias("repeated_differs"))


@query("a19_expected_total", f"""
WITH {sqlf.ALLOCATION},
sizes AS (SELECT cap.agentseqid, count(*) FILTER (WHERE c.priority = 1) AS n_attached FROM cap
  JOIN classes c ON c.customerseqid = cap.customerseqid GROUP BY cap.agentseqid),
got AS (SELECT agentseqid, sum(priority) AS attached, sum(1 - priority) AS orphan FROM chosen GROUP BY agentseqid),
capa AS (SELECT greatest(0, CASE WHEN s.n_attached > 0 THEN k.capa_max - coalesce(g.attached, 0) ELSE 0 END,
    coalesce(g.orphan, 0)) AS capa
  FROM sizes s JOIN agent_capacity k ON k.agentseqid = s.agentseqid LEFT JOIN got g ON g.agentseqid = s.agentseqid)
SELECT round(gained, 6) AS gained, round(spent, 6) AS spent, round(gained - spent, 6) AS objective FROM (
  SELECT (SELECT sum(expected_value + affinity) FROM chosen) AS gained,
    CAST((SELECT sum(capa) FROM capa) AS DOUBLE) AS spent)""")
def a19(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    chosen = cut_lineage(al.allocate(helpers.options, default_limits()))
    return al.objective(chosen, al.needed_capacity(chosen, src("agent_capacity"), d, leads))


@query("o2_check_allocation", """
SELECT * FROM (VALUES ('one_per_customer', 0), ('usecase_min', 0), ('usecase_max', 0), ('inside_domain', 0),
  ('agent_min', 0)) AS t(rule, violations)""")
def o2(src: Source) -> DataFrame:
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    chosen = cut_lineage(al.allocate(helpers.options, default_limits()))
    rows = [(u, *al.DEFAULT_LIMITS) for u, _cr, _wp in scores.EXPECTED_VALUE_RATES]
    limits = src.spark.createDataFrame(rows, "usecase string, min int, max int")
    least = dm.projections(d)["AP"].withColumn("capa_min", F.lit(0))
    return al.check_allocation(chosen, d, limits, least)


BROKEN_LIMITS = {"maturity": (0, 10), "hnw": (100_000, 200_000)}


@query("o2_check_broken", f"""
WITH {sqlf.ALLOCATION},
bad AS (SELECT customerseqid, agentseqid, usecase FROM chosen
  UNION ALL SELECT customerseqid, agentseqid, 'nowhere' FROM chosen WHERE customerseqid % 3 = 0),
n AS (SELECT usecase, count(*) AS n FROM bad GROUP BY usecase),
lim AS (SELECT * FROM (VALUES ('maturity', 0, 10), ('hnw', 100000, 200000)) AS t(usecase, low, high)),
pairs AS (SELECT DISTINCT agentseqid, usecase FROM cap)
SELECT 'one_per_customer' AS rule, (SELECT count(*) FROM (SELECT customerseqid FROM bad GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'usecase_min', (SELECT count(*) FROM lim LEFT JOIN n ON n.usecase = lim.usecase WHERE coalesce(n.n, 0) < low)
UNION ALL SELECT 'usecase_max', (SELECT count(*) FROM lim LEFT JOIN n ON n.usecase = lim.usecase WHERE coalesce(n.n, 0) > high)
UNION ALL SELECT 'inside_domain', (SELECT count(*) FROM bad WHERE usecase = 'nowhere')
UNION ALL SELECT 'agent_min', (SELECT count(*) FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM bad b
  WHERE b.agentseqid = p.agentseqid AND b.usecase = p.usecase))""")
def o2_broken(src: Source) -> DataFrame:
    """An allocation that breaks the rules: customers twice, outside the domain, limits and agents unserved."""
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    chosen = cut_lineage(al.allocate(helpers.options, default_limits()))
    extra = chosen.filter(F.col(C) % 3 == 0).withColumn(P, F.lit("nowhere"))
    limits = src.spark.createDataFrame([(u, *b) for u, b in BROKEN_LIMITS.items()], "usecase string, min int, max int")
    least = dm.projections(d)["AP"].withColumn("capa_min", F.lit(1))
    return al.check_allocation(cut_lineage(chosen.unionByName(extra)), d, limits, least)


@query("o3_allocated_counts", f"""
WITH {sqlf.ALLOCATION}
SELECT x.agentseqid, coalesce(g.n, 0) AS allocated, coalesce(g.nw, 0) AS allocated_warm
FROM (SELECT DISTINCT agentseqid FROM cap) x LEFT JOIN (
  SELECT agentseqid, count(DISTINCT customerseqid) AS n,
    count(DISTINCT CASE WHEN customerseqid IN (SELECT customerseqid FROM cw) THEN customerseqid END) AS nw
  FROM chosen GROUP BY agentseqid) g ON g.agentseqid = x.agentseqid""")
def o3(src: Source) -> DataFrame:
    made = run_stage_one(src)
    return al.allocated_counts(made[0], made[1])


def run_stage_one(src: Source) -> tuple[DataFrame, dm.Domains]:
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    return cut_lineage(al.allocate(helpers.options, default_limits())), d


@query("j14_anti_tuple", f"""
WITH {sqlf.ALLOCATION}
SELECT agentseqid, count(*) AS n_not_allocated FROM cwap x WHERE NOT EXISTS (SELECT 1 FROM chosen c
  WHERE c.customerseqid = x.customerseqid AND c.agentseqid = x.agentseqid AND c.usecase = x.usecase)
GROUP BY agentseqid""")
def j14(src: Source) -> DataFrame:
    """Warm choices without an allocated row, per agent: all of them less the allocated ones."""
    chosen, d = run_stage_one(src)
    return al.not_allocated_sizes(chosen, d)


def _warm_query(name: str, rfs: int, agency: int) -> None:
    sql = f"""
WITH {sqlf.warming(rfs, agency)}
SELECT c.customerseqid, c.agentseqid, c.usecase, round(c.expected_value, 6) AS expected_value, c.affinity, c.priority,
  CASE WHEN d.customerseqid IS NULL THEN 0 ELSE 1 END AS warming, d.warming_score
FROM chosen c LEFT JOIN done d ON d.customerseqid = c.customerseqid AND d.agentseqid = c.agentseqid
  AND d.usecase = c.usecase"""

    @query(name, sql)
    def warmed(src: Source) -> DataFrame:
        return run(src, {"rfs": rfs, "agency": agency}).result


_warm_query("o4_warm", 10000, 5000)
_warm_query("o4_warm_tight", 40, 100)
_warm_query("o6_run_allocation", 60, 5000)


@query("o4_warm_infeasible", f"""
WITH {sqlf.ALLOCATION} SELECT customerseqid, agentseqid, usecase, {CHOSEN_SQL} FROM chosen""")
def o4_infeasible(src: Source) -> DataFrame:
    """Caps below the rows that must be warmed: the allocation comes back as it was."""
    return run(src, {"rfs": 40, "agency": 2}).result


def with_flag(result: DataFrame) -> DataFrame:
    """The result of a run; where no warming plan exists nothing is warmed."""
    return result if "warming" in result.columns else result.withColumn("warming", F.lit(0))


@query("j11_join_warming_result", f"""
WITH {sqlf.warming(40, 100)}
SELECT CASE WHEN d.customerseqid IS NULL THEN 0 ELSE 1 END AS warming, count(*) AS n
FROM chosen c LEFT JOIN done d ON d.customerseqid = c.customerseqid GROUP BY 1""")
def j11(src: Source) -> DataFrame:
    result = with_flag(run(src, {"rfs": 40, "agency": 100}).result)
    return result.groupBy("warming").agg(F.count(F.lit(1)).alias("n"))


@query("o5_check_warming", """
SELECT * FROM (VALUES ('one_per_customer', 0), ('channel_cap', 0), ('opted_out', 0), ('compulsory', 0),
  ('warm_customers', 0)) AS t(rule, violations)""")
def o5(src: Source) -> DataFrame:
    capacity = {"rfs": 40, "agency": 100}
    made = run(src, capacity)
    return al.check_warming(cut_lineage(with_flag(made.result)), made.candidates, made.domains, src("agent_warming"), capacity)


@query("o5_check_broken", f"""
WITH {sqlf.ALLOCATION},
warmed AS (SELECT customerseqid, agentseqid, usecase FROM chosen WHERE customerseqid % 2 = 0
  UNION ALL SELECT customerseqid, agentseqid, usecase FROM chosen WHERE customerseqid % 6 = 0),
channels AS (SELECT DISTINCT agentseqid, channel FROM leads_master WHERE channel <> 'orphan'),
per_channel AS (SELECT channel, count(*) AS n FROM warmed JOIN channels USING (agentseqid) GROUP BY channel),
due AS (SELECT agentseqid, count(*) AS n FROM chosen WHERE agentseqid IN (SELECT agentseqid FROM agent_warming WHERE compulsory)
  GROUP BY agentseqid),
done AS (SELECT agentseqid, count(*) AS n FROM warmed GROUP BY agentseqid)
SELECT 'one_per_customer' AS rule, (SELECT count(*) FROM (SELECT customerseqid FROM warmed GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'channel_cap', (SELECT count(*) FROM per_channel WHERE channel IN ('rfs', 'agency') AND n > 1)
UNION ALL SELECT 'opted_out', (SELECT count(*) FROM warmed WHERE agentseqid IN (SELECT agentseqid FROM agent_warming WHERE opt_out))
UNION ALL SELECT 'compulsory', (SELECT count(*) FROM due LEFT JOIN done USING (agentseqid) WHERE coalesce(done.n, 0) < due.n)
UNION ALL SELECT 'warm_customers', (SELECT count(*) FROM warmed WHERE customerseqid NOT IN
  (SELECT customerseqid FROM leads_master WHERE customertype = 'fullyorphan' OR underservedflag = 'Y'))""")
def o5_broken(src: Source) -> DataFrame:
    """A warming plan that breaks the rules: every other customer, some of them twice, whoever the agent is."""
    leads, d = leads_and_domains(src)
    helpers = build_helpers(leads, d, src("cust_master"), src("agent_master"))
    chosen = cut_lineage(al.allocate(helpers.options, default_limits()))
    warmed = chosen.filter(F.col(C) % 2 == 0).unionByName(chosen.filter(F.col(C) % 6 == 0)).withColumn("warming", F.lit(1))
    agents = src("agent_warming")
    due = chosen.join(agents.filter("compulsory").select(A, "compulsory"), A)
    return al.check_warming(cut_lineage(warmed), due, d, agents, {"rfs": 1, "agency": 1})
