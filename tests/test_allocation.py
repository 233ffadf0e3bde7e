from __future__ import annotations

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadloom.operators import allocation as al
from leadloom.operators import domains as dm
from leadloom.operators import relate, scores
from leadloom.operators.limited import LimitedChoice
from leadloom.plans.lead_run import build_helpers, run_allocation

LEADS = ("customerseqid long, agentseqid long, usecase string, customertype string, orphanoptinflag string, "
         "underservedflag string, channel string, percentile int, days_underserved double, wpi double")
USECASES = ("fpp", "hnw", "xsell_life_hi")


def small_case(spark, seed: int, customers: int = 5, agents: int = 4):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(customers):
        kind = ("fullyorphan", "notorphan", "partialorphan")[rng.integers(3)]
        percentile = {u: int(rng.integers(1, 40)) for u in USECASES}
        for _ in range(rng.integers(1, 4)):
            a, u = int(rng.integers(agents)), USECASES[rng.integers(len(USECASES))]
            rows.append((c, a, u, kind, "Y" if a % 2 == 0 else "N", "Y" if c % 2 else "N",
                         ("rfs", "agency", "orphan")[a % 3], percentile[u], None if c == 0 else float(c), float(seed + c)))
    leads = spark.createDataFrame(rows, LEADS)
    people = spark.createDataFrame(
        [(c, int(rng.integers(3)), ("en", "fr", None)[rng.integers(3)], int(rng.integers(3)), int(rng.integers(20, 60)))
         for c in range(customers)],
        "customerseqid long, customer_hid int, customer_language string, customer_postal_sector int, customer_age int")
    team = []
    for a in range(agents):
        traits = (("en", "fr")[rng.integers(2)], int(rng.integers(3)), int(rng.integers(20, 60)))
        team += [(a, int(h), *traits) for h in set(rng.integers(0, 3, 2))]
    team = spark.createDataFrame(
        team, "agentseqid long, agent_hid int, agent_language string, agent_postal_sector int, agent_age int")
    capacity = spark.createDataFrame([(a, int(rng.integers(0, 4))) for a in range(agents)], "agentseqid long, capa_max int")
    return rows, leads, people, team, capacity


def all_triples(rows) -> set[tuple]:
    optin = {r[1] for r in rows if r[4] == "Y"}
    pairs = {(r[0], r[1]) for r in rows if r[3] != "fullyorphan"}
    pairs |= {(r[0], a) for r in rows if r[3] == "fullyorphan" for a in optin}
    return {(c, a, r[2]) for c, a in pairs for r in rows if r[0] == c}


def plain_affinity(people, team, age_rule="as_coded") -> dict:
    who, them = people.collect(), team.collect()
    homes = {(t["agentseqid"], t["agent_hid"]) for t in them}
    traits = {t["agentseqid"]: t for t in them}
    out = {}
    for p in who:
        for a, t in traits.items():
            same = lambda x, y: int(x is not None and y is not None and x == y)
            age = 1 if age_rule == "as_coded" else int(abs(p["customer_age"] - t["agent_age"]) <= 5)
            out[p["customerseqid"], a] = 100 * (
                same(p["customer_language"], t["agent_language"])
                + same(p["customer_postal_sector"], t["agent_postal_sector"]) + age
                + int((a, p["customer_hid"]) in homes))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_factors_count_what_the_product_holds(spark, seed):
    rows, leads, *_ = small_case(spark, seed, 8, 5)
    d = dm.build_domains(leads)
    triples = all_triples(rows)
    pairs = {(c, a) for c, a, _p in triples}
    assert {r[0]: r["n_customers"] for r in dm.customers_per_agent(d).collect()} == {
        a: sum(x == a for _c, x in pairs) for _c, a in pairs}
    assert {(r[0], r[1]): r["n_customers"] for r in dm.customers_per_agent_usecase(d).collect()} == {
        (a, p): sum((x, y) == (a, p) for _c, x, y in triples) for _c, a, p in triples}
    assert {r[0]: r["n_triples"] for r in dm.triples_per_customer(d).collect()} == {
        c: sum(x == c for x, _a, _p in triples) for c, _a, _p in triples}


def test_a_customer_of_both_kinds_counts_each_pair_once(spark):
    rows = [(1, 10, "fpp", "fullyorphan", "Y", "N", "rfs", 5, None, None),
            (1, 10, "hnw", "notorphan", "Y", "N", "rfs", 5, None, None),
            (1, 11, "hnw", "notorphan", "N", "N", "rfs", 5, None, None)]
    d = dm.build_domains(spark.createDataFrame(rows, LEADS))
    assert {r[0]: r["n_agents"] for r in dm.agents_per_customer(d).collect()} == {1: 2}


def test_no_agent_opted_in(spark):
    rows = [(1, 10, "fpp", "fullyorphan", "N", "N", "rfs", 5, None, None)]
    leads = spark.createDataFrame(rows, LEADS)
    d = dm.build_domains(leads)
    assert dm.agents_per_customer(d).count() == 0
    assert dm.customers_per_agent_usecase(d).count() == 0
    _rows, _leads, people, team, _capacity = small_case(spark, 0)
    assert scores.best_agent(d, people, team).count() == 0


@pytest.mark.parametrize("age_rule", ["as_coded", "difference"])
@pytest.mark.parametrize("seed", range(3))
def test_best_agent_is_the_best_of_all_pairs(spark, seed, age_rule):
    rows, leads, people, team, _capacity = small_case(spark, seed, 8, 6)
    affinity = plain_affinity(people, team, age_rule)
    expected = {}
    for c, a in sorted({(c, a) for c, a, _p in all_triples(rows)}):
        if c not in expected or affinity[c, a] > expected[c][1]:
            expected[c] = (a, affinity[c, a])
    found = scores.best_agent(dm.build_domains(leads), people, team, age_rule).collect()
    assert {r["customerseqid"]: (r["agentseqid"], r["affinity"]) for r in found} == expected


def plain_value(rows) -> dict:
    rates = {u: cr * wp * 1000 for u, cr, wp in scores.EXPECTED_VALUE_RATES}
    return {(r[0], r[2]): (1 - r[7] / 20) * rates[r[2]] for r in rows}


def plain_objective(chosen, rows, value, affinity, capacity) -> float:
    """Value + affinity less the least capacity that satisfies both capacity rules."""
    orphan = {r[0] for r in rows if r[3] == "fullyorphan"}
    triples = all_triples(rows)
    spent = 0
    for a in {a for _c, a, _p in triples}:
        mine = [x for x in chosen if x[1] == a]
        attached = sum(x[0] not in orphan for x in mine)
        has_attached = any(x[1] == a and x[0] not in orphan for x in triples)
        rest = capacity[a] - attached if has_attached else 0
        spent += max(0, rest, len(mine) - attached)
    return sum(value[c, p] + affinity[c, a] for c, a, p in chosen) - spent


@pytest.mark.parametrize("seed", range(4))
def test_allocation_is_within_one_unit_per_customer_of_the_best(spark, seed):
    rows, leads, people, team, capacity = small_case(spark, seed, 4, 3)
    value, affinity = plain_value(rows), plain_affinity(people, team)
    room = {r[0]: r[1] for r in capacity.collect()}
    triples = sorted(all_triples(rows))
    per_customer = {c: [None] + [t for t in triples if t[0] == c] for c in {t[0] for t in triples}}
    best = max(plain_objective([t for t in plan if t], rows, value, affinity, room)
               for plan in product(*per_customer.values()))
    d = dm.build_domains(leads)
    chosen = al.allocate(build_helpers(leads, d, people, team).options).collect()
    picks = [(r["customerseqid"], r["agentseqid"], r["usecase"]) for r in chosen]
    ours = plain_objective(picks, rows, value, affinity, room)
    assert best - len(per_customer) <= ours <= best + 1e-6
    table = al.objective(spark.createDataFrame(chosen) if chosen else leads.sparkSession.createDataFrame(
        [], "customerseqid long, agentseqid long, usecase string, expected_value double, affinity int, priority int"),
        al.needed_capacity(al.allocate(build_helpers(leads, d, people, team).options), capacity, d, leads)).first()
    assert table["objective"] == pytest.approx(ours)


def options_frame(spark, n: int, seed: int):
    rng = np.random.default_rng(seed)
    rows = [(c, u, c % 7, float(np.round(rng.normal(50, 40), 3)), 0, 1) for c in range(n) for u in ("p", "q", "r")]
    df = spark.createDataFrame(rows, "customerseqid long, usecase string, agentseqid long, expected_value double, affinity int, priority int")
    return df.withColumn("score", F.col("expected_value") + F.col("affinity"))


@pytest.mark.parametrize("bounds", [{"p": (0, 20), "q": (0, 15)}, {"p": (0, 5), "q": (0, 5), "r": (0, 5)},
                                    {"r": (60, 100)}, {"p": (0, 20), "q": (40, 50)}])
def test_limits_that_bind_are_kept_at_the_best_value(spark, bounds):
    options = options_frame(spark, 100, 3)
    limits = al.Limits(bounds)
    chosen = al.allocate(options, limits).cache()
    rows = chosen.collect()
    assert len({r["customerseqid"] for r in rows}) == len(rows)
    counts = {u: sum(r["usecase"] == u for r in rows) for u in "pqr"}
    for u, (least, most) in bounds.items():
        assert least <= counts[u] <= most
    status = al.allocation_status(options, chosen, limits).first()
    assert status["status"] == "optimal" and status["value"] == pytest.approx(sum(r["expected_value"] for r in rows))


def best_total(scores, bounds):
    """Brute force: the greatest total of one use case or none per customer within the bounds; None if there is none."""
    best = None
    for plan in product(*[[None, *own] for own in scores.values()]):
        if all(low <= plan.count(u) <= (len(plan) if high is None else high) for u, (low, high) in bounds.items()):
            total = sum(own[u] for own, u in zip(scores.values(), plan) if u)
            best = total if best is None else max(best, total)
    return best


def scored(spark, scores):
    rows = [(c, u, 0, float(x), 0, 1, float(x)) for c, own in scores.items() for u, x in own.items()]
    return spark.createDataFrame(rows, "customerseqid long, usecase string, agentseqid long, expected_value double, "
                                       "affinity int, priority int, score double")


@pytest.mark.parametrize("seed", range(12))
def test_limits_against_brute_force_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    scores = {c: {u: int(rng.integers(-1, 4)) for u in "pqr" if rng.random() < 0.8} for c in range(7)}
    scores = {c: own for c, own in scores.items() if own}
    bounds = {}
    for u in rng.permutation(list("pqr"))[:1 + seed % 3]:
        low = int(rng.integers(0, 3)) if seed % 2 else 0
        bounds[str(u)] = (low, None if rng.random() < 0.2 else low + int(rng.integers(0, 3)))
    expected = best_total(scores, bounds)
    options, limits = scored(spark, scores), al.Limits(bounds)
    rows = al.allocate(options, limits).collect()
    status = al.allocation_status(options, al.allocate(options, limits), limits).first()
    if expected is None:
        assert not rows and status["status"] == "infeasible"
        return
    counts = {u: sum(r["usecase"] == u for r in rows) for u in "pqr"}
    assert all(low <= counts[u] and (high is None or counts[u] <= high) for u, (low, high) in bounds.items())
    assert len({r["customerseqid"] for r in rows}) == len(rows)
    assert sum(r["expected_value"] for r in rows) == expected
    assert (status["status"], status["value"], status["bound"]) == ("optimal", expected, expected)


def test_customers_that_tie_at_the_limit(spark):
    scores = {c: {"maturity": 10, "hnw": 7} for c in range(10)} | {c: {"maturity": 1} for c in range(10, 13)}
    rows = al.allocate(scored(spark, scores), al.Limits({"maturity": (0, 4)})).collect()
    assert sum(r["expected_value"] for r in rows) == 82
    assert sum(r["usecase"] == "maturity" for r in rows) == 4


def test_large_limits_by_equal_customers(spark):
    """Thousands of equal customers are one class and are dealt by key."""
    options = spark.range(6000).select(
        F.col("id").alias("customerseqid"), F.explode(F.array(F.struct(F.lit("p").alias("u"), F.lit(5.0).alias("s")),
                                                              F.struct(F.lit("q").alias("u"), F.lit(3.0).alias("s")),
                                                              F.struct(F.lit("r").alias("u"), F.lit(3.0).alias("s")))).alias("o"))
    options = options.select("customerseqid", F.col("o.u").alias("usecase"), F.lit(0).alias("agentseqid"),
                             F.col("o.s").alias("expected_value"), F.lit(0).alias("affinity"), F.lit(1).alias("priority"),
                             F.col("o.s").alias("score"))
    rows = al.allocate(options, al.Limits({"p": (0, 2500), "q": (2000, 2000), "r": (0, 700)}))
    assert {r["usecase"]: r["count"] for r in rows.groupBy("usecase").count().collect()} == {"p": 2500, "q": 2000, "r": 700}


def test_a_large_class_of_high_values(spark):
    """What a class gets in all, in units, passes 64 bits: 30,000 customers of 840,000 * 10 ** 9."""
    one = spark.range(30_000).select(
        F.col("id").alias("customerseqid"), F.lit("p").alias("usecase"), F.lit(0).alias("agentseqid"),
        F.lit(840_000.0).alias("expected_value"), F.lit(0).alias("affinity"), F.lit(1).alias("priority"), F.lit(840_000.0).alias("score"))
    limits = al.Limits({"p": (0, 20_000)})
    chosen = al.allocate(one, limits)
    assert chosen.count() == 20_000
    status = al.allocation_status(one, chosen, limits).first()
    assert (status["status"], status["value"], status["bound"]) == ("optimal", 1.68e10, 1.68e10)


@pytest.mark.parametrize("most", [5, 300, 20_000])
def test_counts_by_worth_lead_to_the_prices_of_plain_rounds(spark, monkeypatch, most):
    """Counts that serve many rounds give the masks, and so the prices, of one job per round, with far fewer jobs."""
    rng = random.Random(most)
    for limited, n, spread in ((3, 400, 10 ** 6), (6, 300, 10 ** 4), (2, 200, 8)):
        names = [chr(97 + i) for i in range(limited + 1)]
        rows = [(c, u, rng.randrange(-spread // 4, spread) / 10 ** 5) for c in range(n) for u in names if rng.random() < 0.7]
        bounds = {u: (rng.choice([0, 5, n // 10]), n // 8 + i) for i, u in enumerate(names[:-1])}
        found, jobs = [], []
        for limit in (0, most):
            calls = []
            choice = LimitedChoice(spark.createDataFrame(rows, "c int, usecase string, score double"), "c", "usecase", bounds)
            near, masks = choice._near, choice._masks
            monkeypatch.setattr(choice, "_near", lambda *a: calls.append("near") or near(*a, most=limit) if limit else None)
            monkeypatch.setattr(choice, "_masks", lambda *a: calls.append("masks") or masks(*a))
            found.append(choice.solve())
            jobs.append(len(calls))
        assert found[0] == found[1] and any(found[0].prices)
        assert most < 20_000 or jobs[1] <= 10 < jobs[0] or spread < 10 ** 4


def test_rounds_follow_the_digits_of_the_values(spark, monkeypatch):
    """Eight use cases of like worth that all bind: a few rounds per binary digit, not one per rival price."""
    rates = {"p": 320, "q": 840, "r": 300, "s": 104, "t": 7, "u": 122, "v": 13, "w": 65}
    rows = [(c, u, 0, 0.0, 0, 1, round((1 - ((c * 31 + i * 7) % 100 + 1) / 20) * rate * 1000 + c % 5 * 100, 3))
            for c in range(800) for i, (u, rate) in enumerate(rates.items()) if (c + i) % 3]
    options = spark.createDataFrame(rows, "customerseqid long, usecase string, agentseqid long, expected_value double, "
                                          "affinity int, priority int, score double").withColumn("expected_value", F.col("score"))
    rounds = []
    masks = LimitedChoice._masks
    monkeypatch.setattr(LimitedChoice, "_masks", lambda self, *args: rounds.append(args) or masks(self, *args))
    limits = al.Limits(dict.fromkeys(rates, (20, 30)))
    chosen = al.allocate(options, limits).cache()
    counts = {r["usecase"]: r["count"] for r in chosen.groupBy("usecase").count().collect()}
    assert set(counts) == set(rates) and all(20 <= n <= 30 for n in counts.values())
    assert len(rounds) <= 4 * 60
    assert al.allocation_status(options, chosen, limits).first()["status"] == "optimal"


def test_a_minimum_that_cannot_be_met_gives_no_rows(spark):
    assert al.allocate(options_frame(spark, 10, 1), al.Limits({"p": (11, 20)})).count() == 0


def test_minimums_are_met_along_a_chain(spark):
    rows = [(1, "p", 0, 5.0, 0, 1, 5.0), (1, "q", 0, 9.0, 0, 1, 9.0), (2, "q", 0, 1.0, 0, 1, 1.0), (2, "r", 0, 8.0, 0, 1, 8.0)]
    options = spark.createDataFrame(rows, "customerseqid long, usecase string, agentseqid long, expected_value double, "
                                          "affinity int, priority int, score double")
    chosen = al.allocate(options, al.Limits({"p": (1, 9), "q": (1, 9)}))
    assert {(r["customerseqid"], r["usecase"]) for r in chosen.collect()} == {(1, "p"), (2, "q")}
    status = al.allocation_status(options, chosen, al.Limits({"p": (1, 9), "q": (1, 9)})).first()
    assert (status["status"], status["leads"], status["value"], status["bound"]) == ("optimal", 2, 6.0, 6.0)
    assert al.allocate(options, al.Limits({"p": (2, 9)})).count() == 0


def test_negative_options_are_not_taken(spark):
    options = options_frame(spark, 10, 1).withColumn("score", F.lit(-1.0))
    assert al.allocate(options).count() == 0


CANDIDATES = "customerseqid long, agentseqid long, usecase string, channel string, compulsory boolean, warming_score long, gain double"


@pytest.mark.parametrize("seed", range(5))
def test_warming_matches_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(c, int(rng.integers(4)), "fpp") for c in range(7)]
    channel = {a: ("rfs", "agency", None)[rng.integers(3)] for a in range(4)}
    must = {a: bool(rng.random() < 0.3) for a in range(4)}
    cand = [(*r, channel[r[1]], must[r[1]], 1, float(rng.integers(-3, 9))) for r in rows]
    caps = {"rfs": int(rng.integers(0, 3)), "agency": int(rng.integers(0, 3))}
    best = None
    for picks in product((0, 1), repeat=len(cand)):
        if any(x[4] and not y for x, y in zip(cand, picks)):
            continue
        if any(sum(y for x, y in zip(cand, picks) if x[3] == t) > cap for t, cap in caps.items()):
            continue
        gain = sum(x[6] for x, y in zip(cand, picks) if y)
        best = gain if best is None else max(best, gain)
    plan = al.warm_plan(spark.createDataFrame(cand, CANDIDATES), caps)
    if best is None:
        assert plan is None
    else:
        assert sum(r["gain"] for r in plan.collect()) == best


def test_full_run_keeps_every_rule(spark):
    rows, leads, people, team, _capacity = small_case(spark, 11, 30, 6)
    flags = spark.createDataFrame([(a, a == 0, a == 1) for a in range(6)], "agentseqid long, opt_out boolean, compulsory boolean")
    caps = {"rfs": 100, "agency": 2}
    run = run_allocation(leads, people, team, flags, capacity=caps)
    limits = spark.createDataFrame([(u, 0, 4000) for u in USECASES], "usecase string, min int, max int")
    assert all(r["violations"] == 0 for r in al.check_allocation(run.allocation, run.domains, limits).collect())
    checked = al.check_warming(run.result, run.candidates, run.domains, flags, caps).collect()
    assert {r["rule"]: r["violations"] for r in checked if r["violations"]} == {}
    assert run.result.count() == run.allocation.count()


def test_conflicting_agent_flags_fail(spark):
    rows, leads, people, team, _capacity = small_case(spark, 11, 10, 4)
    flags = spark.createDataFrame([(a, True, True) for a in range(4)], "agentseqid long, opt_out boolean, compulsory boolean")
    with pytest.raises(Exception, match="both opted out and compulsory"):
        run_allocation(leads, people, team, flags).result.collect()


@pytest.mark.parametrize("age_rule", ["as_coded", "difference"])
def test_many_pairs_are_dealt_to_bounded_tasks(spark, partitions, monkeypatch, age_rule):
    """Affinities stay the same, and no task holds many more rows than are allowed."""
    people = spark.range(400).select(
        F.col("id").alias("customerseqid"), (F.col("id") % 9).alias("customer_hid"), F.lit("en").alias("customer_language"),
        (F.col("id") % 4).alias("customer_postal_sector"), (20 + F.col("id") % 30).cast("int").alias("customer_age"))
    agents = spark.range(60).select(
        (F.col("id") % 20).alias("agentseqid"), (F.col("id") % 12).alias("agent_hid"),
        F.when(F.col("id") % 20 % 2 == 0, "en").alias("agent_language"), (F.col("id") % 20 % 4).alias("agent_postal_sector"),
        (25 + F.col("id") % 20).cast("int").alias("agent_age"))
    pairs = people.select("customerseqid", F.explode(F.array(*[(F.col("customerseqid") * 7 + i) % 21 for i in range(5)])).alias("agentseqid"))
    partitions(4)
    plain = {tuple(r) for r in scores.affinity(pairs, people, agents, age_rule).collect()}
    monkeypatch.setattr(relate, "ROWS_PER_TASK", 100)
    found = scores.affinity(pairs, people, agents, age_rule)
    assert {tuple(r) for r in found.collect()} == plain and len(plain) == 2000
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 15 and max(sizes) < 300


def test_a_result_without_a_warming_plan_has_nothing_warmed(spark):
    from leadloom.catalog.leads_q import with_flag

    assert [r["warming"] for r in with_flag(spark.range(2)).collect()] == [0, 0]
    assert [r["warming"] for r in with_flag(spark.range(1).withColumn("warming", F.lit(1))).collect()] == [1]
