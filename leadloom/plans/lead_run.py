"""Allocation and warming from the lead and master tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from leadloom.operators import allocation as al
from leadloom.operators.domains import Domains, build_domains, customer_class
from leadloom.operators.scores import best_agent, expected_value, priority_table, rates_table, warming_score
from leadloom.session import cut_lineage


@dataclass(frozen=True)
class Helpers:
    """What the two stages read: one row per (customer, use case), and scores on demand."""

    values: DataFrame
    best: DataFrame
    classes: DataFrame
    options: DataFrame


@dataclass(frozen=True)
class LeadRun:
    domains: Domains
    helpers: Helpers
    allocation: DataFrame
    candidates: DataFrame
    result: DataFrame


def build_helpers(leads: DataFrame, d: Domains, customers: DataFrame, agents: DataFrame,
                  rates: DataFrame | None = None, age_rule: str = "as_coded") -> Helpers:
    values = expected_value(leads, rates if rates is not None else rates_table(leads.sparkSession))
    best = best_agent(d, customers, agents, age_rule)
    classes = customer_class(leads)
    return Helpers(values, best, classes, al.customer_options(values, best, classes))


def run_allocation(leads: DataFrame, customers: DataFrame, agents: DataFrame, warming_agents: DataFrame,
                   limits: al.Limits | None = None, capacity: dict[str, int] | None = None,
                   rates: DataFrame | None = None, priorities: DataFrame | None = None,
                   age_rule: str = "as_coded", digits: int | None = None) -> LeadRun:
    """Domains, scores, allocation and warming in order.

    Every step reads ``leads``: pass a stored table, and write a costly query to one first.
    """
    spark = leads.sparkSession
    d = build_domains(leads).stored()
    helpers = build_helpers(leads, d, customers, agents, rates, age_rule)
    chosen = cut_lineage(al.allocate(helpers.options, limits))
    scores = warming_score(leads, chosen.select("customerseqid", "agentseqid", "usecase"),
                           priorities if priorities is not None else priority_table(spark), digits)
    candidates = al.warming_candidates(chosen, d, scores, warming_agents)
    return LeadRun(d, helpers, chosen, candidates, al.warm(chosen, candidates, capacity))
