"""Customer x agent x use-case domains, kept as factors.

Orphan customers may go to any agent who opted in, so the pairs of customers and agents are the attached pairs plus a
full product. The product is never written out: it is held as its two sides, and counts, projections and best choices
are computed from the sides. Each result equals the one over all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.scalars import flag, one_value
from leadloom.operators.relate import semi_rows
from leadloom.session import cut_lineage

# Codes in the lead table.
ATTACHED_TYPES = ("notorphan", "partialorphan")
ORPHAN_TYPE = "fullyorphan"
NO_CHANNEL = "orphan"

C, A, P = "customerseqid", "agentseqid", "usecase"


@dataclass(frozen=True)
class Domains:
    """Factors of the domain.

    ``attached`` (customer, agent) pairs that are not already in the orphan product; ``orphans`` customers;
    ``optin`` agents; ``wants`` (customer, use case) pairs; ``warm`` customers; ``channels`` (agent, channel).
    """

    attached: DataFrame
    orphans: DataFrame
    optin: DataFrame
    wants: DataFrame
    warm: DataFrame
    channels: DataFrame

    def stored(self) -> Domains:
        """The factors written once, for runs that read them many times."""
        return Domains(**{f.name: cut_lineage(getattr(self, f.name)) for f in fields(self)})

    @property
    def n_optin(self) -> Column:
        return one_value(self.optin.agg(F.count(F.lit(1)).alias("n")), "n")

    @property
    def n_orphans(self) -> Column:
        return one_value(self.orphans.agg(F.count(F.lit(1)).alias("n")), "n")


def is_orphan() -> Column:
    return F.col("customertype") == ORPHAN_TYPE


def is_warm() -> Column:
    return is_orphan() | (F.col("underservedflag") == "Y")


def build_domains(leads: DataFrame) -> Domains:
    """All factors from the lead table."""
    orphans = leads.filter(is_orphan()).select(C).distinct()
    optin = leads.filter(F.col("orphanoptinflag") == "Y").select(A).distinct()
    attached = leads.filter(F.col("customertype").isin(*ATTACHED_TYPES)).select(C, A).distinct()
    # A customer with both kinds of rows has some pairs in the orphan product already.
    attached = (
        attached.join(orphans.withColumn("_o", F.lit(True)), C, "left")
        .join(optin.withColumn("_i", F.lit(True)), A, "left")
        .filter(F.col("_o").isNull() | F.col("_i").isNull())
        .select(C, A)
    )
    return Domains(
        attached=attached,
        orphans=orphans,
        optin=optin,
        wants=leads.select(C, P).distinct(),
        warm=leads.filter(is_warm()).select(C).distinct(),
        channels=leads.filter(F.col("channel") != NO_CHANNEL).select(A, "channel").distinct(),
    )


def agents_per_customer(d: Domains) -> DataFrame:
    """Number of agents each customer may go to; customers without any are left out."""
    own = d.attached.groupBy(C).agg(F.count(F.lit(1)).alias("n"))
    product = d.orphans.select(C, d.n_optin.alias("n"))
    return own.unionByName(product).groupBy(C).agg(F.sum("n").alias("n_agents")).filter("n_agents > 0")


def customers_per_agent(d: Domains) -> DataFrame:
    """Number of customers each agent may serve."""
    own = d.attached.groupBy(A).agg(F.count(F.lit(1)).alias("n"))
    product = d.optin.select(A, d.n_orphans.alias("n"))
    return own.unionByName(product).groupBy(A).agg(F.sum("n").alias("n_customers")).filter("n_customers > 0")


def triples_per_customer(d: Domains, warm_only: bool = False) -> DataFrame:
    """Agents, use cases and (agent, use case) choices per customer."""
    wants = semi_rows(d.wants, d.warm, [C]) if warm_only else d.wants
    cases = wants.groupBy(C).agg(F.count(F.lit(1)).alias("n_usecases"))
    return agents_per_customer(d).join(cases, C).select(
        C, "n_agents", "n_usecases", (F.col("n_agents") * F.col("n_usecases")).alias("n_triples"))


def _cells_of_orphans(d: Domains, wants: DataFrame) -> DataFrame:
    """(use case, orphan customers); at most one row per use case."""
    return semi_rows(wants, d.orphans, [C]).groupBy(P).agg(F.count(F.lit(1)).alias("n_orphans"))


def customers_per_agent_usecase(d: Domains, warm_only: bool = False) -> DataFrame:
    """Number of customers per (agent, use case)."""
    wants = semi_rows(d.wants, d.warm, [C]) if warm_only else d.wants
    own = d.attached.join(wants, C).groupBy(A, P).agg(F.count(F.lit(1)).alias("n"))
    # One row per use case as a single array value, so every agent gets its few rows without a join.
    cells = _cells_of_orphans(d, wants).agg(F.collect_list(F.struct(P, "n_orphans")).alias("cells"))
    product = d.optin.withColumn("_cells", one_value(cells, "cells")).select(
        A, F.explode("_cells").alias("cell")).select(A, F.col("cell")[P].alias(P), F.col("cell")["n_orphans"].alias("n"))
    return own.unionByName(product).groupBy(A, P).agg(F.sum("n").alias("n_customers"))


def pairs_per_usecase(d: Domains) -> DataFrame:
    """Number of (customer, agent) pairs per use case."""
    return customers_per_agent_usecase(d).groupBy(P).agg(F.sum("n_customers").alias("n_pairs"))


def customer_class(leads: DataFrame) -> DataFrame:
    """One customer type per customer, the first in name order, and whether that makes the customer an orphan."""
    first = leads.groupBy(C).agg(F.min("customertype").alias("customertype"))
    return first.withColumn("priority", F.when(is_orphan(), 0).otherwise(1))


def attached_orphan_sizes(leads: DataFrame, d: Domains) -> DataFrame:
    """Per agent, (customer, use case) choices of attached and of orphan customers."""
    kind = customer_class(leads).select(C, "priority")
    own = d.attached.join(d.wants, C).join(kind, C).groupBy(A).agg(
        F.sum("priority").alias("n_attached"), F.sum(1 - F.col("priority")).alias("n_orphan"))
    cases = semi_rows(d.wants, d.orphans, [C]).join(kind, C).agg(
        F.coalesce(F.sum("priority"), F.lit(0)).alias("a"),
        F.coalesce(F.sum(1 - F.col("priority")), F.lit(0)).alias("o"))
    product = d.optin.select(A, one_value(cases, "a").alias("n_attached"), one_value(cases, "o").alias("n_orphan"))
    return own.unionByName(product).groupBy(A).agg(
        F.sum("n_attached").alias("n_attached"), F.sum("n_orphan").alias("n_orphan")).filter(
        "n_attached + n_orphan > 0")


def projections(d: Domains) -> dict[str, DataFrame]:
    """The sets of customers, agents, use cases, (agent, use case), (customer, use case) and (agent, channel)."""
    customers = agents_per_customer(d).select(C).join(d.wants.select(C).distinct(), C, "left_semi")
    agent_cases = customers_per_agent_usecase(d).select(A, P)
    return {
        "C": customers,
        "A": agent_cases.select(A).distinct(),
        "P": agent_cases.select(P).distinct(),
        "AP": agent_cases,
        "CP": semi_rows(d.wants, customers, [C]),
        "AT": d.channels,
    }


def warm_sizes(d: Domains, per: str) -> DataFrame:
    """Warm (customer, use case) choices per agent or per channel (``per`` is "agent" or "channel")."""
    by_agent = customers_per_agent_usecase(d, warm_only=True).groupBy(A).agg(F.sum("n_customers").alias("n_choices"))
    if per == "agent":
        return by_agent
    return by_agent.join(d.channels, A).groupBy("channel").agg(F.sum("n_choices").alias("n_choices"))


def contains(d: Domains, rows: DataFrame) -> DataFrame:
    """Add ``in_domain`` to (customer, agent, use case) rows."""
    return (
        rows.join(d.attached.withColumn("_a", F.lit(True)), [C, A], "left")
        .join(d.orphans.withColumn("_o", F.lit(True)), C, "left")
        .join(d.optin.withColumn("_i", F.lit(True)), A, "left")
        .join(d.wants.withColumn("_w", F.lit(True)), [C, P], "left")
        .withColumn("in_domain", flag((F.col("_a") | (F.col("_o") & F.col("_i"))) & F.col("_w")))
        .drop("_a", "_o", "_i", "_w")
    )
