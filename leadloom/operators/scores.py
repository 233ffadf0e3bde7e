"""Expected value, affinity, best agent and warming score."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.functions.scalars import flag, matches
from leadloom.operators.domains import A, C, P, Domains
from leadloom.operators.ranks import QuantileBins
from leadloom.operators.relate import by_key, dealt, look_up, small_side, task_count, unique_by
from leadloom.session import cut_lineage

# Conversion rate, weighted premium and priority per use case. Expected value and warming use
# different conversion rates for one use case, so they are two tables.
EXPECTED_VALUE_RATES = (
    ("fpp", 0.08, 4000),
    ("maturity", 0.2, 4200),
    ("hnw", 0.05, 6000),
    ("upsell_life_hp", 0.02, 5200),
    ("xsell_health_gi", 0.001, 700),
    ("upsell_life_rp", 0.002, 6100),
    ("xsell_health_life", 0.001, 1300),
    ("xsell_life_hi", 0.001, 6500),
)
USECASE_PRIORITIES = (
    ("fpp", 1),
    ("maturity", 2),
    ("hnw", 3),
    ("upsell_life_hp", 5),
    ("xsell_health_gi", 7),
    ("upsell_life_rp", 4),
    ("xsell_health_life", 6),
    ("xsell_life_hi", 8),
)
AGE_GAP = 5
MISSING_DAYS = 9999


def rates_table(spark: SparkSession, rates: tuple = EXPECTED_VALUE_RATES) -> DataFrame:
    return spark.createDataFrame([(u, float(cr), float(wp)) for u, cr, wp in rates], "usecase string, cr double, wp double")


def priority_table(spark: SparkSession, priorities: tuple = USECASE_PRIORITIES) -> DataFrame:
    return spark.createDataFrame(list(priorities), "usecase string, priority int")


def expected_value(leads: DataFrame, rates: DataFrame) -> DataFrame:
    """Expected value per (customer, use case); negative above percentile 20.

    Fails when a pair has several percentiles or a use case has no rate.
    """
    pairs = unique_by(leads, [C, P], ["percentile"], "lead percentile")
    priced = pairs.join(small_side(rates.withColumn("_hit", F.lit(True))), P, "left")
    percentile = F.col("percentile").cast("double")
    value = (1 - percentile / 20.0) * F.col("wp") * F.col("cr") * 1000.0
    known = F.when(F.col("_hit").isNull(), F.raise_error(F.lit("use case without a rate")).cast("double"))
    return priced.select(C, P, known.otherwise(value).alias("expected_value"))


# Affinity


def _agent_traits(agents: DataFrame) -> DataFrame:
    """One row of traits per agent, the households left out."""
    traits = ["agent_language", "agent_postal_sector", "agent_age"]
    return unique_by(agents, [A], traits, "agent master")


def _customer_traits(customers: DataFrame) -> DataFrame:
    traits = ["customer_language", "customer_postal_sector", "customer_age"]
    return unique_by(customers, [C], traits, "customer master")


def _age_points(rule: str) -> Column:
    if rule == "as_coded":
        return F.lit(1)
    if rule == "difference":
        return flag(F.abs(F.col("customer_age") - F.col("agent_age")) <= AGE_GAP)
    raise ValueError(f"unknown age rule {rule!r}")


def _household_rows(pairs: DataFrame, customers: DataFrame, agents: DataFrame, tasks: int | None) -> DataFrame:
    """A row per pair and household of the customer; ``_h`` is 1 where the agent serves it, else null."""
    homes = customers.select(C, F.col("customer_hid").alias("hid")).distinct()
    served = agents.select(A, F.col("agent_hid").alias("hid"), F.lit(1).alias("_h")).distinct()
    rows = dealt(pairs, tasks, C).join(by_key(homes, tasks), C, "left")
    return dealt(rows, tasks, A, "hid").join(served, [A, "hid"], "left").select(C, A, "_h")


def household_pairs(pairs: DataFrame, customers: DataFrame, agents: DataFrame) -> DataFrame:
    """Per (customer, agent) pair, 1 when the agent serves one of the customer's households."""
    pairs = cut_lineage(pairs)
    tasks = task_count(pairs)
    return dealt(_household_rows(pairs, customers, agents, tasks), tasks, C).groupBy(C, A).agg(
        F.coalesce(F.max("_h"), F.lit(0)).alias("hh_service"))


def affinity(pairs: DataFrame, customers: DataFrame, agents: DataFrame, age_rule: str = "as_coded") -> DataFrame:
    """100 points each for language, postal sector, age and a served household, for the given pairs.

    With ``age_rule="as_coded"`` the age point is always given; ``"difference"`` gives it within five years. The pairs are
    written once, and many of them are dealt by household, by agent and by customer to tasks of bounded size.
    """
    points = matches(F.col("customer_language"), F.col("agent_language"))
    points += matches(F.col("customer_postal_sector"), F.col("agent_postal_sector"))
    pairs = cut_lineage(pairs)
    tasks = task_count(pairs)
    rows = dealt(_household_rows(pairs, customers, agents, tasks), tasks, A).join(_agent_traits(agents), A, "left")
    rows = dealt(rows, tasks, C).join(by_key(_customer_traits(customers), tasks), C, "left")
    # All rows of a pair have the same points.
    return rows.select(C, A, "_h", (points + _age_points(age_rule)).alias("points")).groupBy(C, A).agg(
        ((F.max("points") + F.coalesce(F.max("_h"), F.lit(0))) * 100).alias("affinity"))


def best_optin_agent(d: Domains, customers: DataFrame, agents: DataFrame, age_rule: str = "as_coded") -> DataFrame:
    """For each orphan the opted-in agent of greatest affinity, the lowest id among equals.

    Affinity counts matching traits, so the best agent is found by key: for every set of traits, the lowest agent per
    trait values. Customers are reduced to their distinct trait values before the look-ups, and no customer is ever
    paired with all agents.
    """
    if age_rule not in ("as_coded", "difference"):
        raise ValueError(f"unknown age rule {age_rule!r}")
    homes = customers.select(C, F.col("customer_hid").alias("hid")).distinct()
    people = (
        d.orphans.join(_customer_traits(customers), C, "left").join(homes, C, "left")
        .select(C, F.col("customer_language").alias("language"), F.col("customer_postal_sector").alias("sector"),
                "hid", F.col("customer_age").alias("age"))
    )
    traits = ["language", "sector", "hid"]
    team = (
        d.optin.join(_agent_traits(agents), A, "left")
        .join(agents.select(A, F.col("agent_hid").alias("hid")).distinct(), A, "left")
        .select(A, F.col("agent_language").alias("language"), F.col("agent_postal_sector").alias("sector"), "hid",
                F.col("agent_age").alias("age"))
    )
    if age_rule == "difference":
        traits.append("age")
        near = F.sequence(F.col("age") - AGE_GAP, F.col("age") + AGE_GAP)
        team = team.select(A, "language", "sector", "hid", F.explode_outer(near).alias("age"))
        given = 0
    else:
        people, team, given = people.drop("age"), team.drop("age"), 1

    # Both are read once per trait set. They are written first: agents by households, and one row per orphan.
    team, people = cut_lineage(team), cut_lineage(people)
    found = people.select(*traits).distinct()
    by_size: dict[int, list[str]] = {}
    for size in range(1, len(traits) + 1):
        for subset in combinations(traits, size):
            name = "best_" + "_".join(subset)
            known = team
            for trait in subset:
                known = known.filter(F.col(trait).isNotNull())
            found = found.join(known.groupBy(*subset).agg(F.min(A).alias(name)), list(subset), "left")
            by_size.setdefault(size, []).append(name)
    anyone = d.optin.agg(F.min(A).alias("first"))
    options = []
    for size in sorted(by_size, reverse=True):
        columns = [F.col(c) for c in by_size[size]]
        lowest = F.least(*columns) if len(columns) > 1 else columns[0]
        options.append(F.when(lowest.isNotNull(), F.struct(lowest.alias("agent"), F.lit(size).alias("hits"))))
    first = anyone.scalar()
    options.append(F.when(first.isNotNull(), F.struct(first.alias("agent"), F.lit(0).alias("hits"))))
    scored = found.select(*traits, F.coalesce(*options).alias("best")).filter("best is not null")
    same = [F.col(f"people.{t}").eqNullSafe(F.col(f"scored.{t}")) for t in traits]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    placed = people.alias("people").join(scored.alias("scored"), condition).select(
        F.col(f"people.{C}").alias(C), "best")
    # A customer of several households takes the best of them.
    best = placed.groupBy(C).agg(F.min(F.struct((-F.col("best.hits")).alias("miss"), F.col("best.agent").alias("agent")))
                                 .alias("best"))
    return best.select(C, F.col("best.agent").alias(A), ((given - F.col("best.miss")) * 100).alias("affinity"))


def best_agent(d: Domains, customers: DataFrame, agents: DataFrame, age_rule: str = "as_coded") -> DataFrame:
    """The agent of greatest affinity for every customer of the domain, the lowest id among equals."""
    # The best of the attached pairs first, where the pairs of a customer stand together already.
    own = _most_affine(affinity(d.attached, customers, agents, age_rule))
    return _most_affine(own.unionByName(best_optin_agent(d, customers, agents, age_rule)))


def _most_affine(pairs: DataFrame) -> DataFrame:
    best = pairs.groupBy(C).agg(F.min(F.struct((-F.col("affinity")).alias("less"), F.col(A).alias("agent"))).alias("b"))
    return best.select(C, F.col("b.agent").alias(A), (-F.col("b.less")).alias("affinity"))


# Warming score


def warming_bins(leads: DataFrame, digits: int | None) -> DataFrame:
    """Decile of premium and of days underserved per (customer, agent) pair of the lead table."""
    filled = leads.select(C, A, F.coalesce("wpi", F.lit(0.0)).alias("wpi"),
                          F.coalesce("days_underserved", F.lit(float(MISSING_DAYS))).alias("days"))
    bins = QuantileBins.fit_many(filled, ["wpi", "days"], 10, digits)
    binned = bins["days"].transform(bins["wpi"].transform(filled, "wpi_score"), "serving_score")
    # Several leads of one pair: the greatest scores count.
    return binned.groupBy(C, A).agg(F.max("wpi_score").alias("wpi_score"), F.max("serving_score").alias("serving_score"))


def warming_score(leads: DataFrame, rows: DataFrame, priorities: DataFrame, digits: int | None = None) -> DataFrame:
    """Warming score of the given (customer, agent, use case) rows.

    Premium decile x days decile x (10 - priority). A row without a lead has premium decile 0, hence score 0.
    """
    bins = warming_bins(leads, digits)
    scored = rows.join(bins, [C, A], "left").join(small_side(priorities), P)
    return scored.select(
        *rows.columns,
        (F.coalesce("wpi_score", F.lit(0)) * F.coalesce("serving_score", F.lit(MISSING_DAYS))
         * (10 - F.col("priority"))).cast("bigint").alias("warming_score"))


def lead_triples(leads: DataFrame, d: Domains, warm_only: bool = True) -> DataFrame:
    """Domain rows whose (customer, agent) pair is in the lead table: all that can have a warming score above 0."""
    pairs = leads.select(C, A).distinct()
    if warm_only:
        pairs = pairs.join(d.warm, C, "left_semi")
    own = pairs.join(d.attached, [C, A], "left_semi")
    product = pairs.join(d.orphans, C, "left_semi").join(d.optin, A, "left_semi")
    return own.unionByName(product).join(d.wants, C)


def with_priority(rows: DataFrame, priorities: DataFrame) -> DataFrame:
    return look_up(rows, priorities, [P], ["priority"], "use case priority")
