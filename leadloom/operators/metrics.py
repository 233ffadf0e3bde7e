"""Classification measures over a scored set (label, prediction, probability, unique key)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.functions.scalars import one_value, ratio, ratio_or
from leadloom.operators.ranks import QuantileBins, cumulative_by_group, cumulative_by_scores, cut_counts, cut_counts_of


@dataclass(frozen=True)
class Scored:
    """Column names of a scored set."""

    label: str = "label"
    prediction: str = "prediction"
    score: str = "prob_1"
    key: str = "row_id"


DECILES = tuple(range(10, 101, 10))


def base_rate(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    return df.agg(F.avg(F.col(cols.label).cast("double")).alias("base_rate"))


def confusion(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    """One row ``tn, fp, fn, tp``."""
    actual, guess = F.col(cols.label), F.col(cols.prediction)
    return df.agg(
        F.count_if((actual == 0) & (guess == 0)).alias("tn"),
        F.count_if((actual == 0) & (guess == 1)).alias("fp"),
        F.count_if((actual == 1) & (guess == 0)).alias("fn"),
        F.count_if((actual == 1) & (guess == 1)).alias("tp"),
    )


def with_hit_coverage_lift(counts: DataFrame) -> DataFrame:
    """Add hit rate, coverage and lift to confusion counts; -1 where nothing is selected or positive."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    hit = ratio(tp, tp + fp)
    return counts.select(
        "*",
        ratio_or(tp, tp + fp, -1).alias("hit_rate"),
        ratio_or(tp, tp + fn, -1).alias("coverage"),
        F.when(tp + fp == 0, F.lit(-1.0)).otherwise(ratio(hit, ratio(tp + fn, tn + fp + fn + tp))).alias("lift"),
    )


def _cut_confusion(cuts: DataFrame, *keep: str) -> DataFrame:
    hits, selected, n, positives = (F.col(c) for c in ("hits", "selected", "n", "positives"))
    return cuts.select(
        *keep, "pct",
        (n - selected - positives + hits).alias("tn"),
        (selected - hits).alias("fp"),
        (positives - hits).alias("fn"),
        hits.alias("tp"),
    )


def top_percent_confusion(df: DataFrame, percents: list[int], cols: Scored = Scored()) -> DataFrame:
    """Confusion counts and measures when the top ``pct`` percent by score is selected."""
    return with_hit_coverage_lift(_cut_confusion(cut_counts(df, cols.score, cols.label, cols.key, percents)))


def percentile_report(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    """Overall confusion, top 1 and 5 percent and the ten cumulative deciles, one row per ``cut``."""
    wanted = sorted({1, 5, *DECILES})
    tops = _cut_confusion(cut_counts(df, cols.score, cols.label, cols.key, wanted))
    named = tops.select(
        F.when(F.col("pct") < 10, F.format_string("top_%d", "pct"))
        .otherwise(F.format_string("decile_%d", (F.col("pct") / 10).cast("int"))).alias("cut"),
        "tn", "fp", "fn", "tp")
    overall = confusion(df, cols).select(F.lit("overall").alias("cut"), "tn", "fp", "fn", "tp")
    return with_hit_coverage_lift(overall.unionByName(named))


def lift_series(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    """Lift and take-up for cumulative deciles 1..10."""
    table = top_percent_confusion(df, list(DECILES), cols)
    return table.select((F.col("pct") / 10).cast("int").alias("decile"), "lift", F.col("tp").alias("takeup"))


def lift_top(df: DataFrame, percents: list[int], cols: Scored = Scored()) -> DataFrame:
    """Hit rate, coverage and lift at each top percentage."""
    table = top_percent_confusion(df, percents, cols)
    return table.select(F.col("pct").alias("top_n"), "hit_rate", "coverage", "lift")


def roc_points_of(df: DataFrame, scores: dict[str, str], label: str) -> DataFrame:
    """False and true positive rate of every model at each of its distinct scores; one pass for all models."""
    steps = cumulative_by_scores(df.filter(F.col(label).isNotNull()), scores, label)
    # One row per model.
    totals = F.broadcast(steps.groupBy("model").agg(F.sum("n").alias("_total"), F.sum("pos").alias("_p")))
    positives, negatives = F.col("_p"), F.col("_total") - F.col("_p")
    return steps.join(totals, "model").select(
        "model", "threshold", "n", "pos",
        ratio(F.col("cum_n") - F.col("cum_pos"), negatives).alias("fpr"),
        ratio(F.col("cum_pos"), positives).alias("tpr"),
        ratio(F.col("n") - F.col("pos"), negatives).alias("fpr_step"),
        ratio(F.col("pos"), positives).alias("tpr_step"),
        ratio(F.col("cum_n"), F.col("_total")).alias("ppr"),
    )


def roc_points(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    """False and true positive rate at each distinct score."""
    return roc_points_of(df, {"": cols.score}, cols.label).drop("model")


def roc_auc_of(df: DataFrame, scores: dict[str, str], label: str) -> DataFrame:
    """Exact area under the curve of every model by the trapezoid rule; null when one class is missing."""
    return _area(cumulative_by_scores(df.filter(F.col(label).isNotNull()), scores, label))


def roc_auc_by(df: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """:func:`roc_auc_of` for models that stand in rows; columns ``model`` and ``roc_auc``."""
    return _area(cumulative_by_group(df.filter(F.col(label).isNotNull()), group, score, label))


def _area(steps: DataFrame) -> DataFrame:
    pos, neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    area = neg * (F.col("cum_pos").cast("double") - pos / 2)
    return steps.groupBy("model").agg(
        F.try_divide(F.sum(area), F.sum(pos) * F.sum(neg)).alias("roc_auc"))


def roc_auc(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    """Exact area under the curve of one score column, in one row."""
    return roc_auc_of(df, {"": cols.score}, cols.label).agg(F.max("roc_auc").alias("roc_auc"))


def gains_curve(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    """Share of the population against share of the targets captured."""
    return roc_points(df, cols).select("threshold", "ppr", "tpr")


def evaluate(df: DataFrame, cols: Scored = Scored()) -> DataFrame:
    """Accuracy, precision, recall and ROC-AUC in one row; precision and recall are 0 when undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion(df, cols).select(
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        ratio_or(tp, tp + fp, 0).alias("precision"),
        ratio_or(tp, tp + fn, 0).alias("recall"),
        one_value(roc_auc(df, cols), "roc_auc").alias("roc_auc"),
    )


# Fixed value: how far the outer bins reach beyond the scores.
OUTER_REACH = 0.0001


def _bin_table(spark: SparkSession, edges: tuple[float, ...], bins: int) -> DataFrame:
    """One row per bin: its number from the lowest, and its name with rank, bounds and brackets.

    The best bin has the least rank; the lowest bin of a full table has rank ``bins`` - 1. Equal scores make one bin.
    """
    last = max(len(edges) - 2, 0)
    rows = []
    for number in range(last + 1):
        low, high = edges[number], edges[min(number + 1, len(edges) - 1)]
        reach_down = OUTER_REACH if number == 0 else 0.0
        reach_up = OUTER_REACH if number == last else 0.0
        rows.append((number, bins - 1 - number, f"{low - reach_down:.2f}", f"{high + reach_up:.2f}", "[" if number == 0 else "("))
    table = spark.createDataFrame(rows, "bin int, rank int, low string, high string, bracket string")
    return table.select("bin", F.format_string("%d.%s%s,%s]", "rank", "bracket", "low", "high").alias("decile"))


def score_bins(df: DataFrame, cols: Scored = Scored(), bins: int = 100, digits: int | None = None) -> DataFrame:
    """Population, ones and zeros per quantile bin of the score; at most ``bins`` rows, empty bins included.

    Where all scores are equal they share one bin; without scores there are no rows.
    """
    known = df.filter(F.col(cols.score).isNotNull() & F.col(cols.label).isNotNull())
    fitted = QuantileBins.fit(known, cols.score, bins, digits)
    label = F.col(cols.label).cast("bigint")
    placed = fitted.transform(known, "bin")
    if len(fitted.edges) == 1:
        placed = placed.withColumn("bin", F.when(~F.isnan(F.col(cols.score).cast("double")), 0))
    sums = placed.groupBy("bin").agg(
        F.sum(label).alias("ones"), F.sum(1 - label).alias("zeros"), F.count(F.lit(1)).alias("population"))
    names = _bin_table(df.sparkSession, fitted.edges, bins) if fitted.edges else sums.select("bin", F.lit("").alias("decile")).limit(0)
    return names.join(sums, "bin", "left").select(
        "bin", "decile", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("ones", "zeros", "population")])


def score_deciles(df: DataFrame, cols: Scored = Scored(), bins: int = 100, digits: int | None = None) -> DataFrame:
    """The bin table with target rate, cumulative target rate and share of targets captured, best bin first."""
    # At most ``bins`` rows, so one ordered window is enough.
    best_first = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(0))
    ones, population = F.col("ones"), F.col("population")
    return score_bins(df, cols, bins, digits).select(
        "bin", "decile", "ones", "zeros", "population",
        ratio(ones, population).alias("target_rate"),
        ratio(F.sum(ones).over(best_first), F.sum(population).over(best_first)).alias("cumulative_target_rate"),
        ratio(F.sum(ones).over(best_first), F.sum(ones).over(everything)).alias("targets_captured"),
    )


def conditional_means(df: DataFrame, features: list[str], group_by: str, batch: int = 100) -> DataFrame:
    """Mean of each feature where the group is 1 and where it is 0, with the difference."""
    names = list(dict.fromkeys([*features, group_by]))
    parts = []
    for start in range(0, len(names), batch):
        chunk = names[start:start + batch]
        sums = []
        for i, name in enumerate(chunk):
            value = F.col(name).cast("double")
            value = F.when(~F.isnan(value), value)
            sums += [F.avg(F.when(F.col(group_by) == 1, value)).alias(f"p{i}"),
                     F.avg(F.when(F.col(group_by) == 0, value)).alias(f"n{i}")]
        rows = F.array(*[F.struct(F.lit(name).alias("feature"), F.col(f"p{i}").alias("positive_mean"),
                                  F.col(f"n{i}").alias("negative_mean")) for i, name in enumerate(chunk)])
        parts.append(df.agg(*sums).select(F.inline(rows)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("difference", F.col("positive_mean") - F.col("negative_mean"))


def feature_direction(df: DataFrame, ranked: list[str], top_n: int | None = 200,
                      group_by: str = "prediction") -> DataFrame:
    """Group means of the first ``top_n`` ranked features (all of them when ``top_n`` is None)."""
    return conditional_means(df, ranked if top_n is None else ranked[:top_n], group_by)


def compare_holdout(scored: DataFrame, models: dict[str, str], label: str = "label", key: str = "row_id",
                    percents: tuple[int, ...] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Hit rate, coverage and lift at each top percentage for every model; ``models`` maps name to score column."""
    table = with_hit_coverage_lift(_cut_confusion(cut_counts_of(scored, models, label, key, list(percents)), "model"))
    return table.select(F.col("model").alias("model_name"), F.col("pct").alias("top_n"), "hit_rate", "coverage", "lift")


def best_model(comparison: DataFrame, reference_percentile: int = 3) -> DataFrame:
    """The model with the greatest lift at the reference percentage, the first by name among equals."""
    at = comparison.filter(F.col("top_n") == reference_percentile)
    return at.orderBy(F.col("lift").desc(), F.col("model_name")).limit(1).select("model_name", "lift")
