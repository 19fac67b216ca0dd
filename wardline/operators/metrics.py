"""Evaluation of scores: curves, ranking metrics, calibration, regression errors.

Input is one row per case with a 0/1 label and a score. Curves start from a
group-by on the score, so ties and hot scores are one row, and then use bucketed
running totals in descending score order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.ordering import running_totals
from wardline.operators.store import materialize

# Edges of the ten equal calibration bins (multiples of 0.1 as doubles).
BIN_EDGES = tuple(i * 0.1 for i in range(11))
TARGET_SPECIFICITY = 0.80
MAPE_OFFSET = 1e-6


def score_counts(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """Positives and negatives per model and distinct score (``scores``: model -> column)."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score")) for m, c in scores.items()]
    )
    long = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.inline(pairs))
    return (
        long.where(F.col("score").isNotNull())
        .groupBy("model", "score")
        .agg(F.count_if(F.col("label") == 1).alias("tp"), F.count_if(F.col("label") == 0).alias("fp"))
    )


def _curve(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """Per model and distinct score: own counts, running counts, totals ``p`` and ``n``.

    The counts are written once: bounds, running totals and totals read that table
    instead of scoring again. The totals have one row per model.
    """
    counts = materialize(score_counts(df, label, scores), "score-counts")
    totals = counts.groupBy("model").agg(F.sum("tp").alias("p"), F.sum("fp").alias("n"))
    run = running_totals(counts, "score", ["tp", "fp"], ascending=False, by=["model"])
    return run.join(F.broadcast(totals), "model")


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """``threshold, fpr, tpr`` at every distinct score, plus the (0, 0) start (null threshold)."""
    points = _curve(df, label, {"": score}).select(
        F.col("score").alias("threshold"),
        F.try_divide("run_fp", "n").alias("fpr"),
        F.try_divide("run_tp", "p").alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def _curve_parts() -> list[Column]:
    """Mergeable parts of the ranking metrics over curve rows."""
    precision = F.col("run_tp") / (F.col("run_tp") + F.col("run_fp"))
    specificity = F.lit(1.0) - F.try_divide("run_fp", "n")
    point = F.struct(
        F.round(F.abs(specificity - TARGET_SPECIFICITY), 12).alias("distance"),
        (-F.col("score")).alias("order"),
        F.try_divide("run_tp", "p").alias("tpr"),
    )
    return [
        F.max("p").alias("p"),
        F.max("n").alias("n"),
        F.sum(F.col("fp") * (F.col("run_tp") - F.col("tp") / 2)).alias("area"),
        F.sum(F.try_divide("tp", "p") * precision).alias("precision_sum"),
        F.min(point).alias("point"),
    ]


def _ranking_columns() -> list[Column]:
    """AUROC, average precision and sensitivity from the merged parts.

    The (0, 0) start has specificity 1 and comes first in threshold order, so it wins
    ties of the distance to the target specificity.
    """
    start = round(1.0 - TARGET_SPECIFICITY, 12)
    return [
        F.try_divide(F.col("area"), F.col("p").cast("double") * F.col("n")).alias("auroc"),
        F.col("precision_sum").alias("average_precision"),
        F.when(F.col("point.distance") < start, F.col("point.tpr")).otherwise(0.0).alias("sens_at_spec"),
    ]


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: positives, negatives, AUROC, average precision, sensitivity at 80% specificity."""
    return _curve(df, label, {"": score}).agg(*_curve_parts()).select("p", "n", *_ranking_columns())


def auroc(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_metrics(df, label, score).select("auroc")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Step-wise average precision (no interpolation)."""
    return ranking_metrics(df, label, score).select("average_precision")


def sensitivity_at_specificity(df: DataFrame, label: str, score: str) -> DataFrame:
    """True-positive rate where specificity is closest to 0.80, first in threshold order."""
    return ranking_metrics(df, label, score).select("sens_at_spec")


def brier(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def bin_number(score: Column, edges: Sequence[float] = BIN_EDGES) -> Column:
    """Half-open bin of a score; null at and above the last edge (so 1.0 has no bin)."""
    number = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        number = F.when((score >= edges[i]) & (score < edges[i + 1]), F.lit(i)).otherwise(number)
    return number


def _bins(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(bin_number(F.col(score)).alias("bin")).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(label).alias("positive_share")
    )


def expected_calibration_error(df: DataFrame, label: str, score: str) -> DataFrame:
    """Share-weighted gap per bin; scores of 1.0 are in no bin but count in the total."""
    gap = F.abs(F.col("positive_share") - F.col("mean_score")) * F.col("n")
    binned = F.when(F.col("bin").isNotNull(), gap).otherwise(0.0)
    return _bins(df, label, score).agg(F.try_divide(F.sum(binned), F.sum("n")).alias("ece"))


def calibration_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """Reliability table ``bin, n, mean_predicted, fraction_positive``; empty bins absent.

    Bins are closed on the right, unlike those of the calibration error.
    """
    number = sum(((F.col(score) > edge).cast("int") for edge in BIN_EDGES[1:-1]), F.lit(0))
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.avg(score).alias("mean_predicted"),
            F.avg(label).alias("fraction_positive"),
        )
    )


def evaluate(df: DataFrame, label: str, score: str, model: str) -> DataFrame:
    """One metrics row of a model; metrics rounded to four places."""
    return evaluate_models(df, label, {model: score})


def evaluate_models(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """One metrics row per model (model -> score column), in one pass over the cases.

    Everything derives from the curves over distinct scores.
    """
    cases = F.col("tp") + F.col("fp")
    squared = F.col("tp") * F.pow(1 - F.col("score"), 2) + F.col("fp") * F.pow(F.col("score"), 2)
    per_bin = (
        _curve(df, label, scores)
        .groupBy("model", bin_number(F.col("score")).alias("bin"))
        .agg(
            F.sum(cases).alias("cases"),
            F.sum(cases * F.col("score")).alias("scores"),
            F.sum("tp").alias("positives"),
            F.sum(squared).alias("squared"),
            *_curve_parts(),
        )
    )
    gap = F.when(F.col("bin").isNotNull(), F.abs(F.col("positives") - F.col("scores"))).otherwise(0.0)
    merged = per_bin.groupBy("model").agg(
        F.sum("cases").alias("cases"),
        F.sum("positives").alias("positives"),
        F.sum("squared").alias("squared"),
        F.sum(gap).alias("gap"),
        F.max("p").alias("p"),
        F.max("n").alias("n"),
        F.sum("area").alias("area"),
        F.sum("precision_sum").alias("precision_sum"),
        F.min("point").alias("point"),
    )
    ranked = merged.select("*", *_ranking_columns())
    return ranked.select(
        "model",
        F.col("cases").alias("n_samples"),
        F.try_divide("positives", "cases").alias("positive_rate"),
        F.round("auroc", 4).alias("auroc"),
        F.round("average_precision", 4).alias("auprc"),
        F.round(F.try_divide("squared", "cases"), 4).alias("brier_score"),
        F.round("sens_at_spec", 4).alias("sensitivity_at_80pct_specificity"),
        F.round(F.try_divide("gap", "cases"), 4).alias("expected_calibration_error"),
    )


def regression_metrics(df: DataFrame, actual_log: str, predicted_log: str, model: str) -> DataFrame:
    """MAE, RMSE, R2 and MAPE in days, from log-scale columns."""
    days = df.select(F.expm1(actual_log).alias("y"), F.expm1(predicted_log).alias("f"))
    error = F.col("y") - F.col("f")
    sums = days.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop("y").alias("variance"),
        F.avg(F.abs(error / (F.col("y") + MAPE_OFFSET))).alias("mape"),
    )
    return sums.select(
        F.lit(model).alias("model"),
        F.round("mae", 3).alias("mae_days"),
        F.round(F.sqrt("mse"), 3).alias("rmse_days"),
        F.round(1 - F.try_divide("mse", "variance"), 4).alias("r2"),
        F.round(F.col("mape") * 100, 2).alias("mape_pct"),
    )
