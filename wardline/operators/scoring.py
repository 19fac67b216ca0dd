"""Risk tiers, the rule scorecard, batch scoring and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.features import TARGET

# Scorecard weights, caps and ceiling.
SCORE_BASE = 0.01
SCORE_CEILING = 0.92
SCORE_WEIGHTS = {
    "comorbidity": 0.32,
    "not_routine": 0.48,
    "prior_admits": 0.18,
    "stay": 0.08,
}
PRIOR_ADMITS_TOP, STAY_TOP = 5, 14


def risk_tier(prob: Column, settings: Settings = Settings()) -> Column:
    return (
        F.when(prob >= settings.tier_high, "high").when(prob >= settings.tier_medium, "medium").otherwise("low")
    )


def with_scorecard_inputs(features: DataFrame, max_conditions: Column) -> DataFrame:
    """The four scorecard inputs, each on 0..1. ``max_conditions`` is at least 1."""
    stay = F.coalesce(F.col("los_days"), F.lit(0))
    return features.withColumns(
        {
            "comorbidity": F.col("elixhauser_count") / max_conditions,
            "not_routine": F.col("is_not_routine_discharge").cast("double"),
            "prior_admits": F.least("prior_admits_90d", F.lit(PRIOR_ADMITS_TOP)) / F.lit(float(PRIOR_ADMITS_TOP)),
            "stay": F.least(stay, F.lit(STAY_TOP)) / F.lit(float(STAY_TOP)),
        }
    )


def scorecard() -> Column:
    """Rule-based readmission probability from the four inputs."""
    total = F.lit(SCORE_BASE)
    for name, weight in SCORE_WEIGHTS.items():
        total = total + F.lit(weight) * F.col(name)
    return F.least(F.lit(SCORE_CEILING), total)


def score_rows(
    scored: DataFrame,
    version: str,
    scored_at: Column,
    settings: Settings = Settings(),
    prob: str = "readmission_prob",
) -> DataFrame:
    """Risk-score rows from scored features; missing labels count as 0.

    ``scored`` may carry ``top_features`` (array of names), ``los_predicted_days`` and
    ``high_cost_prob``; absent ones are null.
    """
    names = F.col("top_features") if "top_features" in scored.columns else F.array().cast("array<string>")
    label = F.coalesce(F.col(TARGET), F.lit(0)) if TARGET in scored.columns else F.lit(None)

    def optional(name: str) -> Column:
        value = F.col(name) if name in scored.columns else F.lit(None)
        return value.cast("double").alias(name)

    return scored.select(
        "claim_id",
        "bene_id",
        scored_at.cast("timestamp").alias("scored_at"),
        F.lit(version).alias("model_version"),
        F.col(prob).cast("double").alias("readmission_prob"),
        risk_tier(F.col(prob), settings).alias("risk_tier"),
        optional("los_predicted_days"),
        optional("high_cost_prob"),
        *[F.get(names, i).alias(f"shap_top_feature_{i + 1}") for i in range(3)],
        label.cast("int").alias("readmission_label"),
    )


def tier_shares(scores: DataFrame) -> DataFrame:
    """Claims and percentage per tier of a run."""
    counts = scores.groupBy("risk_tier").agg(F.count("*").alias("claims"))
    total = counts.agg(F.sum("claims")).scalar()
    return counts.withColumn("pct", F.col("claims") * 100.0 / total)


def risk_summary(scores: DataFrame) -> DataFrame:
    """Claims and mean probability per month of scoring and tier."""
    month = F.trunc(F.col("scored_at").cast("date"), "month")
    return scores.groupBy(month.alias("month"), "risk_tier").agg(
        F.count("*").alias("patient_count"), F.avg("readmission_prob").alias("avg_readmit_prob")
    )
