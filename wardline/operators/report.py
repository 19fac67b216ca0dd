"""Datasets behind the weekly report, the dashboards and the CSV extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.features import TARGET
from wardline.operators.kpi import ALL_PROVIDERS
from wardline.operators.store import write_csv

TOP_PROVIDERS, CHART_PROVIDERS, TOP_ALERTS = 20, 10, 10
TIERS = ("high", "medium", "low")
# Columns of the extracts.
RISK_EXPORT_FEATURES = (
    "provider_id", "admit_dt", "discharge_dt", "los_days", "age_at_admit", "sex_cd",
    "race_cd", "elixhauser_count", "prior_admits_90d", "claim_pmt_amt",
)
FEATURE_EXPORT = (
    "claim_id", "bene_id", "provider_id", "admit_dt", "discharge_dt", "los_days",
    "age_at_admit", "sex_cd", "race_cd", "drg_cd", "admit_type_cd",
    "discharge_status_cd", "elixhauser_count", "prior_admits_90d",
    "prior_admits_365d", "days_since_last_admit", "claim_pmt_amt",
    "died_within_30d", "hmo_coverage_months",
)


def provider_table(scores: DataFrame, features: DataFrame, top: int | None = TOP_PROVIDERS) -> DataFrame:
    """Admissions, tier percentages, readmission rate and stay per provider, largest first."""
    joined = scores.select("claim_id", "risk_tier", "readmission_label").join(
        features.where(F.col("provider_id").isNotNull()).select("claim_id", "provider_id", "los_days"), "claim_id"
    )
    share = [
        (F.avg(F.when(F.col("risk_tier") == t, 1.0).otherwise(0.0)) * 100).alias(f"{t}_pct") for t in TIERS
    ]
    table = joined.groupBy("provider_id").agg(
        F.count("*").alias("admission_count"),
        *share,
        F.avg("readmission_label").alias("readmission_rate"),
        F.avg("los_days").alias("avg_los"),
    )
    if top is None:
        return table
    return table.orderBy(F.desc("admission_count"), "provider_id").limit(top)


def tier_chart_data(scores: DataFrame, features: DataFrame) -> DataFrame:
    table = provider_table(scores, features, CHART_PROVIDERS)
    return table.select("provider_id", *[f"{t}_pct" for t in TIERS])


def open_alerts(alerts: DataFrame, top: int = TOP_ALERTS) -> DataFrame:
    """Newest unresolved alerts with their display class."""
    shown = alerts.where(~F.col("resolved")).orderBy(F.desc("created_at"), "alert_type", "message").limit(top)
    style = F.when(F.col("alert_type").contains("drift"), "danger").otherwise("warning")
    return shown.select("alert_type", "message", "created_at", style.alias("style"))


def _status(name: Column, value: Column) -> Column:
    # Display thresholds of the report cards.
    return (
        F.when(
            name == "readmission_rate_30d",
            F.when(value > 0.15, "danger").when(value > 0.11, "warn").otherwise("good"),
        )
        .when(name == "high_risk_pct", F.when(value > 30, "warn").otherwise("good"))
        .when(
            name == "los_vs_national_avg",
            F.when(value > 1, "warn").when(value < -1, "good").otherwise("neutral"),
        )
        .otherwise("neutral")
    )


def kpi_status(kpis: DataFrame) -> DataFrame:
    """KPI rows with the status shown on their card."""
    return kpis.withColumn("status", _status(F.col("metric_name"), F.col("metric_value")))


def report_header(report_date: Column, data_as_of: Column, model_version: str | None) -> list[Column]:
    """Header facts of a report as columns (an unknown model is named so)."""
    return [
        report_date.alias("report_date"),
        data_as_of.alias("data_as_of"),
        F.lit(model_version or "unknown").alias("model_version"),
    ]


def metric_trend(kpis: DataFrame, metric: str = "readmission_rate_30d") -> DataFrame:
    """Overall values of a metric by snapshot date."""
    overall = (F.col("metric_name") == metric) & (F.col("provider_id") == ALL_PROVIDERS)
    return kpis.where(overall).select("snapshot_date", "metric_value").orderBy("snapshot_date")


def cost_by_drg(features: DataFrame) -> DataFrame:
    return features.groupBy("drg_cd").agg(
        F.count("*").alias("admissions"), F.avg(F.col("claim_pmt_amt").cast("double")).alias("avg_cost")
    )


def tier_by_provider(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Claims per provider and tier, one column per tier."""
    joined = scores.select("claim_id", "risk_tier").join(features.select("claim_id", "provider_id"), "claim_id")
    return joined.groupBy("provider_id").agg(
        *[F.count_if(F.col("risk_tier") == t).alias(f"{t}_claims") for t in TIERS]
    )


def readmission_by_age(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("age_group").agg(
        F.count("*").alias("admissions"), F.avg(TARGET).alias("readmission_rate")
    )


def weekday_heatmap(features: DataFrame, day: str = "admit_dt") -> DataFrame:
    """Admissions per weekday (0 = Monday) and month."""
    return features.groupBy(F.weekday(day).alias("admit_dow"), F.month(day).alias("admit_month")).agg(
        F.count("*").alias("admissions")
    )


def los_predicted_vs_actual(scores: DataFrame, features: DataFrame) -> DataFrame:
    predicted = scores.where(F.col("los_predicted_days").isNotNull()).select("claim_id", "los_predicted_days")
    return predicted.join(features.select("claim_id", "provider_id", "los_days"), "claim_id")


# --- extracts ------------------------------------------------------------------


def risk_score_extract(scores: DataFrame, features: DataFrame) -> DataFrame:
    joined = scores.join(features.select("claim_id", *RISK_EXPORT_FEATURES), "claim_id", "left")
    return joined.select(
        "claim_id",
        "bene_id",
        F.col("scored_at").cast("date").alias("score_date"),
        "model_version",
        "readmission_prob",
        "risk_tier",
        "shap_top_feature_1",
        "shap_top_feature_2",
        "shap_top_feature_3",
        "readmission_label",
        *RISK_EXPORT_FEATURES,
    ).orderBy(F.desc("readmission_prob"), "claim_id")


def kpi_extract(kpis: DataFrame) -> DataFrame:
    columns = ["snapshot_date", "provider_id", "metric_name", "metric_value"]
    return kpis.select(*columns).orderBy(*columns[:3])


def feature_extract(features: DataFrame) -> DataFrame:
    return features.select(*FEATURE_EXPORT).orderBy("admit_dt", "claim_id")


def write_extracts(scores: DataFrame, kpis: DataFrame, features: DataFrame, directory: str) -> None:
    """The three CSV extracts for a dashboard tool."""
    write_csv(risk_score_extract(scores, features), f"{directory}/risk_scores")
    write_csv(kpi_extract(kpis), f"{directory}/kpi_snapshots")
    write_csv(feature_extract(features), f"{directory}/patient_features")
