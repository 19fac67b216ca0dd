"""Clinical KPIs per provider and overall, in wide and long form.

Two phases: scored claims are reduced once to sums per (snapshot, provider, length
of stay), then the small partial table is grouped by provider and overall. Raw rows
are neither expanded for the two groupings nor buffered for the median: whole-day
lengths of stay have few distinct values, and the median reads their counts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_PROVIDERS = "ALL"
NATIONAL_AVG_LOS = 4.6
# Metric names in report order.
METRICS = (
    "readmission_rate_30d",
    "high_risk_count",
    "high_risk_pct",
    "avg_readmit_prob",
    "avg_los_days",
    "median_los_days",
    "los_vs_national_avg",
    "avg_cost_per_admission",
    "total_cost",
    "admission_count",
    "avg_elixhauser_score",
    "avg_age_at_admit",
)


def kpi_input(scores: DataFrame, claims: DataFrame, features: DataFrame) -> DataFrame:
    """Scores with their claim and feature columns; scores without a claim are kept.

    Both joins use the unique claim id, so the scores are shuffled once.
    """
    claim_part = claims.select("claim_id", "provider_id", "admit_dt", "discharge_dt", "claim_pmt_amt", "drg_cd")
    feature_part = features.select("claim_id", "age_at_admit", "los_days", "elixhauser_count")
    score_part = scores.select(
        "claim_id", "bene_id", "risk_tier", "readmission_prob", "readmission_label", "scored_at"
    )
    return score_part.join(claim_part, "claim_id", "left").join(feature_part, "claim_id", "left")


def lookback(df: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Admissions of the last ``days`` days up to ``as_of``."""
    end = F.lit(as_of)
    return df.where((F.col("admit_dt") > F.date_sub(end, days)) & (F.col("admit_dt") <= end))


def _partials(df: DataFrame, snapshot: Column) -> DataFrame:
    return df.groupBy(snapshot.alias("snapshot_date"), "provider_id", "los_days").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("risk_tier") == "high").alias("n_high"),
        F.count("readmission_label").alias("n_label"),
        F.sum("readmission_label").alias("s_label"),
        F.count("readmission_prob").alias("n_prob"),
        F.sum("readmission_prob").alias("s_prob"),
        F.count("claim_pmt_amt").alias("n_cost"),
        F.sum("claim_pmt_amt").alias("s_cost"),
        F.count("elixhauser_count").alias("n_elix"),
        F.sum("elixhauser_count").alias("s_elix"),
        F.count("age_at_admit").alias("n_age"),
        F.sum("age_at_admit").alias("s_age"),
    )


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total).cast("double"), F.sum(count))


def kpi_wide(df: DataFrame, snapshot: Column, national_avg_los: float = NATIONAL_AVG_LOS) -> DataFrame:
    """One row per snapshot and provider, plus the overall row ``ALL``.

    Claims without a provider count only overall. Label-based KPIs are null where no
    claim has a label.
    """
    partials = _partials(df, snapshot)
    los_known = F.col("los_days").isNotNull()
    los_count = F.sum(F.when(los_known, F.col("n")).otherwise(0))
    los_mean = F.try_divide(F.sum(F.when(los_known, F.col("los_days") * F.col("n"))).cast("double"), los_count)
    labelled = F.sum("n_label") > 0
    grouped = partials.groupingSets(
        [["snapshot_date", "provider_id"], ["snapshot_date"]], "snapshot_date", "provider_id"
    ).agg(
        F.grouping("provider_id").alias("overall"),
        _mean("s_label", "n_label").alias("readmission_rate_30d"),
        F.when(labelled, F.sum("n_high")).cast("double").alias("high_risk_count"),
        F.when(labelled, F.sum("n_high") * 100.0 / F.sum("n")).alias("high_risk_pct"),
        F.when(labelled, _mean("s_prob", "n_prob")).alias("avg_readmit_prob"),
        los_mean.alias("avg_los_days"),
        F.percentile(F.col("los_days"), F.lit(0.5), F.when(los_known, F.col("n")).otherwise(0)).alias("median_los_days"),
        (los_mean - national_avg_los).alias("los_vs_national_avg"),
        _mean("s_cost", "n_cost").alias("avg_cost_per_admission"),
        F.sum("s_cost").cast("double").alias("total_cost"),
        F.sum("n").cast("double").alias("admission_count"),
        _mean("s_elix", "n_elix").alias("avg_elixhauser_score"),
        _mean("s_age", "n_age").alias("avg_age_at_admit"),
    )
    named = grouped.where((F.col("overall") == 1) | F.col("provider_id").isNotNull())
    provider = F.when(F.col("overall") == 1, F.lit(ALL_PROVIDERS)).otherwise(F.col("provider_id"))
    return named.select("snapshot_date", provider.alias("provider_id"), *METRICS)


def kpi_snapshot(df: DataFrame, snapshot: Column, national_avg_los: float = NATIONAL_AVG_LOS) -> DataFrame:
    """Long form ``snapshot_date, provider_id, metric_name, metric_value``, nulls left out.

    ``snapshot`` is a literal date for one run, or a per-row date for a history.
    """
    wide = kpi_wide(df, snapshot, national_avg_los)
    long = wide.unpivot(["snapshot_date", "provider_id"], list(METRICS), "metric_name", "metric_value")
    return long.where(F.col("metric_value").isNotNull() & ~F.isnan("metric_value"))


def latest_overall(kpis: DataFrame) -> DataFrame:
    """``metric_name, metric_value`` of ``ALL`` at the newest snapshot date."""
    newest = kpis.agg(F.max("snapshot_date")).scalar()
    overall = (F.col("provider_id") == ALL_PROVIDERS) & (F.col("snapshot_date") == newest)
    return kpis.where(overall).select("metric_name", "metric_value")


def metric_view(kpis: DataFrame, metric: str, name: str) -> DataFrame:
    """One metric over dates and providers under a new column name."""
    chosen = kpis.where(F.col("metric_name") == metric)
    return chosen.select("snapshot_date", "provider_id", F.col("metric_value").alias(name))


def kpi_readmission_view(kpis: DataFrame) -> DataFrame:
    return metric_view(kpis, "readmission_rate_30d", "readmission_rate")


def kpi_avg_los_view(kpis: DataFrame) -> DataFrame:
    return metric_view(kpis, "avg_los_days", "avg_los_days")
