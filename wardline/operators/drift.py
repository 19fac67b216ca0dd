"""Drift, null-spike and freshness checks, and the alerts they raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import Settings

ALERT_SEVERITY = "WARNING"


def score_baseline(scores: DataFrame, high: float = 0.30, prob: str = "readmission_prob") -> DataFrame:
    """One row: mean probability and percentage of claims at or above the high cut-off."""
    at_risk = F.when(F.col(prob) >= high, 1.0).otherwise(0.0)
    return scores.agg(F.avg(prob).alias("mean_prob"), (F.avg(at_risk) * 100).alias("pct_high_risk"))


def drift_checks(
    scores: DataFrame,
    baseline: Mapping[str, float],
    settings: Settings = Settings(),
    run: Column | None = None,
    prob: str = "readmission_prob",
) -> DataFrame:
    """Two rows per scoring run: shift of the mean probability and of the high-risk share.

    ``run`` tells scoring runs apart (default: one run). A value absent from the
    baseline has no shift; an empty baseline yields no rows.
    """
    run = F.lit("current") if run is None else run
    at_risk = F.when(F.col(prob) >= settings.tier_high, 1.0).otherwise(0.0)
    current = scores.groupBy(run.alias("run")).agg(
        F.avg(prob).alias("mean_prob"), (F.avg(at_risk) * 100).alias("pct_high_risk")
    )
    entries = []
    for name, limit, text in (
        (
            "mean_prob",
            settings.drift_mean_prob,
            "Score drift detected: mean prob shifted %.4f (baseline=%.4f, current=%.4f)",
        ),
        (
            "pct_high_risk",
            settings.drift_high_risk_pct,
            "High-risk %% drift: %.1fpp shift (baseline=%.1f%%, current=%.1f%%)",
        ),
    ):
        before = F.lit(float(baseline[name])) if name in baseline else F.col(name)
        shift = F.abs(F.col(name) - before)
        entries.append(
            F.struct(
                F.lit(name).alias("check_name"),
                before.alias("baseline_value"),
                F.col(name).alias("current_value"),
                shift.alias("shift"),
                F.lit(limit).alias("threshold"),
                (shift > limit).alias("breached"),
                F.format_string(text, shift, before, F.col(name)).alias("message"),
            )
        )
    checks = current.select("run", F.inline(F.array(*entries)))
    return checks if baseline else checks.where(F.lit(False))


def null_spikes(
    current: DataFrame, baseline: DataFrame, columns: Sequence[str], threshold: float = 0.10
) -> DataFrame:
    """Null rate of each column now and at baseline, and whether it rose by more than allowed."""

    def rates(df: DataFrame, name: str) -> DataFrame:
        row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
        return row.unpivot([], list(columns), "column_name", name)

    both = rates(baseline, "baseline_rate").join(rates(current, "current_rate"), "column_name")
    rise = F.col("current_rate") - F.col("baseline_rate")
    return both.select("*", rise.alias("rise"), (rise > threshold).alias("breached"))


def freshness_check(kpis: DataFrame, as_of: Column | date, max_age_hours: int = 48) -> DataFrame:
    """One row: newest snapshot date and whether it is older than allowed."""
    today = F.lit(as_of) if isinstance(as_of, date) else as_of
    newest = F.max("snapshot_date")
    return kpis.agg(newest.alias("last_snapshot")).select(
        "last_snapshot",
        today.alias("as_of"),
        F.coalesce(F.col("last_snapshot") < F.date_sub(today, max_age_hours // 24), F.lit(False)).alias("stale"),
    )


def freshness_alerts(kpis: DataFrame, as_of: date, created_at: Column, max_age_hours: int = 48) -> DataFrame:
    """No row while fresh, one ``stale_kpi`` alert otherwise."""
    checked = freshness_check(kpis, as_of, max_age_hours).where("stale")
    text = F.format_string(
        f"KPI snapshots not updated in {max_age_hours}+ hours. Last snapshot: %s",
        F.col("last_snapshot").cast("string"),
    )
    return alerts(checked, F.lit("stale_kpi"), text, created_at)


def alerts(rows: DataFrame, kind: Column, message: Column, created_at: Column) -> DataFrame:
    """Alert rows with the default severity, unresolved, and a key derived from the content."""
    made = rows.select(
        kind.alias("alert_type"),
        message.alias("message"),
        F.lit(ALERT_SEVERITY).alias("severity"),
        F.lit(False).alias("resolved"),
        created_at.cast("timestamp").alias("created_at"),
    )
    key = F.xxhash64("alert_type", "message", "created_at")
    return made.select(key.alias("alert_id"), "*")


def drift_alerts(checks: DataFrame, created_at: Column) -> DataFrame:
    return alerts(checks.where("breached"), F.lit("score_drift"), F.col("message"), created_at)


def null_spike_alerts(spikes: DataFrame, created_at: Column) -> DataFrame:
    text = F.format_string(
        "Null rate of %s rose to %.4f (baseline=%.4f)",
        F.col("column_name"), F.col("current_rate"), F.col("baseline_rate"),
    )
    return alerts(spikes.where("breached"), F.lit("null_spike"), text, created_at)
