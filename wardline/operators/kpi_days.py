"""Mergeable KPI state: one row per admission day and provider, for any lookback.

Sums add up, and lengths of stay are kept as a quantile sketch, which merges without the
claims: a snapshot over any range of days reads the few rows of those days. Medians of
merged sketches are within ``rank_error`` of the exact rank; ``kpi.kpi_wide`` is the exact
path from the claims.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.kpi import ALL_PROVIDERS, METRICS, NATIONAL_AVG_LOS
from wardline.operators.store import publish, read_current

SKETCH_SIZE = 400
# Largest distance of a returned median's rank from the middle, as a share of the rows, for
# this sketch size (about 99 % of the time).
RANK_ERROR = 0.01
# Counted and summed columns by the name of their count.
_SUMS = {
    "n_label": "readmission_label", "n_prob": "readmission_prob", "n_cost": "claim_pmt_amt",
    "n_los": "los_days", "n_elix": "elixhauser_count", "n_age": "age_at_admit",
}


def daily_state(rows: DataFrame) -> DataFrame:
    """State of KPI rows by ``admit_dt, provider_id``: counts, sums and the stay sketch."""
    totals = [F.count("*").alias("n"), F.count_if(F.col("risk_tier") == "high").alias("n_high")]
    for name, column in _SUMS.items():
        totals += [F.count(column).alias(name), F.sum(column).alias(f"s{name[1:]}")]
    stay = F.kll_sketch_agg_double(F.col("los_days").cast("double"), SKETCH_SIZE)
    return rows.groupBy("admit_dt", "provider_id").agg(*totals, stay.alias("stay"))


def merge_states(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Days of ``new`` replace those of ``old``: a day is recomputed from all its claims."""
    if old is None:
        return new
    return old.join(new.select("admit_dt").distinct(), "admit_dt", "left_anti").unionByName(new)


def publish_days(rows: DataFrame, root: str) -> DataFrame:
    """Bring the state at ``root`` up to date with these days' KPI rows; the whole state."""
    spark = rows.sparkSession
    publish(merge_states(read_current(spark, root), daily_state(rows)), root)
    return read_current(spark, root)


def snapshot_from_days(state: DataFrame, as_of: date, days: int | None = None, national_avg_los: float = NATIONAL_AVG_LOS) -> DataFrame:
    """Wide KPIs of the last ``days`` days up to ``as_of`` (all days before it without a
    number), by provider and overall, without the claims."""
    end = F.lit(as_of)
    chosen = state.where(F.col("admit_dt") <= end)
    if days is not None:
        chosen = chosen.where(F.col("admit_dt") > F.date_sub(end, days))

    def mean(what: str) -> Column:
        return F.try_divide(F.sum(f"s_{what}").cast("double"), F.sum(f"n_{what}"))

    labelled = F.sum("n_label") > 0
    # A sketch of no stays has no quantile.
    sketch = F.kll_merge_agg_double("stay")
    median = F.when(F.sum("n_los") > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)))
    grouped = chosen.groupingSets([["provider_id"], []], "provider_id").agg(
        F.grouping("provider_id").alias("overall"),
        mean("label").alias("readmission_rate_30d"),
        F.when(labelled, F.sum("n_high")).cast("double").alias("high_risk_count"),
        F.when(labelled, F.sum("n_high") * 100.0 / F.sum("n")).alias("high_risk_pct"),
        F.when(labelled, mean("prob")).alias("avg_readmit_prob"),
        mean("los").alias("avg_los_days"),
        median.alias("median_los_days"),
        (mean("los") - national_avg_los).alias("los_vs_national_avg"),
        mean("cost").alias("avg_cost_per_admission"),
        F.sum("s_cost").cast("double").alias("total_cost"),
        F.sum("n").cast("double").alias("admission_count"),
        mean("elix").alias("avg_elixhauser_score"),
        mean("age").alias("avg_age_at_admit"),
    )
    named = grouped.where(((F.col("overall") == 1) & F.col("admission_count").isNotNull()) | F.col("provider_id").isNotNull())
    provider = F.when(F.col("overall") == 1, F.lit(ALL_PROVIDERS)).otherwise(F.col("provider_id"))
    return named.select(end.alias("snapshot_date"), provider.alias("provider_id"), *METRICS)
