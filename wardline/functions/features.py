"""Row-wise feature transforms on the claim-level view; none of them shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.config import AGE_BINS, AGE_LABELS
from wardline.sources.columns import HIGH_WEIGHT_CONDITIONS

# Model features in training order.
FEATURE_COLUMNS = (
    "age_at_admit",
    "age_group_ord",
    "is_female",
    "race_cd",
    "drg_cd_encoded",
    "admit_source_cd",
    "admit_type_cd",
    "discharge_status_cd",
    "is_not_routine_discharge",
    "discharge_risk_score",
    "admit_month",
    "admit_quarter",
    "admit_dow",
    "admit_month_sin",
    "admit_month_cos",
    "admit_dow_sin",
    "admit_dow_cos",
    "elixhauser_count",
    "cond_chf",
    "cond_diabetes",
    "cond_copd",
    "cond_chronic_kidney",
    "cond_cancer",
    "cond_ischemic_heart",
    "cond_stroke_tia",
    "cond_depression",
    "has_high_weight_comorbidity",
    "prior_admits_90d_capped",
    "prior_admits_365d_capped",
    "had_prior_admit_90d",
    "had_prior_admit_365d",
    "is_frequent_flyer",
    "los_days_capped",
    "days_since_last_admit",
    "log_claim_pmt",
    "pass_thru_ratio",
    "hmo_coverage_months",
)
TARGET = "readmitted_30d"
LOS_TARGET = "los_days_log"
HIGH_COST_TARGET = "is_high_cost"
ID_COLUMNS = ("claim_id", "bene_id", "admit_dt", "provider_id")

# Discharge status -> risk; codes not listed have risk 2.
DISCHARGE_RISK = {1: 0, 6: 1, 2: 2, 3: 3, 30: 3, 20: 4}
DISCHARGE_RISK_OTHER = 2
ROUTINE_DISCHARGE = 1
FREQUENT_ADMITS = 3
PRIOR_90D_CAP, PRIOR_365D_CAP, LOS_CAP = 10, 20, 60
MISSING_FEATURE = -1.0


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _cap(value: Column, top: int) -> Column:
    """Upper clip that keeps nulls (``least`` alone would skip them)."""
    return F.when(value.isNotNull(), F.least(value, F.lit(top)))


def with_age_features(
    df: DataFrame,
    age: str = "age_at_admit",
    bins: Sequence[int] = AGE_BINS,
    labels: Sequence[str] = AGE_LABELS,
) -> DataFrame:
    """Half-open age bins: label (null outside) and position (-1 outside)."""
    group, position = F.lit(None).cast("string"), F.lit(-1)
    for i in reversed(range(len(labels))):
        inside = (F.col(age) >= bins[i]) & (F.col(age) < bins[i + 1])
        group = F.when(inside, F.lit(labels[i])).otherwise(group)
        position = F.when(inside, F.lit(i)).otherwise(position)
    return df.withColumns({"age_group": group, "age_group_ord": position})


def with_sex_flag(df: DataFrame, sex: str = "sex_cd") -> DataFrame:
    return df.withColumn("is_female", _flag(F.col(sex) == 2))


def with_admit_calendar(df: DataFrame, day: str = "admit_dt") -> DataFrame:
    """Month, quarter, weekday (0 = Monday) and their position on the circle."""
    month, weekday = F.month(day), F.weekday(day)
    turn_month, turn_week = F.lit(2) * F.pi() * month / 12, F.lit(2) * F.pi() * weekday / 7
    return df.withColumns(
        {
            "admit_month": month,
            "admit_quarter": F.quarter(day),
            "admit_dow": weekday,
            "admit_month_sin": F.sin(turn_month),
            "admit_month_cos": F.cos(turn_month),
            "admit_dow_sin": F.sin(turn_week),
            "admit_dow_cos": F.cos(turn_week),
        }
    )


def with_financial_ratios(df: DataFrame) -> DataFrame:
    paid, passed = F.col("claim_pmt_amt").cast("double"), F.col("pass_thru_amt").cast("double")
    return df.withColumns(
        {
            "pass_thru_ratio": F.coalesce(F.try_divide(passed, paid), F.lit(0.0)),
            "log_claim_pmt": F.log1p(F.coalesce(paid, F.lit(0.0))),
        }
    )


def with_utilization_flags(df: DataFrame) -> DataFrame:
    recent, year, los = F.col("prior_admits_90d"), F.col("prior_admits_365d"), F.col("los_days")
    return df.withColumns(
        {
            "had_prior_admit_90d": _flag(recent > 0),
            "had_prior_admit_365d": _flag(year > 0),
            "is_frequent_flyer": _flag(year >= FREQUENT_ADMITS),
            "prior_admits_90d_capped": _cap(recent, PRIOR_90D_CAP),
            "prior_admits_365d_capped": _cap(year, PRIOR_365D_CAP),
            "los_days_capped": F.coalesce(_cap(los, LOS_CAP), F.lit(0)),
        }
    )


def with_discharge_features(df: DataFrame) -> DataFrame:
    """Non-routine flag and ordinal discharge risk; a missing status counts as routine."""
    status = F.coalesce("discharge_status_cd", F.lit(ROUTINE_DISCHARGE))
    pairs = [F.lit(x) for item in DISCHARGE_RISK.items() for x in item]
    risk = F.coalesce(F.try_element_at(F.create_map(*pairs), status), F.lit(DISCHARGE_RISK_OTHER))
    return df.withColumns(
        {
            "is_not_routine_discharge": (status != ROUTINE_DISCHARGE).cast("int"),
            "discharge_risk_score": risk,
        }
    )


def high_weight_flag() -> Column:
    return F.greatest(*[F.col(f"cond_{c}") for c in HIGH_WEIGHT_CONDITIONS])


def with_high_weight_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("has_high_weight_comorbidity", high_weight_flag())


def with_row_features(df: DataFrame, bins=AGE_BINS, labels=AGE_LABELS) -> DataFrame:
    """All transforms that need nothing but the row."""
    return (
        df.transform(with_age_features, "age_at_admit", bins, labels)
        .transform(with_sex_flag)
        .transform(with_admit_calendar)
        .transform(with_financial_ratios)
        .transform(with_utilization_flags)
        .transform(with_discharge_features)
    )


def model_matrix(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Available features as doubles, missing values as -1; other columns unchanged."""
    kept = [c for c in columns if c in df.columns]
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING_FEATURE)) for c in kept}
    return df.withColumns(filled)
