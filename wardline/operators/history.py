"""Claim-level feature view: demographics, comorbidity and admission history.

History windows never see raw claims. Claims are first reduced to one row per
patient and admission day, so a patient's group is bounded by the calendar, not by
the number of claims; the windows run on that narrow table, patient attributes join
it on the same partitioning, and the wide claim rows are shuffled once, on
(patient, day), where a patient with very many claims is spread over days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.features import with_high_weight_flag
from wardline.sources.columns import CONDITION_CODES

# Patient attributes carried into the feature view.
PATIENT_COLUMNS = ("sex_cd", "race_cd", "hmo_coverage_months", "hi_coverage_months", "medreimb_ip", "death_dt")
DEATH_WINDOW_DAYS = 30


def age_in_years(birth: Column, day: Column) -> Column:
    """Completed years between two dates (calendar rule, correct for 29 February)."""
    day_of_year = F.month(day) * 100 + F.dayofmonth(day)
    before_birthday = day_of_year < F.month(birth) * 100 + F.dayofmonth(birth)
    return F.year(day) - F.year(birth) - before_birthday.cast("int")


def comorbidity_counts(conditions: DataFrame) -> DataFrame:
    """``bene_id, elixhauser_count`` over indicators 1 and 2."""
    return comorbidity_profile(conditions, flags=False)


def comorbidity_profile(conditions: DataFrame, flags: bool = True) -> DataFrame:
    """One row per patient: condition count and, if asked, a 0/1 column per condition."""
    present = conditions.where(F.col("indicator").isin(1, 2))
    columns = [F.count("*").cast("int").alias("elixhauser_count")]
    if flags:
        columns += [
            F.max((F.col("condition_code") == code).cast("int")).alias(f"cond_{code}")
            for code in CONDITION_CODES.values()
        ]
    return present.groupBy("bene_id").agg(*columns)


def admission_days(claims: DataFrame, windows: Sequence[int] = (90, 365)) -> DataFrame:
    """One row per patient and admission day with its history and its next day.

    ``prior_admits_<w>d`` counts admissions in ``[day - w, day)``,
    ``days_since_last_admit`` looks at strictly earlier days, ``next_day`` is the
    patient's next admission day and ``last_claim`` the last claim of this day.
    """
    days = claims.groupBy("bene_id", "admit_dt").agg(
        F.count("*").alias("day_admits"), F.max("claim_id").alias("last_claim")
    )
    # Day numbers serve both the range frames and lag/lead, so one sort is enough.
    by_day = Window.partitionBy("bene_id").orderBy(F.col("day_number").asc_nulls_last())
    known = F.col("admit_dt").isNotNull()
    days = days.withColumn("day_number", F.unix_date("admit_dt"))

    def prior(width: int) -> Column:
        total = F.sum("day_admits").over(by_day.rangeBetween(-width, -1))
        return F.when(known, F.coalesce(total, F.lit(0))).otherwise(0).cast("int")

    return days.select(
        "bene_id",
        "admit_dt",
        "last_claim",
        *[prior(w).alias(f"prior_admits_{w}d") for w in windows],
        F.when(known, F.datediff("admit_dt", F.lag("admit_dt").over(by_day))).alias("days_since_last_admit"),
        F.lead("admit_dt").over(by_day).alias("next_day"),
    )


def on_admission_day(claims: DataFrame, days: DataFrame) -> DataFrame:
    """Attach per-day attributes to claims (null-safe on the day)."""
    c, d = claims.alias("c"), days.alias("d")
    same = (F.col("c.bene_id") == F.col("d.bene_id")) & F.col("c.admit_dt").eqNullSafe(F.col("d.admit_dt"))
    extra = [F.col(f"d.{n}") for n in days.columns if n not in ("bene_id", "admit_dt")]
    return c.join(d, same).select("c.*", *extra)


def next_admission(last_claim: Column, next_day: Column) -> Column:
    """Next admission in (day, claim) order: the same day unless this claim is its last."""
    return F.when(F.col("claim_id") < last_claim, F.col("admit_dt")).otherwise(next_day)


def patient_features(
    claims: DataFrame,
    beneficiaries: DataFrame,
    conditions: DataFrame,
    windows: Sequence[int] = (90, 365),
    keep_next_admit: bool = False,
    condition_flags: bool = False,
    days: DataFrame | None = None,
) -> DataFrame:
    """The feature view: one row per claim whose patient is known.

    ``days`` is the ``admission_days`` table when the caller has it already.
    ``keep_next_admit`` adds ``next_admit_dt`` for the readmission label;
    ``condition_flags`` adds the 0/1 condition columns, joined per patient and day
    along with the other patient attributes instead of by a further join of claims.
    """
    profile = comorbidity_profile(conditions, condition_flags)
    counted = [c for c in profile.columns if c != "bene_id"]
    patients = beneficiaries.join(profile, "bene_id", "left").select(
        "bene_id", "birth_dt", *PATIENT_COLUMNS, *[F.coalesce(c, F.lit(0)).alias(c) for c in counted]
    )
    days = admission_days(claims, windows) if days is None else days
    rows = on_admission_day(claims, days.join(patients, "bene_id"))

    death_known = F.col("death_dt") <= F.date_add("discharge_dt", DEATH_WINDOW_DAYS)
    columns = [
        "claim_id",
        "bene_id",
        "admit_dt",
        "discharge_dt",
        "provider_id",
        "drg_cd",
        "admit_source_cd",
        "admit_type_cd",
        "discharge_status_cd",
        "claim_pmt_amt",
        "pass_thru_amt",
        "utilization_day_cnt",
        "admitting_icd9",
        age_in_years(F.col("birth_dt"), F.col("admit_dt")).alias("age_at_admit"),
        F.datediff("discharge_dt", "admit_dt").alias("los_days"),
        F.when(death_known, 1).otherwise(0).alias("died_within_30d"),
        "elixhauser_count",
        *[f"prior_admits_{w}d" for w in windows],
        "days_since_last_admit",
        *PATIENT_COLUMNS,
    ]
    if keep_next_admit:
        columns.append(next_admission(F.col("last_claim"), F.col("next_day")).alias("next_admit_dt"))
    if condition_flags:
        columns += [c for c in counted if c.startswith("cond_")]
    return rows.select(*columns)


def with_comorbidity_flags(df: DataFrame, conditions: DataFrame) -> DataFrame:
    """Join the condition flags onto any frame with ``bene_id``; no condition means zeros.

    The profile has one row per patient, so a patient with very many claims skews only
    the other side, which adaptive execution splits.
    """
    names = [f"cond_{code}" for code in CONDITION_CODES.values()]
    profile = comorbidity_profile(conditions).select("bene_id", *names)
    return with_high_weight_flag(df.join(profile, "bene_id", "left").fillna(0, names))
