"""Catalogue of runnable queries: one per operator, over the driver's order tables.

Every query reads whole tables. Results are brought to plain comparable types at the
end (``comparable``): whole numbers, doubles rounded to six places, text dates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.config import NULL_THRESHOLDS, Settings
from wardline.functions import coerce
from wardline.functions import features as fx
from wardline.operators import boosting, drift, explain, history, kpi, kpi_days, kpi_store, labels, metrics, ordering, quality, refresh, report, scoring, store, training, trees
from wardline.operators.normalize import (
    long_conditions,
    long_diagnoses,
    long_procedures,
    normalize_beneficiaries,
    normalize_claims,
)
from wardline.sources import extracts
from wardline.sources.columns import CONDITION_CODES
from wardline.sources.order_tables import OrderTables

# The order tables span 1995-01-01..2001-08-01: split at the midpoint.
SPLIT = date(1998, 4, 17)
UPSERT_CUT = date(2000, 1, 1)
RESOLVED_BEFORE = date(2001, 1, 1)
AS_OF = date(2001, 8, 5)
SETTINGS = Settings(split_date=SPLIT)
SEED = 42
# The scores that the calibration query takes as its input are rounded once, like its SQL.
SCORE_DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


class Job(OrderTables):
    """Order tables plus the derived frames that several queries share (all lazy)."""

    @cached_property
    def raw_bene(self) -> DataFrame:
        return coerce.missing_texts_to_null(self.raw_beneficiaries)

    @cached_property
    def raw_claims(self) -> DataFrame:
        return coerce.missing_texts_to_null(self.raw_inpatient)

    @cached_property
    def typed_bene(self) -> DataFrame:
        return extracts.type_beneficiaries(self.raw_bene)

    @cached_property
    def typed_claims(self) -> DataFrame:
        return extracts.type_inpatient(self.raw_claims)

    @cached_property
    def days(self) -> DataFrame:
        return history.admission_days(self.admissions)

    @cached_property
    def features(self) -> DataFrame:
        return history.patient_features(
            self.claims, self.beneficiaries, self.conditions, keep_next_admit=True, days=self.days
        )

    @cached_property
    def label_rows(self) -> DataFrame:
        """Claims with the readmission label only."""
        return labels.readmission_labels(self.claims, days=self.days)

    @cached_property
    def labelled(self) -> DataFrame:
        """Feature view with the readmission label and the discharge flags."""
        label = labels.readmitted(F.col("next_admit_dt"), F.col("discharge_dt"))
        return self.features.withColumn(fx.TARGET, label).transform(fx.with_discharge_features)

    @cached_property
    def carded(self) -> DataFrame:
        """Labelled features with the scorecard inputs and its probability."""
        counts = history.comorbidity_counts(self.conditions)
        top = F.greatest(counts.agg(F.max("elixhauser_count")).scalar(), F.lit(1))
        inputs = scoring.with_scorecard_inputs(self.labelled, top)
        return inputs.withColumn("readmission_prob", scoring.scorecard())

    @cached_property
    def scores(self) -> DataFrame:
        """Risk-score rows of the scorecard; a claim is scored on its admission day."""
        return scoring.score_rows(self.carded, "v1", F.col("admit_dt"))

    @cached_property
    def kpi_rows(self) -> DataFrame:
        """KPI input straight from the scored features (claim columns are in the view)."""
        tier = scoring.risk_tier(F.col("readmission_prob"))
        return self.carded.withColumns({"risk_tier": tier, "readmission_label": F.col(fx.TARGET)})

    @cached_property
    def kpi_history(self) -> DataFrame:
        """A snapshot per month of admission."""
        return kpi.kpi_snapshot(self.kpi_rows, F.last_day("admit_dt"))

    @cached_property
    def matrix(self) -> DataFrame:
        """All features and labels before target encoding."""
        limit = labels.fit_high_cost_threshold(self.payments, SETTINGS.high_cost_percentile)
        view = history.patient_features(
            self.claims, self.beneficiaries, self.conditions, keep_next_admit=True, condition_flags=True,
            days=self.days,
        )
        rows = fx.with_high_weight_flag(fx.with_row_features(view))
        return labels.with_labels(rows, limit)

    @cached_property
    def encoded(self) -> DataFrame:
        """Model rows, with the encoding fitted before the split date."""
        encoding = labels.fit_target_encoding(labels.split_by_date(self.label_rows, SPLIT)[0])
        rows = encoding.apply(self.matrix, "drg_cd_encoded")
        targets = [fx.TARGET, fx.LOS_TARGET, fx.HIGH_COST_TARGET]
        return rows.select(*fx.ID_COLUMNS, *fx.FEATURE_COLUMNS, *targets)

    @cached_property
    def stored_sides(self) -> tuple[DataFrame, DataFrame]:
        """(train, test) rows as a written table: training makes many passes."""
        return labels.split_by_date(store.materialize(self.encoded, "model-rows"), SPLIT)

    def matrix_sides(self, label: str) -> tuple[DataFrame, DataFrame]:
        """(train, test) matrices for one label, written straight from the features."""
        return training.prepare_sides(self.encoded, label, SPLIT, "matrix")


def query(function: Callable[[Job], DataFrame]) -> Callable[[Job], DataFrame]:
    """Register ``function(job)`` under its own name."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        return comparable(function(Job(spark, directory)))

    QUERIES[function.__name__] = run
    return function


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for comparison: ints, bigints, rounded doubles, text."""

    def plain(field: T.StructField) -> Column:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            value = F.round(value.cast("double"), 6) + F.lit(0.0)
        elif isinstance(kind, (T.ByteType, T.ShortType)):
            value = value.cast("int")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("date").cast("string")
        elif isinstance(kind, T.BooleanType):
            value = value.cast("int")
        return value.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# --- ingest --------------------------------------------------------------------


@query
def union_extracts(job: Job) -> DataFrame:
    """Customer and supplier rows as two beneficiary extracts with different columns."""
    first = job.table("customer").select(
        F.col("c_name").alias("DESYNPUF_ID"), F.col("c_acctbal").alias("MEDREIMB_IP"), F.col("c_mktsegment").alias("SEGMENT")
    )
    second = job.table("supplier").select(F.col("s_name").alias("DESYNPUF_ID"), F.col("s_acctbal").alias("MEDREIMB_IP"))
    return extracts.union_extracts([first, second])


@query
def dedup_keep_first(job: Job) -> DataFrame:
    """Service lines reduced to the first line of each claim by shipping date."""
    columns = ["l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = job.table("lineitem").select(*columns)
    return store.first_per_key(lines, ["l_orderkey"], [F.col(c) for c in columns[1:]])


@query
def parse_dates(job: Job) -> DataFrame:
    columns = ["CLM_ADMSN_DT", "NCH_BENE_DSCHRG_DT"]
    return coerce.parse_dates(job.raw_claims.select("CLM_ID", *columns), columns)


@query
def coerce_int(job: Job) -> DataFrame:
    columns = ["CLM_DRG_CD", "PTNT_DSCHRG_STUS_CD", "CLM_UTLZTN_DAY_CNT"]
    return coerce.coerce_ints(job.raw_claims.select("CLM_ID", *columns), columns)


@query
def coerce_float(job: Job) -> DataFrame:
    columns = ["CLM_PMT_AMT", "CLM_PASS_THRU_AMT"]
    return coerce.coerce_floats(job.raw_claims.select("CLM_ID", *columns), columns)


# --- quality -------------------------------------------------------------------


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@query
def critical_nulls(job: Job) -> DataFrame:
    return _stack(
        [
            quality.critical_null_counts(job.typed_bene, SETTINGS.critical_beneficiaries, "beneficiaries"),
            quality.critical_null_counts(job.typed_claims, SETTINGS.critical_inpatient, "inpatient"),
        ]
    )


@query
def null_rate_violations(job: Job) -> DataFrame:
    return quality.null_rates(job.typed_claims, NULL_THRESHOLDS, "inpatient")


@query
def cast_failures(job: Job) -> DataFrame:
    dates, amounts = ["CLM_ADMSN_DT", "NCH_BENE_DSCHRG_DT"], ["CLM_PMT_AMT", "CLM_PASS_THRU_AMT"]
    checked = dates + ["CLM_DRG_CD", "PTNT_DSCHRG_STUS_CD", "CLM_UTLZTN_DAY_CNT"] + amounts
    return _stack(
        [
            quality.cast_failures(job.raw_bene, extracts.type_beneficiaries, ["BENE_BIRTH_DT", "BENE_SEX_IDENT_CD"], "beneficiaries"),
            quality.cast_failures(job.raw_claims, extracts.type_inpatient, checked, "inpatient"),
        ]
    )


@query
def duplicate_keys(job: Job) -> DataFrame:
    """Service lines whose (claim, line) key repeats, every row of them."""
    lines = job.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return quality.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query
def domain_violations(job: Job) -> DataFrame:
    rules = [r for r in quality.beneficiary_rules() if r.check.startswith("isin")]
    return quality.violation_counts(job.typed_bene, rules, "beneficiaries")


@query
def bound_violations(job: Job) -> DataFrame:
    return quality.violation_counts(job.typed_claims, quality.inpatient_rules(), "inpatient")


@query
def range_violations(job: Job) -> DataFrame:
    low, high = SETTINGS.ranges["CLM_PMT_AMT"]
    paid = quality.violation_counts(job.typed_claims, [quality.in_range("CLM_PMT_AMT", low, high)], "inpatient")
    derived = [quality.in_range(c, *SETTINGS.ranges[c]) for c in ("age_at_admit", "los_days")]
    return paid.unionByName(quality.violation_counts(job.features, derived, "patient_features"))


@query
def failure_cases(job: Job) -> DataFrame:
    return _stack(
        [
            quality.failure_cases(job.typed_bene, quality.beneficiary_rules(), "DESYNPUF_ID", "beneficiaries"),
            quality.duplicate_failures(job.typed_bene, "DESYNPUF_ID", "beneficiaries"),
            quality.failure_cases(job.typed_claims, quality.inpatient_rules(), "CLM_ID", "inpatient"),
            quality.duplicate_failures(job.typed_claims, "CLM_ID", "inpatient"),
        ]
    )


@query
def fk_orphans(job: Job) -> DataFrame:
    """Claims whose patient was not loadable, and codes of claims that were not."""
    patients = normalize_beneficiaries(job.typed_bene).where("birth_dt is not null")
    claims = normalize_claims(job.typed_claims)
    loadable = claims.where("admit_dt is not null and bene_id is not null")
    return quality.orphan_summary(
        [
            ("claims_to_beneficiaries", claims, patients, "bene_id"),
            ("diagnoses_to_claims", long_diagnoses(job.typed_claims), loadable, "claim_id"),
        ]
    )


@query
def validation_summary(job: Job) -> DataFrame:
    return _stack(
        [
            quality.table_summary(
                job.typed_bene, quality.beneficiary_rules(), quality.BENEFICIARY_TYPES, NULL_THRESHOLDS,
                "DESYNPUF_ID", "beneficiaries",
            ),
            quality.table_summary(
                job.typed_claims, quality.inpatient_rules(), quality.INPATIENT_TYPES, NULL_THRESHOLDS,
                "CLM_ID", "inpatient",
            ),
        ]
    )


# --- normalisation -------------------------------------------------------------


@query
def norm_beneficiaries(job: Job) -> DataFrame:
    return normalize_beneficiaries(job.typed_bene)


@query
def norm_claims(job: Job) -> DataFrame:
    return normalize_claims(job.typed_claims)


@query
def unpivot_conditions(job: Job) -> DataFrame:
    return long_conditions(job.typed_bene)


@query
def unpivot_diagnoses(job: Job) -> DataFrame:
    return long_diagnoses(job.typed_claims)


@query
def unpivot_procedures(job: Job) -> DataFrame:
    return long_procedures(job.typed_claims)


# --- history -------------------------------------------------------------------


@query
def age_at_admit(job: Job) -> DataFrame:
    joined = job.admissions.join(job.beneficiaries.select("bene_id", "birth_dt"), "bene_id")
    return joined.select("claim_id", history.age_in_years(F.col("birth_dt"), F.col("admit_dt")).alias("age_at_admit"))


@query
def elixhauser_count(job: Job) -> DataFrame:
    return history.comorbidity_counts(job.conditions)


@query
def prior_admits(job: Job) -> DataFrame:
    return history.on_admission_day(job.admissions, job.days).select("claim_id", "prior_admits_90d", "prior_admits_365d")


@query
def days_since_last(job: Job) -> DataFrame:
    return history.on_admission_day(job.admissions, job.days).select("claim_id", "days_since_last_admit")


@query
def patient_features(job: Job) -> DataFrame:
    return history.patient_features(job.claims, job.beneficiaries, job.conditions, days=job.days)


@query
def kpi_input(job: Job) -> DataFrame:
    return kpi.kpi_input(job.scores, job.claims, job.features)


# --- feature transforms --------------------------------------------------------


@query
def age_bins(job: Job) -> DataFrame:
    return fx.with_age_features(job.features).select("claim_id", "age_at_admit", "age_group", "age_group_ord")


@query
def sex_flag(job: Job) -> DataFrame:
    return fx.with_sex_flag(job.beneficiaries).select("bene_id", "sex_cd", "is_female")


@query
def admit_calendar(job: Job) -> DataFrame:
    return fx.with_admit_calendar(job.admissions).select("claim_id", "admit_month", "admit_quarter", "admit_dow")


@query
def admit_cyclic(job: Job) -> DataFrame:
    names = ["admit_month_sin", "admit_month_cos", "admit_dow_sin", "admit_dow_cos"]
    return fx.with_admit_calendar(job.admissions).select("claim_id", *names)


@query
def financial_ratios(job: Job) -> DataFrame:
    return fx.with_financial_ratios(job.claims).select("claim_id", "pass_thru_ratio", "log_claim_pmt")


@query
def utilization_flags(job: Job) -> DataFrame:
    return fx.with_utilization_flags(job.features).select(
        "claim_id", "had_prior_admit_90d", "had_prior_admit_365d", "is_frequent_flyer",
        "prior_admits_90d_capped", "prior_admits_365d_capped", "los_days_capped",
    )


@query
def discharge_risk(job: Job) -> DataFrame:
    return fx.with_discharge_features(job.claims).select(
        "claim_id", "discharge_status_cd", "is_not_routine_discharge", "discharge_risk_score"
    )


@query
def comorbidity_pivot(job: Job) -> DataFrame:
    flags = history.with_comorbidity_flags(job.admissions, job.conditions)
    names = [f"cond_{c}" for c in CONDITION_CODES.values()]
    return flags.select("claim_id", *names, "has_high_weight_comorbidity")


@query
def model_matrix(job: Job) -> DataFrame:
    rows = fx.model_matrix(fx.with_row_features(job.features))
    names = [c for c in fx.FEATURE_COLUMNS if c in rows.columns]
    return rows.select("claim_id", *names)


@query
def feature_pipeline(job: Job) -> DataFrame:
    side = F.when(F.col("admit_dt") < F.lit(SPLIT), "train").otherwise("test")
    return job.encoded.withColumn("side", side)


# --- labels --------------------------------------------------------------------


@query
def readmission_label(job: Job) -> DataFrame:
    return job.label_rows.select("claim_id", fx.TARGET)


@query
def readmission_rate(job: Job) -> DataFrame:
    return labels.readmission_rate(job.claims, days=job.days)


@query
def label_los(job: Job) -> DataFrame:
    los = F.datediff("discharge_dt", "admit_dt")
    return job.claims.select("claim_id", labels.los_target(los).alias(fx.LOS_TARGET))


@query
def label_high_cost(job: Job) -> DataFrame:
    limit = labels.fit_high_cost_threshold(job.payments)
    label = labels.high_cost_target(F.col("claim_pmt_amt"), limit)
    return job.payments.select("claim_id", label.alias(fx.HIGH_COST_TARGET), F.lit(limit).alias("threshold"))


@query
def temporal_split(job: Job) -> DataFrame:
    return labels.split_summary(job.label_rows, SPLIT)


@query
def target_encode(job: Job) -> DataFrame:
    rows = job.label_rows
    train, test = labels.split_by_date(rows, SPLIT)
    encoding = labels.fit_target_encoding(train)
    return encoding.apply(train.unionByName(test), "drg_cd_encoded").select("claim_id", "drg_cd", "drg_cd_encoded")


@query
def target_encode_text(job: Job) -> DataFrame:
    """Text categories of any number: each patient's id is one, with numbers above 16 bits."""
    rows = job.label_rows.withColumn("category", F.format_string("patient-%d", F.col("bene_id").cast("bigint") * 100_003))
    train, _ = labels.split_by_date(rows, SPLIT)
    encoded = labels.fit_target_encoding(train, "category").apply(rows, "encoded")
    return encoded.select("claim_id", "category", "encoded")


@query
def quantile_by_month(job: Job) -> DataFrame:
    """Exact 80 % quantile of the payments of each month of each year."""
    paid = job.claims.select(F.year("admit_dt").alias("year"), F.month("admit_dt").alias("month"), "claim_pmt_amt")
    return ordering.grouped_quantile(paid, ["year", "month"], "claim_pmt_amt", 0.8)


@query
def stratified_holdout(job: Job) -> DataFrame:
    rows = job.label_rows
    return labels.stratified_holdout(rows, seed=SEED).select("claim_id", fx.TARGET, "is_holdout")


@query
def stratified_folds(job: Job) -> DataFrame:
    rows = job.label_rows
    return labels.stratified_folds(rows, 5, seed=SEED).select("claim_id", fx.TARGET, "fold")


@query
def class_weights(job: Job) -> DataFrame:
    return labels.class_weights(job.label_rows)


# --- evaluation (of the scorecard) ---------------------------------------------


@query
def auroc(job: Job) -> DataFrame:
    return metrics.auroc(job.carded, fx.TARGET, "readmission_prob")


@query
def average_precision(job: Job) -> DataFrame:
    return metrics.average_precision(job.carded, fx.TARGET, "readmission_prob")


@query
def brier(job: Job) -> DataFrame:
    return metrics.brier(job.carded, fx.TARGET, "readmission_prob")


@query
def sens_at_spec(job: Job) -> DataFrame:
    return metrics.sensitivity_at_specificity(job.carded, fx.TARGET, "readmission_prob")


@query
def ece(job: Job) -> DataFrame:
    return metrics.expected_calibration_error(job.carded, fx.TARGET, "readmission_prob")


@query
def roc_curve(job: Job) -> DataFrame:
    return metrics.roc_curve(job.carded, fx.TARGET, "readmission_prob")


@query
def calibration_table(job: Job) -> DataFrame:
    return metrics.calibration_table(job.carded, fx.TARGET, "readmission_prob")


@query
def evaluate(job: Job) -> DataFrame:
    return metrics.evaluate(job.carded, fx.TARGET, "readmission_prob", "scorecard")


@query
def regression_metrics(job: Job) -> DataFrame:
    """Stay predicted by the claim's month of admission, against the real stay."""
    rows = job.claims.select(
        labels.los_target(F.datediff("discharge_dt", "admit_dt")).alias("actual"),
        F.log1p(F.month("admit_dt").cast("double")).alias("predicted"),
    )
    return metrics.regression_metrics(rows, "actual", "predicted", "month_rule")


@query
def soft_vote(job: Job) -> DataFrame:
    """Scorecard and encoded DRG as the two voters."""
    encoding = labels.fit_target_encoding(labels.split_by_date(job.label_rows, SPLIT)[0])
    rows = encoding.apply(job.carded, "drg_cd_encoded")
    blend = training.soft_vote(F.col("readmission_prob"), F.col("drg_cd_encoded"))
    return rows.select("claim_id", blend.alias("blend")).withColumn("vote", training.vote_class(F.col("blend")))


@query
def isotonic_calibrate(job: Job) -> DataFrame:
    """Isotonic fit of the scorecard, at each of its scores."""
    rows = job.carded.select(fx.TARGET, F.round("readmission_prob", SCORE_DIGITS).alias("score"))
    stored = store.materialize(rows, "calibration-rows")
    model = training.fit_isotonic(stored, fx.TARGET, "score")
    grid = stored.groupBy("score").agg(F.count("*").alias("cases"))
    return model.transform(grid).select("score", "cases", "calibrated")


# --- explanation ---------------------------------------------------------------


def _card_parts(job: Job) -> tuple[DataFrame, dict[str, Column]]:
    names = list(scoring.SCORE_WEIGHTS)
    means = job.carded.agg(F.struct(*[F.avg(n).alias(n) for n in names]).alias("means"))
    rows = job.carded.withColumn("means", means.scalar())
    return rows, {n: F.col(f"means.{n}") for n in names}


@query
def top3_linear(job: Job) -> DataFrame:
    rows, means = _card_parts(job)
    parts = explain.linear_attributions(scoring.SCORE_WEIGHTS, means)
    named = rows.select("claim_id", explain.top_names(parts).alias("top"))
    return named.select("claim_id", *[F.get("top", i).alias(f"top_{i + 1}") for i in range(3)])


@query
def global_top(job: Job) -> DataFrame:
    rows, means = _card_parts(job)
    values = {n: F.lit(w) * (F.col(n) - means[n]) for n, w in scoring.SCORE_WEIGHTS.items()}
    return explain.global_ranking(rows, values)


@query
def attribution_sample(job: Job) -> DataFrame:
    return explain.attribution_sample(job.admissions.select("claim_id", "bene_id"), rows=1000, seed=SEED)


# --- scoring and drift ---------------------------------------------------------


@query
def scorecard(job: Job) -> DataFrame:
    return job.carded.select("claim_id", "readmission_prob")


@query
def risk_tiers(job: Job) -> DataFrame:
    return job.scores.select("claim_id", "readmission_prob", "risk_tier")


@query
def tier_shares(job: Job) -> DataFrame:
    return scoring.tier_shares(job.scores)


@query
def score_baseline(job: Job) -> DataFrame:
    train, _ = labels.split_by_date(job.carded, SPLIT)
    return drift.score_baseline(train)


def _drift(job: Job) -> DataFrame:
    train, test = labels.split_by_date(job.carded, SPLIT)
    baseline = drift.score_baseline(train).first().asDict()
    return drift.drift_checks(test, baseline, Settings(drift_mean_prob=0.01, drift_high_risk_pct=1.0), F.last_day("admit_dt"))


@query
def drift_checks(job: Job) -> DataFrame:
    """Each month after the split as a scoring run, against the training side."""
    return _drift(job).drop("message")


def _spikes(job: Job) -> DataFrame:
    train, test = labels.split_by_date(job.features, SPLIT)
    columns = ["days_since_last_admit", "discharge_status_cd", "los_days", "provider_id", "death_dt"]
    return drift.null_spikes(test, train, columns)


@query
def null_spike(job: Job) -> DataFrame:
    return _spikes(job)


@query
def freshness_check(job: Job) -> DataFrame:
    return drift.freshness_check(job.kpi_history, AS_OF)


@query
def open_alerts(job: Job) -> DataFrame:
    """Drift and freshness alerts of all months; alerts before 2001 count as resolved."""
    drifted = drift.drift_alerts(_drift(job), F.col("run"))
    stale = drift.freshness_alerts(job.kpi_history.where(F.col("snapshot_date") < F.lit(UPSERT_CUT)), AS_OF, F.lit(AS_OF))
    every = drifted.unionByName(stale)
    closed = every.withColumn("resolved", F.col("created_at") < F.lit(RESOLVED_BEFORE).cast("timestamp"))
    return report.open_alerts(closed)


# --- tables and views ----------------------------------------------------------


@query
def insert_ignore(job: Job) -> DataFrame:
    """Claims before 2000 are loaded; a later batch brings old and new ones."""
    columns = ["claim_id", "provider_id", "admit_dt", "claim_pmt_amt"]
    target = job.claims.select(*columns).where(F.col("admit_dt") < F.lit(UPSERT_CUT))
    batch = job.claims.select(*columns).where(F.col("admit_dt") >= F.lit(SPLIT)).withColumn("provider_id", F.lit("LATE"))
    fresh = store.insert_ignore(target, batch.unionByName(batch), ["claim_id"], [F.col("admit_dt")])
    return target.unionByName(fresh)


@query
def kpi_upsert(job: Job) -> DataFrame:
    """KPI history before 2000, then a rerun from the split date on (April 1998 in part)."""
    month = F.last_day("admit_dt")
    old = kpi.kpi_snapshot(job.kpi_rows.where(F.col("admit_dt") < F.lit(UPSERT_CUT)), month)
    new = kpi.kpi_snapshot(job.kpi_rows.where(F.col("admit_dt") >= F.lit(SPLIT)), month)
    root = f"{store.workspace(job.spark)}/wardline/kpis-{uuid.uuid4().hex}"
    kpi_store.write_kpis(old, root)
    return kpi_store.write_kpis(new, root)


@query
def risk_score_upsert(job: Job) -> DataFrame:
    """Scores before 2000, then a second run with halved probabilities from the split on."""
    old = scoring.score_rows(job.carded.where(F.col("admit_dt") < F.lit(UPSERT_CUT)), "v1", F.col("admit_dt"))
    rerun = job.carded.where(F.col("admit_dt") >= F.lit(SPLIT)).withColumns(
        {"readmission_prob": F.col("readmission_prob") / 2, fx.TARGET: 1 - F.col(fx.TARGET)}
    )
    new = scoring.score_rows(rerun, "v2", F.lit(AS_OF))
    merged = store.upsert_risk_scores(old, new)
    kept = ["claim_id", "bene_id", "scored_at", "model_version", "readmission_prob", "risk_tier", "readmission_label"]
    return merged.select(*kept)


@query
def ensure_columns(job: Job) -> DataFrame:
    wanted = T.StructType(
        [
            T.StructField("model_run_id", T.StringType()),
            T.StructField("readmit_prob_ci_lower", T.DoubleType()),
            T.StructField("readmit_prob_ci_upper", T.DoubleType()),
        ]
    )
    narrow = job.scores.select("claim_id", "readmission_prob")
    return store.ensure_columns(store.ensure_columns(narrow, wanted), wanted)


@query
def export_risk_scores(job: Job) -> DataFrame:
    extract = report.risk_score_extract(job.scores, job.features)
    return extract.drop("shap_top_feature_1", "shap_top_feature_2", "shap_top_feature_3")


@query
def export_kpi(job: Job) -> DataFrame:
    return report.kpi_extract(job.kpi_history)


@query
def export_features(job: Job) -> DataFrame:
    return report.feature_extract(job.features)


@query
def v_kpi_readmission(job: Job) -> DataFrame:
    return kpi.kpi_readmission_view(job.kpi_history)


@query
def v_kpi_avg_los(job: Job) -> DataFrame:
    return kpi.kpi_avg_los_view(job.kpi_history)


@query
def v_risk_summary(job: Job) -> DataFrame:
    return scoring.risk_summary(job.scores)


# --- KPIs and report -----------------------------------------------------------


@query
def kpi_snapshot(job: Job) -> DataFrame:
    return kpi.kpi_snapshot(job.kpi_rows, F.lit(AS_OF))


@query
def kpi_rollup(job: Job) -> DataFrame:
    return kpi.kpi_wide(job.kpi_rows, F.lit(AS_OF))


@query
def kpi_latest(job: Job) -> DataFrame:
    return kpi.latest_overall(job.kpi_history)


@query
def kpi_lookback(job: Job) -> DataFrame:
    return kpi.kpi_snapshot(kpi.lookback(job.kpi_rows, AS_OF, SETTINGS.snapshot_lookback_days), F.lit(AS_OF))


@query
def kpi_from_days(job: Job) -> DataFrame:
    """KPIs of the whole history and of a lookback, merged from the daily state alone."""
    state = store.materialize(kpi_days.daily_state(job.kpi_rows), "kpi-days")
    parts = [
        kpi_days.snapshot_from_days(state, AS_OF, days).withColumn("days", F.lit(days).cast("int"))
        for days in (None, SETTINGS.snapshot_lookback_days, 365)
    ]
    return reduce(DataFrame.unionByName, parts).drop("median_los_days")


@query
def features_by_batches(job: Job) -> DataFrame:
    """The feature view after three batches of claims that arrive out of order."""
    root = f"{store.workspace(job.spark)}/wardline/features-{uuid.uuid4().hex}"
    arrives = F.pmod(F.xxhash64("claim_id"), F.lit(3))
    claims = store.materialize(job.claims.withColumn("arrives", arrives), "claims-by-batch")
    for number in range(3):
        seen = claims.where(F.col("arrives") <= number).drop("arrives")
        view = refresh.refresh((claims.where(F.col("arrives") == number),), (seen, job.beneficiaries, job.conditions), root)
    return view.select(
        "claim_id", "bene_id", "admit_dt", "age_at_admit", "los_days", "died_within_30d", "elixhauser_count",
        "prior_admits_90d", "prior_admits_365d", "days_since_last_admit",
    )


@query
def provider_table(job: Job) -> DataFrame:
    return report.provider_table(job.scores, job.features)


@query
def tier_chart_data(job: Job) -> DataFrame:
    return report.tier_chart_data(job.scores, job.features)


@query
def kpi_status(job: Job) -> DataFrame:
    return report.kpi_status(job.kpi_history)


@query
def trend_readmission(job: Job) -> DataFrame:
    return report.metric_trend(job.kpi_history)


@query
def cost_by_drg(job: Job) -> DataFrame:
    return report.cost_by_drg(job.claims)


@query
def tier_by_provider(job: Job) -> DataFrame:
    return report.tier_by_provider(job.scores, job.features)


@query
def readmit_by_age(job: Job) -> DataFrame:
    return report.readmission_by_age(fx.with_age_features(job.labelled))


@query
def dow_heatmap(job: Job) -> DataFrame:
    return report.weekday_heatmap(job.admissions)


# --- trained models (no SQL equivalent) ----------------------------------------


def _model_root(job: Job) -> str:
    return f"{store.workspace(job.spark)}/wardline/models-{uuid.uuid4().hex}"


def _fit_rows(job: Job) -> tuple[DataFrame, DataFrame]:
    train, test = job.matrix_sides(fx.TARGET)
    return labels.with_class_weight(train), test


@query
def model_logistic(job: Job) -> DataFrame:
    fit_rows, test_rows = _fit_rows(job)
    scored = training.fit_logistic(fit_rows).transform(test_rows)
    return scored.select("claim_id", fx.TARGET, training.positive("logistic_probability").alias("prob"))


@query
def model_gbt_a(job: Job) -> DataFrame:
    fit_rows, test_rows = _fit_rows(job)
    scored = training.boosted_trees().fit(fit_rows).transform(test_rows)
    return scored.select("claim_id", fx.TARGET, training.positive("gbt_probability").alias("prob"))


@query
def model_rf_b(job: Job) -> DataFrame:
    fit_rows, test_rows = _fit_rows(job)
    scored = training.random_forest().fit(fit_rows).transform(test_rows)
    return scored.select("claim_id", fx.TARGET, training.positive("forest_probability").alias("prob"))


@query
def train_ladder(job: Job) -> DataFrame:
    result = training.train_readmission(
        *job.stored_sides, _model_root(job), "1", SETTINGS
    )
    return result.metrics


@query
def score_claims(job: Job) -> DataFrame:
    train, test = job.stored_sides
    fit_rows, hold_rows = training.holdout_split(train, SEED)
    model = training.fit_ensemble(fit_rows, hold_rows, training.feature_names(train), SETTINGS)
    path = f"{_model_root(job)}/v1"
    model.save(path)
    scored = training.score_assembled(model, training.prepare(test, fx.TARGET, "score"), path)
    scored = training.predict_los(training.fit_los(training.prepare(train, fx.LOS_TARGET, "los-train"), SEED), scored)
    scored = scored.drop(*[c for c in scored.columns if c.startswith("gbt_")])
    cost = training.fit_high_cost(training.prepare(train, fx.HIGH_COST_TARGET, "cost-train"), SEED)
    scored = cost.transform(scored).withColumn("high_cost_prob", training.positive("gbt_probability"))
    return scoring.score_rows(scored, "1", F.lit(AS_OF))


@query
def model_leafwise_b(job: Job) -> DataFrame:
    fit_rows, test_rows = _fit_rows(job)
    scored = boosting.LeafwiseTrees(fx.TARGET).fit(fit_rows).transform(test_rows)
    return scored.select("claim_id", fx.TARGET, F.col(boosting.PROBABILITY).alias("prob"))


@query
def model_checks(job: Job) -> DataFrame:
    """What must hold for the fitted models on all test rows: rows checked and rows that fail."""
    train, test = job.stored_sides
    fit_rows, hold_rows = training.holdout_split(train, SEED)
    names = training.feature_names(train)
    model = training.fit_ensemble(fit_rows, hold_rows, names, SETTINGS)
    path = f"{_model_root(job)}/v1"
    model.save(path)
    loaded = training.ReadmissionModel.load(job.spark, path)
    rows = training.prepare(test, fx.TARGET, "check")
    forest = trees.read_forest(job.spark, f"{path}/gbt", model.gbt.treeWeights)
    parts = trees.tree_attributions(rows, forest, names)
    total = F.aggregate(parts, F.lit(forest.base_value()), lambda s, p: s + p["value"])
    scored = loaded.score(rows.withColumn("explained", total))
    wanted = loaded.leafwise.forest
    scored = scored.withColumn("sum_b", trees.tree_margin(rows, wanted) + F.lit(loaded.leafwise.base))
    scored = store.materialize(
        scored.select(
            "claim_id", "explained", "sum_b", "gbt_prob", "leafwise_prob", training.BLEND, training.PROB,
            training.vector_to_array("gbt_raw")[1].alias("margin_a"),
        ),
        "checked",
    )
    by_blend = scored.groupBy(training.BLEND).agg(F.min(training.PROB).alias("low"), F.max(training.PROB).alias("high"))
    # Calibrated probabilities rise with the blend: the steps' order is the same on both.
    steps = by_blend.groupBy("low").agg(F.min(training.BLEND).alias("first"), F.max(training.BLEND).alias("last"))
    steps = steps.alias("s").join(steps.alias("t"), F.col("s.low") < F.col("t.low"))
    crossed = steps.where(F.col("s.last") > F.col("t.first")).select(F.lit(1).alias("bad"))
    near = {
        "attributions_add_up": F.abs(F.col("explained") - F.col("margin_a")),
        "gbt_is_the_sigmoid": F.abs(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * F.col("margin_a"))) - F.col("gbt_prob")),
        "leafwise_is_the_sigmoid": F.abs(F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("sum_b"))) - F.col("leafwise_prob")),
        "blend_is_the_mean": F.abs((F.col("gbt_prob") + F.col("leafwise_prob")) / 2 - F.col(training.BLEND)),
        "calibrated_is_a_share": F.when(F.col(training.PROB).between(0, 1), 0.0).otherwise(1.0),
    }
    counts = scored.agg(F.count("*").alias("rows"), *[F.count_if(~(gap < 1e-9) | gap.isNull()).alias(n) for n, gap in near.items()])
    long = counts.unpivot(["rows"], list(near), "check_name", "failures")
    rising = crossed.agg(F.count("*").alias("failures")).crossJoin(counts.select("rows"))
    rising = rising.select("rows", F.lit("calibrated_rises").alias("check_name"), "failures")
    return long.unionByName(rising).unionByName(_logistic_check(fit_rows, rows))


def _logistic_check(fit_rows: DataFrame, test_rows: DataFrame) -> DataFrame:
    """At the optimum the penalised gradient of every coefficient is zero."""
    model = training.fit_logistic(fit_rows)
    learner = model.stages[-1]
    weights, strength = learner.coefficients.toArray(), 1.0 / (training.LOGISTIC_C * max(fit_rows.count(), 1))
    scored = model.transform(fit_rows).select(
        (training.positive("logistic_probability") - F.col(fx.TARGET)).alias("gap"), training.vector_to_array("scaled").alias("x")
    )
    slopes = [F.avg(F.col("gap") * F.col("x")[k]) for k in range(len(weights))]
    gradient = scored.agg(F.avg("gap"), *slopes).first()
    bad = sum(abs(g + strength * w) > 1e-3 for g, w in zip(gradient, [0.0, *weights]))
    return test_rows.agg(F.count("*").alias("rows")).select("rows", F.lit("logistic_gradient_is_zero").alias("check_name"), F.lit(int(bad)).cast("bigint").alias("failures"))


@query
def top3_tree(job: Job) -> DataFrame:
    fit_rows, test_rows = _fit_rows(job)
    model = training.boosted_trees().fit(fit_rows)
    path = f"{_model_root(job)}/gbt"
    model.write().save(path)
    forest = trees.read_forest(job.spark, path, model.treeWeights)
    parts = trees.tree_attributions(test_rows, forest, training.feature_names(job.encoded))
    named = test_rows.select("claim_id", explain.top_names(parts).alias("top"))
    return named.select("claim_id", *[F.get("top", i).alias(f"top_{i + 1}") for i in range(3)])


@query
def model_los(job: Job) -> DataFrame:
    return training.assess_los(*job.matrix_sides(fx.LOS_TARGET), SEED)[1]


@query
def los_pred_vs_actual(job: Job) -> DataFrame:
    _, _, scored = training.assess_los(*job.matrix_sides(fx.LOS_TARGET), SEED)
    return report.los_predicted_vs_actual(scored, job.features)


@query
def model_high_cost(job: Job) -> DataFrame:
    return training.assess_high_cost(*job.matrix_sides(fx.HIGH_COST_TARGET), SEED)[1]
