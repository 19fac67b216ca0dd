"""The batch pipeline over a warehouse folder: load, features, train, score, report.

Every stage is a function that reads tables and writes tables; stages can run in
separate applications. The folder holds ``claims/*`` (loaded tables), ``analytics/*``
(feature view, scores, KPIs, alerts) and ``models/v<version>``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions import features as fx
from wardline.operators import audit, drift, history, kpi, kpi_store, labels, quality, report, scoring, store, training
from wardline.operators.normalize import (
    long_conditions,
    long_diagnoses,
    long_procedures,
    normalize_beneficiaries,
    normalize_claims,
    with_all_columns,
)
from wardline.operators.store import write_json
from wardline.sources import extracts
from wardline.sources.columns import BENEFICIARY_COLUMNS, BENEFICIARY_INTS, CLAIM_COLUMNS, CLAIM_INTS, raw_columns
from wardline.sources.extracts import ClaimsExtract


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def current(self, name: str) -> DataFrame:
        df = store.read_current(self.spark, self.path(name))
        if df is None:
            raise FileNotFoundError(f"{self.path(name)} has no complete version")
        return df


def contracts(settings: Settings) -> tuple[audit.Contract, audit.Contract]:
    """What the settings expect of the beneficiary and the inpatient extract."""
    dates = [raw_columns(spec, "date") for spec in (BENEFICIARY_COLUMNS, CLAIM_COLUMNS)]
    amounts = [raw_columns(spec, "decimal") for spec in (BENEFICIARY_COLUMNS, CLAIM_COLUMNS)]
    bene = audit.Contract(
        "beneficiaries", "DESYNPUF_ID", [*dates[0], *BENEFICIARY_INTS, *amounts[0]], settings.critical_beneficiaries,
        {}, quality.beneficiary_rules(), audit.contract_ranges(settings.ranges, BENEFICIARY_COLUMNS), amounts[0],
    )
    claims = audit.Contract(
        "inpatient", "CLM_ID", [*dates[1], *CLAIM_INTS, *amounts[1]], settings.critical_inpatient,
        settings.null_thresholds, quality.inpatient_rules(), audit.contract_ranges(settings.ranges, CLAIM_COLUMNS), amounts[1],
    )
    return bene, claims


def stage(directory: str, warehouse: Warehouse, settings: Settings) -> tuple[ClaimsExtract, DataFrame]:
    """Parse the raw files once: typed tables as a checkpoint, and the checks of that pass.

    Validation and loading read the checkpoint. The checks cover all rows of the files, also
    those that repeat a key, of which the extract keeps the first.
    """
    spark = warehouse.spark
    raw = extracts.read_raw_extracts(spark, directory)
    typed, checks = [], []
    for rows, convert, contract in zip(raw, (extracts.type_beneficiaries, extracts.type_inpatient), contracts(settings)):
        table, found = audit.write_audited(rows, convert, contract, warehouse.path(f"staging/{contract.table}"))
        typed.append(table)
        checks += found + audit.key_checks(table, contract)
    checks += audit.reference_checks(typed[1], typed[0], "DESYNPUF_ID", "inpatient", "beneficiaries")
    return extracts.first_of_each(*typed), audit.checks_table(spark, checks)


def validate(extract: ClaimsExtract, settings: Settings, report_path: str, checks: DataFrame | None = None) -> bool:
    """Abort on nulls in critical columns; write the report; True when all tables pass.

    ``checks`` of ``stage`` are part of the report: what was counted, in per cent, and
    against which limit.
    """
    bene, claims = extract.beneficiaries, extract.inpatient
    quality.check_critical(bene, settings.critical_beneficiaries, "beneficiaries")
    quality.check_critical(claims, settings.critical_inpatient, "inpatient")
    bene_rules, claim_rules = quality.beneficiary_rules(), quality.inpatient_rules()
    limits = settings.null_thresholds
    summary = quality.table_summary(
        bene, bene_rules, quality.BENEFICIARY_TYPES, limits, "DESYNPUF_ID", "beneficiaries"
    ).unionByName(
        quality.table_summary(claims, claim_rules, quality.INPATIENT_TYPES, limits, "CLM_ID", "inpatient")
    )
    failures = quality.failure_cases(bene, bene_rules, "DESYNPUF_ID", "beneficiaries").unionByName(
        quality.failure_cases(claims, claim_rules, "CLM_ID", "inpatient")
    )
    if checks is not None:
        write_json(checks, f"{report_path}/checks")
    return quality.write_validation_report(summary, failures, report_path)


def load(extract: ClaimsExtract, warehouse: Warehouse) -> None:
    """Normalise and append rows whose key is new; loading a batch twice changes nothing."""
    bene, claims = extract.beneficiaries, extract.inpatient
    tables = (
        ("claims/beneficiaries", with_all_columns(normalize_beneficiaries(bene), BENEFICIARY_COLUMNS), ["bene_id"], "birth_dt"),
        ("claims/chronic_conditions", long_conditions(bene), ["bene_id", "condition_code"], "indicator"),
        ("claims/inpatient_claims", with_all_columns(normalize_claims(claims), CLAIM_COLUMNS), ["claim_id"], "admit_dt"),
        ("claims/diagnosis_codes", long_diagnoses(claims), ["claim_id", "seq_num"], "icd9_code"),
        ("claims/procedure_codes", long_procedures(claims), ["claim_id", "seq_num"], "icd9_prcdr_code"),
    )
    for name, rows, keys, order in tables:
        store.append_new(rows, warehouse.path(name), keys, [F.col(order)])


def refresh_features(warehouse: Warehouse) -> DataFrame:
    """Recompute the feature view and publish it as a new version."""
    view = history.patient_features(
        warehouse.read("claims/inpatient_claims"),
        warehouse.read("claims/beneficiaries"),
        warehouse.read("claims/chronic_conditions"),
        keep_next_admit=True,
        condition_flags=True,
    )
    store.publish(view, warehouse.path("analytics/patient_features"))
    return warehouse.current("analytics/patient_features")


def build_model_rows(
    warehouse: Warehouse, settings: Settings, fit_on_train: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows with features, encoded DRG and targets, published as one table.

    The high-cost threshold is taken from all rows, or with ``fit_on_train`` from the
    rows before the split date only.
    """
    view = warehouse.current("analytics/patient_features")
    before, _ = labels.split_by_date(view, settings.split_date)
    limit = labels.fit_high_cost_threshold(before if fit_on_train else view, settings.high_cost_percentile)
    rows = fx.with_high_weight_flag(fx.with_row_features(view, settings.age_bins, settings.age_labels))
    rows = labels.with_labels(rows, limit, settings.readmission_window_days)
    train, _ = labels.split_by_date(rows, settings.split_date)
    encoding = labels.fit_target_encoding(
        train, smoothing=settings.encoder_smoothing, min_samples=settings.encoder_min_samples
    )
    kept = [*fx.ID_COLUMNS, *fx.FEATURE_COLUMNS, fx.TARGET, fx.LOS_TARGET, fx.HIGH_COST_TARGET]
    encoded = encoding.apply(rows, "drg_cd_encoded").select(*[c for c in kept if c in [*rows.columns, "drg_cd_encoded"]])
    store.publish(encoded, warehouse.path("analytics/model_rows"))
    return labels.split_by_date(warehouse.current("analytics/model_rows"), settings.split_date)


def train(
    warehouse: Warehouse,
    settings: Settings,
    version: str,
    search: bool = False,
    tree_params: dict | None = None,
    leafwise_params: dict | None = None,
    los_params: dict | None = None,
    cost_params: dict | None = None,
) -> training.TrainingResult:
    """Fit and save all models of a version, with their metrics and the score baseline."""
    rows = warehouse.current("analytics/model_rows")
    train_rows, test_rows = labels.split_by_date(rows, settings.split_date)
    root, seed = warehouse.path("models"), settings.random_state
    base = f"{root}/v{version}"
    los, los_metrics, _ = training.train_los(train_rows, test_rows, seed, los_params)
    los.write().overwrite().save(f"{base}/los")
    store.write_json(los_metrics, f"{base}/los_metrics")
    cost, cost_metrics, _ = training.train_high_cost(train_rows, test_rows, seed, cost_params)
    cost.write().overwrite().save(f"{base}/high_cost")
    store.write_json(cost_metrics, f"{base}/high_cost_metrics")
    result = training.train_readmission(
        train_rows, test_rows, root, version, settings, tree_params, leafwise_params, search
    )
    store.write_json(training.model_card(result.metrics, version, settings.split_date, result.search), f"{base}/model_card")
    baseline = warehouse.spark.createDataFrame(
        [(version, result.baseline["mean_prob"], result.baseline["pct_high_risk"], result.baseline["top_features"])],
        "version string, mean_prob double, pct_high_risk double, top_features array<string>",
    )
    store.write_json(baseline, f"{base}/baseline")
    return result


def score(warehouse: Warehouse, settings: Settings, scored_at: date) -> DataFrame:
    """Score the rows from the split date on with the newest model; upsert and raise alerts."""
    spark = warehouse.spark
    path = training.latest_model_path(spark, warehouse.path("models"))
    model = training.ReadmissionModel.load(spark, path)
    base = spark.read.json(f"{path}/baseline").first()
    rows = warehouse.current("analytics/model_rows")
    train_rows, test_rows = labels.split_by_date(rows, settings.split_date)
    assembled = training.prepare(test_rows, fx.TARGET, "score-rows")
    scored = training.score_assembled(model, assembled, path)
    scored = training.predict_los(GBTRegressionModel.load(f"{path}/los"), scored)
    kept = ["claim_id", "bene_id", fx.TARGET, training.VECTOR, "readmission_prob", "top_features", "los_predicted_days"]
    cost = GBTClassificationModel.load(f"{path}/high_cost")
    costed = cost.transform(scored.select(*kept)).withColumn("high_cost_prob", training.positive("gbt_probability"))
    version = path.rsplit("/v", 1)[-1]
    new = store.materialize(scoring.score_rows(costed, version, F.lit(scored_at), settings), "scores")

    old = store.read_current(spark, warehouse.path("analytics/risk_scores"))
    merged = new if old is None else store.upsert_risk_scores(old, new)
    store.publish(merged, warehouse.path("analytics/risk_scores"))

    baseline = {"mean_prob": base.mean_prob, "pct_high_risk": base.pct_high_risk}
    alerts = drift.drift_alerts(drift.drift_checks(new, baseline, settings), F.lit(scored_at))
    spikes = drift.null_spikes(test_rows, train_rows, list(base.top_features), settings.drift_null_rate_spike)
    alerts = alerts.unionByName(drift.null_spike_alerts(spikes, F.lit(scored_at)))
    store.append_new(alerts, warehouse.path("analytics/pipeline_alerts"), ["alert_id"], [F.col("created_at")])
    return new


def snapshot_kpis(warehouse: Warehouse, settings: Settings, as_of: date, days: int | None = None) -> DataFrame:
    """Upsert the KPI snapshot of ``as_of`` and check freshness before and after.

    ``days`` limits the snapshot to admissions of the last days; None takes all scores.
    """
    root = warehouse.path("analytics/kpi_snapshots")
    alerts_root = warehouse.path("analytics/pipeline_alerts")
    if store.path_exists(warehouse.spark, root):
        raise_if_stale(kpi_store.written_kpis(warehouse.spark, root), alerts_root, as_of, settings)
    rows = kpi.kpi_input(
        warehouse.current("analytics/risk_scores"),
        warehouse.read("claims/inpatient_claims"),
        warehouse.current("analytics/patient_features"),
    )
    if days is not None:
        rows = kpi.lookback(rows, as_of, days)
    written = kpi_store.write_kpis(kpi.kpi_snapshot(rows, F.lit(as_of), settings.national_avg_los_days), root)
    raise_if_stale(kpi_store.written_kpis(warehouse.spark, root), alerts_root, as_of, settings)
    return written


def raise_if_stale(kpis: DataFrame, alerts_root: str, as_of: date, settings: Settings = Settings()) -> None:
    """Append a ``stale_kpi`` alert when the newest snapshot is too old (once per day).

    Only the newest date counts, so the rows need not be merged by key.
    """
    new = drift.freshness_alerts(kpis, as_of, F.lit(as_of), settings.freshness_alert_hours)
    if new.take(1):  # at most one row; without it no file is written
        store.append_new(new, alerts_root, ["alert_id"], [F.col("created_at")])


def weekly_report(warehouse: Warehouse, as_of: date) -> dict[str, DataFrame]:
    """The datasets of the weekly report."""
    scores = warehouse.current("analytics/risk_scores")
    features = warehouse.current("analytics/patient_features")
    kpis = kpi_store.read_kpis(warehouse.spark, warehouse.path("analytics/kpi_snapshots"))
    path = training.latest_model_path(warehouse.spark, warehouse.path("models"))
    columns = report.report_header(F.lit(as_of), F.lit(as_of), path.rsplit("/v", 1)[-1])
    return {
        "header": warehouse.spark.range(1).select(*columns),
        "kpis": report.kpi_status(kpi.latest_overall(kpis)),
        "providers": report.provider_table(scores, features),
        "tier_chart": report.tier_chart_data(scores, features),
        "alerts": report.open_alerts(warehouse.read("analytics/pipeline_alerts")),
        "trend": report.metric_trend(kpis),
    }
