"""Pipeline settings: defaults in code, overridable from a YAML file."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from datetime import date

import yaml

# Defaults of the claims pipeline.
CRITICAL_BENEFICIARY = ("DESYNPUF_ID", "BENE_BIRTH_DT")
CRITICAL_INPATIENT = ("DESYNPUF_ID", "CLM_ID", "CLM_ADMSN_DT")
NULL_THRESHOLDS = {"CLM_DSCHRGDT": 0.05, "CLM_PMT_AMT": 0.01, "CLM_DRG_CD": 0.10}
VALUE_RANGES = {
    "CLM_PMT_AMT": (0.0, 10_000_000.0),
    "age_at_admit": (0.0, 120.0),
    "los_days": (0.0, 730.0),
}
AGE_BINS = (0, 18, 35, 50, 65, 75, 85, 120)
AGE_LABELS = ("<18", "18-34", "35-49", "50-64", "65-74", "75-84", "85+")


@dataclass(frozen=True)
class Settings:
    """All tunables. ``yaml`` metadata names the section and key in the file."""

    critical_inpatient: tuple = CRITICAL_INPATIENT
    critical_beneficiaries: tuple = CRITICAL_BENEFICIARY
    null_thresholds: dict = field(default_factory=lambda: dict(NULL_THRESHOLDS))
    ranges: dict = field(default_factory=lambda: dict(VALUE_RANGES))

    split_date: date = date(2009, 7, 1)
    readmission_window_days: int = 30
    prior_admit_windows_days: tuple = (90, 365)
    high_cost_percentile: float = 80
    age_bins: tuple = AGE_BINS
    age_labels: tuple = AGE_LABELS

    random_state: int = 42
    n_cv_folds: int = 5
    n_trials: int = 50
    search_timeout_seconds: float = 3600
    ensemble_weights: tuple = (0.5, 0.5)
    encoder_smoothing: float = 10.0
    encoder_min_samples: int = 20
    max_depth: tuple = (3, 8)
    learning_rate: tuple = (0.01, 0.3)
    n_estimators: tuple = (100, 1000)
    subsample: tuple = (0.6, 1.0)
    colsample: tuple = (0.6, 1.0)
    num_leaves: tuple = (20, 150)
    leafwise_learning_rate: tuple = (0.01, 0.3)
    leafwise_n_estimators: tuple = (100, 1000)
    leafwise_subsample: tuple = (0.6, 1.0)
    leafwise_colsample: tuple = (0.6, 1.0)
    leafwise_alpha: tuple = (0.0, 5.0)
    leafwise_lambda: tuple = (0.0, 5.0)

    drift_mean_prob: float = 0.03
    drift_high_risk_pct: float = 5.0
    drift_null_rate_spike: float = 0.10
    tier_high: float = 0.30
    tier_medium: float = 0.15

    national_avg_los_days: float = 4.6
    snapshot_lookback_days: int = 30
    freshness_alert_hours: int = 48


# Settings field -> (section, key) in the YAML file.
_YAML_KEYS = {
    "null_thresholds": ("validation", "null_thresholds"),
    "ranges": ("validation", "ranges"),
    "split_date": ("features", "temporal_split_date"),
    "readmission_window_days": ("features", "readmission_window_days"),
    "prior_admit_windows_days": ("features", "prior_admit_windows_days"),
    "high_cost_percentile": ("features", "high_cost_percentile"),
    "age_bins": ("features", "age_bins"),
    "age_labels": ("features", "age_labels"),
    "random_state": ("model", "random_state"),
    "n_cv_folds": ("model", "n_cv_folds"),
    "n_trials": ("model", "n_optuna_trials"),
    "search_timeout_seconds": ("model", "optuna_timeout_seconds"),
    "drift_mean_prob": ("scoring", "drift_mean_prob_threshold"),
    "drift_high_risk_pct": ("scoring", "drift_high_risk_pct_threshold"),
    "drift_null_rate_spike": ("scoring", "drift_null_rate_spike"),
    "national_avg_los_days": ("kpi", "national_avg_los_days"),
    "snapshot_lookback_days": ("kpi", "snapshot_lookback_days"),
    "freshness_alert_hours": ("reporting", "freshness_alert_hours"),
}


def settings_from_dict(raw: dict) -> Settings:
    """Overlay a nested config dictionary on the defaults; unknown keys are ignored."""
    values = {}
    for name, (section, key) in _YAML_KEYS.items():
        if key in raw.get(section, {}):
            values[name] = raw[section][key]

    critical = raw.get("validation", {}).get("critical_non_null", {})
    if "inpatient" in critical:
        values["critical_inpatient"] = critical["inpatient"]
    if "beneficiaries" in critical:
        values["critical_beneficiaries"] = critical["beneficiaries"]

    model = raw.get("model", {})
    if "ensemble_weights" in model:
        weights = model["ensemble_weights"]
        values["ensemble_weights"] = weights.values() if isinstance(weights, dict) else weights
    space = model.get("xgb_space", {})
    for name, key in (
        ("max_depth", "max_depth"),
        ("learning_rate", "learning_rate"),
        ("n_estimators", "n_estimators"),
        ("subsample", "subsample"),
        ("colsample", "colsample_bytree"),
    ):
        if key in space:
            values[name] = space[key]
    second = model.get("lgbm_space", {})
    for name, key in (
        ("num_leaves", "num_leaves"),
        ("leafwise_learning_rate", "learning_rate"),
        ("leafwise_n_estimators", "n_estimators"),
        ("leafwise_subsample", "subsample"),
        ("leafwise_colsample", "colsample_bytree"),
        ("leafwise_alpha", "reg_alpha"),
        ("leafwise_lambda", "reg_lambda"),
    ):
        if key in second:
            values[name] = second[key]

    tiers = raw.get("scoring", {}).get("risk_tiers", {})
    if "high" in tiers:
        values["tier_high"] = tiers["high"]
    if "medium" in tiers:
        values["tier_medium"] = tiers["medium"]

    if isinstance(values.get("split_date"), str):
        values["split_date"] = date.fromisoformat(values["split_date"])
    tuples = {f.name for f in fields(Settings) if f.type == "tuple"}
    values = {k: tuple(v) if k in tuples else v for k, v in values.items()}
    return replace(Settings(), **values)


def load_settings(path: str) -> Settings:
    """Read a YAML configuration file (a small driver-side file)."""
    with open(path, encoding="utf-8") as handle:
        return settings_from_dict(yaml.safe_load(handle) or {})
