import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.operators import drift, kpi, report, scoring

DAY = date(2009, 7, 1)
DDL = (
    "claim_id string, provider_id string, risk_tier string, readmission_prob double, readmission_label int, "
    "admit_dt date, claim_pmt_amt decimal(12,2), drg_cd int, age_at_admit int, los_days int, elixhauser_count int"
)


def rows(n=200, seed=1):
    from decimal import Decimal

    rng = random.Random(seed)
    return [
        (
            f"c{i}", rng.choice(["P1", "P2", "P3", None]), rng.choices(["high", "medium", "low"], [15, 25, 60])[0],
            rng.random(), rng.choice([0, 1]) if i % 9 else None, DAY - timedelta(days=rng.randrange(90)),
            Decimal(rng.randrange(50000, 900000)) / 100, rng.randint(1, 5), rng.randint(60, 95),
            rng.randint(0, 12) if i % 7 else None, rng.randint(0, 11),
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), DDL)


def test_kpis_against_brute_force(df):
    found = {(r.provider_id, r.metric_name): r.metric_value for r in kpi.kpi_snapshot(df, F.lit(DAY)).collect()}
    every = df.collect()
    for provider in ("P1", "P2", "P3", "ALL"):
        sub = [r for r in every if provider in ("ALL", r.provider_id)]
        los = [r.los_days for r in sub if r.los_days is not None]
        label = [r.readmission_label for r in sub if r.readmission_label is not None]
        expected = {
            "readmission_rate_30d": np.mean(label),
            "high_risk_count": sum(r.risk_tier == "high" for r in sub),
            "high_risk_pct": 100 * np.mean([r.risk_tier == "high" for r in sub]),
            "avg_readmit_prob": np.mean([r.readmission_prob for r in sub]),
            "avg_los_days": np.mean(los),
            "median_los_days": np.median(los),
            "los_vs_national_avg": np.mean(los) - 4.6,
            "avg_cost_per_admission": np.mean([float(r.claim_pmt_amt) for r in sub]),
            "total_cost": sum(float(r.claim_pmt_amt) for r in sub),
            "admission_count": len(sub),
            "avg_elixhauser_score": np.mean([r.elixhauser_count for r in sub]),
            "avg_age_at_admit": np.mean([r.age_at_admit for r in sub]),
        }
        for name, value in expected.items():
            assert found[(provider, name)] == pytest.approx(value), (provider, name)
    assert {p for p, _ in found} == {"P1", "P2", "P3", "ALL"}


def test_kpis_of_empty_and_unlabelled(df):
    assert kpi.kpi_snapshot(df.where(F.lit(False)), F.lit(DAY)).count() == 0
    blank = df.withColumns({"readmission_label": F.lit(None).cast("int"), "los_days": F.lit(None).cast("int")})
    names = {r.metric_name for r in kpi.kpi_snapshot(blank, F.lit(DAY)).collect()}
    assert "high_risk_count" not in names and "median_los_days" not in names and "admission_count" in names


def test_lookback_and_latest(df):
    assert kpi.lookback(df, DAY, 30).agg(F.min("admit_dt")).first()[0] > DAY - timedelta(days=30)
    both = kpi.kpi_snapshot(df, F.lit(DAY)).unionByName(kpi.kpi_snapshot(df, F.lit(DAY - timedelta(days=7))))
    assert kpi.latest_overall(both).count() == 12
    assert kpi.kpi_avg_los_view(both).columns == ["snapshot_date", "provider_id", "avg_los_days"]


def test_drift_alerts(spark):
    scores = spark.createDataFrame([(0.1,), (0.5,)], "readmission_prob double")
    checks = {r.check_name: r for r in drift.drift_checks(scores, {"mean_prob": 0.25, "pct_high_risk": 47.0}).collect()}
    assert checks["mean_prob"].breached and checks["mean_prob"].shift == pytest.approx(0.05)
    assert not checks["pct_high_risk"].breached
    assert checks["mean_prob"].message.startswith("Score drift detected: mean prob shifted 0.0500 (baseline=0.2500")
    assert drift.drift_checks(scores, {}).count() == 0
    partial = drift.drift_checks(scores, {"mean_prob": 0.3})
    assert partial.where("check_name = 'pct_high_risk'").first().shift == 0.0
    alerts = drift.drift_alerts(drift.drift_checks(scores, {"mean_prob": 0.0}), F.lit(DAY))
    row = alerts.first()
    assert (row.alert_type, row.severity, row.resolved) == ("score_drift", "WARNING", False)


def test_null_spike(spark):
    old = spark.createDataFrame([(1, 1), (2, None)], "a int, b int")
    new = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    found = {r.column_name: (r.rise, r.breached) for r in drift.null_spikes(new, old, ["a", "b"]).collect()}
    assert found == {"a": (0.5, True), "b": (0.0, False)}


@pytest.mark.parametrize("age,stale", [(0, 0), (2, 0), (3, 1)])
def test_freshness(spark, age, stale):
    kpis = spark.createDataFrame([(DAY - timedelta(days=age),)], "snapshot_date date")
    assert drift.freshness_alerts(kpis, DAY, F.lit(DAY)).count() == stale
    assert drift.freshness_alerts(kpis.where(F.lit(False)), DAY, F.lit(DAY)).count() == 0


def test_tiers(spark):
    df = spark.createDataFrame([(0.30,), (0.2999,), (0.15,), (0.1499,)], "p double")
    assert [r[0] for r in df.select(scoring.risk_tier(F.col("p"))).collect()] == ["high", "medium", "medium", "low"]
    custom = Settings(tier_high=0.5)
    assert [r[0] for r in df.select(scoring.risk_tier(F.col("p"), custom)).collect()][0] == "medium"


def test_report_tables(spark, df):
    scores, features = df.drop("provider_id", "los_days"), df
    table = report.provider_table(scores, features).collect()
    counts = [r.admission_count for r in table]
    assert counts == sorted(counts, reverse=True) and all(r.provider_id for r in table)
    assert all(abs(r.high_pct + r.medium_pct + r.low_pct - 100) < 1e-9 for r in table)
    alerts = spark.createDataFrame(
        [(f"t{i}", "m", i == 3, date(2009, 1, 1 + i)) for i in range(15)],
        "alert_type string, message string, resolved boolean, created_at date",
    )
    shown = [r.alert_type for r in report.open_alerts(alerts).collect()]
    assert len(shown) == 10 and shown[0] == "t14" and "t3" not in shown
    kpis = spark.createDataFrame(
        [("readmission_rate_30d", 0.2), ("readmission_rate_30d", 0.12), ("high_risk_pct", 31.0), ("los_vs_national_avg", -2.0), ("total_cost", 1.0)],
        "metric_name string, metric_value double",
    )
    assert [r.status for r in report.kpi_status(kpis).collect()] == ["danger", "warn", "warn", "good", "neutral"]
