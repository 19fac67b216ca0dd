from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests import data
from wardline.config import Settings
from wardline.operators import kpi_store, report, store
from wardline.plans import pipeline
from wardline.sources.extracts import load_extracts
from wardline.streaming.kpi_stream import start_kpi_stream

SETTINGS = Settings(split_date=date(2009, 7, 1))
TODAY = date(2011, 1, 3)
SMALL = {"maxIter": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    raw, root = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("warehouse")
    data.write_csv(data.beneficiaries(), raw / "Beneficiary_1.csv")
    data.write_csv(data.inpatient(), raw / "Inpatient_1.csv")
    extract = load_extracts(spark, str(raw))
    house = pipeline.Warehouse(spark, str(root))
    assert pipeline.validate(extract, SETTINGS, house.path("validation"))
    pipeline.load(extract, house)
    pipeline.load(extract, house)  # the same batch again
    return house


def test_pipeline_end_to_end(spark, warehouse, tmp_path):
    assert warehouse.read("claims/inpatient_claims").count() == 900
    assert warehouse.read("claims/beneficiaries").count() == 120
    view = pipeline.refresh_features(warehouse)
    assert view.count() == 900
    train, test = pipeline.build_model_rows(warehouse, SETTINGS)
    assert train.count() + test.count() == 900 and train.agg(F.max("admit_dt")).first()[0] < SETTINGS.split_date
    result = pipeline.train(
        warehouse, SETTINGS, "1", tree_params=SMALL, leafwise_params={"maxIter": 4, "numLeaves": 6}, los_params=SMALL, cost_params=SMALL
    )
    best = {r.model: r.auroc for r in result.metrics.collect()}
    assert best["ensemble_uncalibrated"] > 0.6
    card = spark.read.json(f"{result.path}/model_card").first()
    assert card.version == "1" and len(card.results) == 5
    first = pipeline.score(warehouse, SETTINGS, TODAY)
    assert first.count() == test.count()
    pipeline.score(warehouse, SETTINGS, TODAY + timedelta(days=1))
    scores = warehouse.current("analytics/risk_scores")
    assert scores.count() == test.count()
    row = scores.first()
    assert row.shap_top_feature_1 and row.los_predicted_days is not None and 0 <= row.high_cost_prob <= 1

    kpis = pipeline.snapshot_kpis(warehouse, SETTINGS, TODAY)
    again = pipeline.snapshot_kpis(warehouse, SETTINGS, TODAY)
    assert kpis.count() == again.count() > 12
    pipeline.snapshot_kpis(warehouse, SETTINGS, TODAY + timedelta(days=5))
    stale = warehouse.read("analytics/pipeline_alerts").where("alert_type = 'stale_kpi'")
    assert stale.count() == 1

    pages = pipeline.weekly_report(warehouse, TODAY)
    assert pages["header"].first().model_version == "1"
    assert pages["kpis"].count() == 12 and pages["trend"].count() == 2
    assert pages["providers"].count() <= 20 and pages["tier_chart"].count() <= 10
    report.write_extracts(scores, again, view, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "risk_scores")).count() == test.count()


def test_kpi_stream_upserts_and_alerts(spark, tmp_path):
    ddl = "snapshot_date date, provider_id string, metric_name string, metric_value double"
    source, kpis, alerts = (str(tmp_path / n) for n in ("in", "kpi", "alerts"))
    day = date(2009, 1, 1)
    for value in (1.0, 2.0):
        spark.createDataFrame([(day, "ALL", "m", value)], ddl).write.mode("append").parquet(source)
        stream = start_kpi_stream(
            spark.readStream.schema(ddl).parquet(source), kpis, alerts, str(tmp_path / "cp"), lambda: date(2009, 1, 9)
        )
        stream.awaitTermination(120)
    assert [r.metric_value for r in kpi_store.read_kpis(spark, kpis).collect()] == [2.0]
    assert spark.read.parquet(alerts).count() == 1


def test_workspace_comes_from_the_session(spark):
    assert store.workspace(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
