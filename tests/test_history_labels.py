from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import data
from wardline.functions import features as fx
from wardline.operators import history, labels
from wardline.operators.normalize import (
    long_conditions,
    normalize_beneficiaries,
    normalize_claims,
    with_all_columns,
)
from wardline.sources.columns import BENEFICIARY_COLUMNS, CLAIM_COLUMNS
from wardline.sources.extracts import type_beneficiaries, type_inpatient


@pytest.fixture(scope="module")
def tables(spark):
    text = lambda rows: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in rows[0]))
    bene = type_beneficiaries(text(data.beneficiaries()))
    claims = with_all_columns(normalize_claims(type_inpatient(text(data.inpatient()))), CLAIM_COLUMNS).cache()
    return claims, with_all_columns(normalize_beneficiaries(bene), BENEFICIARY_COLUMNS), long_conditions(bene)


def test_feature_view_against_brute_force(tables):
    claims, bene, cond = tables
    view = history.patient_features(claims, bene, cond, keep_next_admit=True, condition_flags=True)
    rows = claims.collect()
    patients = {r.bene_id: r for r in bene.collect()}
    conditions = {}
    for r in cond.collect():
        conditions.setdefault(r.bene_id, set()).add(r.condition_code)
    found = {r.claim_id: r for r in view.collect()}
    assert len(found) == len(rows)
    by_patient = {}
    for r in rows:
        by_patient.setdefault(r.bene_id, []).append(r)
    for r in rows:
        f, p = found[r.claim_id], patients[r.bene_id]
        earlier = [o.admit_dt for o in by_patient[r.bene_id] if o.admit_dt < r.admit_dt]
        assert f.prior_admits_90d == sum((r.admit_dt - d).days <= 90 for d in earlier)
        assert f.prior_admits_365d == sum((r.admit_dt - d).days <= 365 for d in earlier)
        assert f.days_since_last_admit == ((r.admit_dt - max(earlier)).days if earlier else None)
        later = sorted((o.admit_dt, o.claim_id) for o in by_patient[r.bene_id])
        after = [d for d, c in later if (d, c) > (r.admit_dt, r.claim_id)]
        assert f.next_admit_dt == (after[0] if after else None)
        assert f.elixhauser_count == len(conditions.get(r.bene_id, ()))
        assert f.cond_chf == int("chf" in conditions.get(r.bene_id, ()))
        dead = p.death_dt and r.discharge_dt and p.death_dt <= r.discharge_dt + timedelta(days=30)
        assert f.died_within_30d == int(bool(dead))
        born = p.birth_dt
        years = r.admit_dt.year - born.year - ((r.admit_dt.month, r.admit_dt.day) < (born.month, born.day))
        assert f.age_at_admit == years


def test_leap_day_age(spark):
    df = spark.createDataFrame([(date(1940, 2, 29), date(2007, 2, 28)), (date(1940, 2, 29), date(2007, 3, 1))], "b date, a date")
    assert [r[0] for r in df.select(history.age_in_years(F.col("b"), F.col("a"))).collect()] == [66, 67]


def claim_rows(spark, rows):
    return spark.createDataFrame(rows, "claim_id string, bene_id string, admit_dt date, discharge_dt date")


def test_readmission_golden(spark):
    rows = [
        ("1", "P001", date(2008, 1, 1), date(2008, 1, 5)),
        ("2", "P001", date(2008, 1, 20), date(2008, 1, 22)),
        ("3", "P002", date(2008, 3, 1), date(2008, 3, 4)),
    ]
    found = {r.claim_id: r.readmitted_30d for r in labels.readmission_labels(claim_rows(spark, rows)).collect()}
    assert found == {"1": 1, "2": 0, "3": 0}


def test_readmission_edges(spark):
    base = date(2008, 1, 1)
    rows = []
    for gap in (0, 1, 30, 31, -2):
        rows.append((f"g{gap}a", f"p{gap}", base, base + timedelta(days=5)))
        rows.append((f"g{gap}b", f"p{gap}", base + timedelta(days=5 + gap), None))
    rows += [
        ("t1", "tie", base, base + timedelta(days=1)),
        ("t2", "tie", base, base + timedelta(days=1)),
        ("t3", "tie", base + timedelta(days=3), base + timedelta(days=4)),
        ("n1", "nul", None, base),
        ("n2", "nul", base, base + timedelta(days=1)),
    ]
    found = {r.claim_id: r.readmitted_30d for r in labels.readmission_labels(claim_rows(spark, rows)).collect()}
    assert len(found) == len(rows)
    first = {g: found[f"g{g}a"] for g in (0, 1, 30, 31, -2)}
    assert first == {0: 0, 1: 1, 30: 1, 31: 0, -2: 0}
    assert (found["t1"], found["t2"], found["t3"]) == (0, 1, 0)
    assert found["g1b"] == 0 and found["n1"] == 0 and found["n2"] == 0


def test_row_features(spark):
    rows = [
        (1, 17, 2, 1, 0.0, 5.0, 0, 0, 70), (2, 120, 1, None, 100.0, 5.0, 12, 25, None),
        (3, 85, None, 99, None, None, 3, 3, -1), (4, None, 2, 20, 10.0, None, 1, 2, 60),
    ]
    df = spark.createDataFrame(
        rows,
        "id int, age_at_admit int, sex_cd int, discharge_status_cd int, claim_pmt_amt double, pass_thru_amt double, "
        "prior_admits_90d int, prior_admits_365d int, los_days int",
    ).withColumn("admit_dt", F.lit("2024-01-01").cast("date"))
    found = {r.id: r for r in fx.with_row_features(df).collect()}
    assert [(found[i].age_group, found[i].age_group_ord) for i in (1, 2, 3, 4)] == [("<18", 0), (None, -1), ("85+", 6), (None, -1)]
    assert [found[i].is_female for i in (1, 2, 3, 4)] == [1, 0, 0, 1]
    assert [found[i].is_not_routine_discharge for i in (1, 2, 3, 4)] == [0, 0, 1, 1]
    assert [found[i].discharge_risk_score for i in (1, 2, 3, 4)] == [0, 0, 2, 4]
    assert [found[i].pass_thru_ratio for i in (1, 2, 3, 4)] == [0.0, 0.05, 0.0, 0.0]
    assert [found[i].los_days_capped for i in (1, 2, 3, 4)] == [60, 0, -1, 60]
    assert (found[2].prior_admits_90d_capped, found[2].prior_admits_365d_capped, found[2].is_frequent_flyer) == (10, 20, 1)
    assert (found[1].admit_month, found[1].admit_quarter, found[1].admit_dow) == (1, 1, 0)
    assert abs(found[1].admit_month_sin**2 + found[1].admit_month_cos**2 - 1) < 1e-12
    matrix = fx.model_matrix(fx.with_row_features(df)).where("id = 2").first()
    assert matrix.discharge_status_cd == -1.0


def test_target_encoding_of_any_type_and_number(spark):
    texts = [("A", 1)] * 30 + [("B", 0)] * 30 + [(str(k), k % 2) for k in range(70_000)]
    encoding = labels.fit_target_encoding(spark.createDataFrame(texts, "c string, readmitted_30d int"), "c")
    asked = spark.createDataFrame([("A",), ("B",), ("69999",), ("new",)], "c string")
    found = {r.c: r.e for r in encoding.apply(asked, "e").collect()}
    assert found["A"] > found["69999"] > found["new"] > found["B"] and encoding.codes.count() == 70_002


def test_target_encoding(spark):
    rows = [(1, 1)] * 30 + [(1, 0)] * 10 + [(2, 1)] * 2 + [(None, 0)] * 8
    train = spark.createDataFrame(rows, "drg_cd int, readmitted_30d int")
    encoding = labels.fit_target_encoding(train)
    asked = spark.createDataFrame([(1,), (2,), (3,), (None,), (70000,)], "drg_cd int")
    found = {r.drg_cd: r.e for r in encoding.apply(asked, "e").collect()}
    prior = 32 / 50

    def blend(n, mean):
        w = 1 / (1 + np.exp(-(n - 20) / 10))
        return w * mean + (1 - w) * prior

    assert found[1] == pytest.approx(blend(40, 0.75)) and found[2] == pytest.approx(blend(2, 1.0))
    assert found[3] == found[None] == found[70000] == pytest.approx(prior)


def test_stratified_parts(spark):
    df = spark.range(1000).select(
        F.col("id").alias("claim_id"), F.when(F.col("id") < 930, 0).otherwise(1).alias("readmitted_30d")
    )
    held = labels.stratified_holdout(df)
    counts = {r.readmitted_30d: r.n for r in held.where("is_holdout = 1").groupBy("readmitted_30d").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 186, 1: 14} and held.count() == 1000
    folds = {(r.readmitted_30d, r.fold): r.n for r in labels.stratified_folds(df, 5).groupBy("readmitted_30d", "fold").agg(F.count("*").alias("n")).collect()}
    assert all(folds[(0, k)] == 186 and folds[(1, k)] == 14 for k in range(5))
    assert sorted(held.where("is_holdout = 1").collect()) == sorted(labels.stratified_holdout(df.repartition(3)).where("is_holdout = 1").collect())


def test_high_cost_and_weights(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5]] + [(None,)], "claim_pmt_amt double")
    limit = labels.fit_high_cost_threshold(df, 80)
    assert limit == pytest.approx(np.quantile([1, 2, 3, 4, 5], 0.8))
    flags = [r[0] for r in df.select(labels.high_cost_target(F.col("claim_pmt_amt"), limit)).collect()]
    assert flags == [0, 0, 0, 0, 1, 0]
    assert labels.fit_high_cost_threshold(df.where("claim_pmt_amt is null")) is None
    one_sided = spark.createDataFrame([(0,), (0,)], "readmitted_30d int")
    assert labels.class_weights(one_sided).first().positive_weight == 2.0
