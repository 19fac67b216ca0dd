"""State that batches bring up to date, against computing everything anew."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators import history, kpi, kpi_days, ordering, refresh, store

CLAIMS = (
    "claim_id string, bene_id string, admit_dt date, discharge_dt date, provider_id string, drg_cd int, admit_source_cd int,"
    " admit_type_cd int, discharge_status_cd int, claim_pmt_amt decimal(12,2), pass_thru_amt decimal(12,2), utilization_day_cnt int,"
    " admitting_icd9 string"
)
PATIENTS = "bene_id string, birth_dt date, death_dt date, sex_cd int, race_cd int, hmo_coverage_months int, hi_coverage_months int, medreimb_ip decimal(12,2)"
DAY = date(2009, 1, 1)


def claims(spark, numbers, seed=1):
    rng, rows = random.Random(seed), []
    for k in range(400):
        who = 0 if rng.random() < 0.33 else rng.randrange(30)
        admit = DAY + timedelta(days=rng.randrange(500))
        rows.append((f"c{k}", f"b{who}", admit, admit + timedelta(days=rng.randrange(8)), f"p{k % 4}", 1, 1, 1, 1, None, None, 1, None))
    return spark.createDataFrame([rows[k] for k in numbers], CLAIMS)


def patients(spark, count=28):
    return spark.createDataFrame([(f"b{k}", date(1930, 1, 1 + k % 28), None, 1, 1, 0, 12, None) for k in range(count)], PATIENTS)


def conditions(spark, pairs):
    return spark.createDataFrame(pairs, "bene_id string, condition_code string, indicator int")


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_batches_equal_a_full_recompute(spark, tmp_path):
    order = list(range(400))
    random.Random(3).shuffle(order)  # late claims: batches are not in order of admission
    root, sick = str(tmp_path / "log"), conditions(spark, [("b1", "chf", 1), ("b2", "copd", 2)])
    for stop in (150, 390, 400):
        start = {150: 0, 390: 150, 400: 390}[stop]
        seen = claims(spark, order[:stop])
        view = refresh.refresh((claims(spark, order[start:stop]),), (seen, patients(spark), sick), root)
        whole = history.patient_features(seen, patients(spark), sick, keep_next_admit=True, condition_flags=True)
        assert rows_of(view) == rows_of(whole)
    # Only the touched patients are written: the last batch of ten claims has few of them.
    last = spark.read.parquet(f"{root}/{store.versions(spark, root)[-1]}")
    assert last.select("bene_id").distinct().count() <= 10


def test_changed_conditions_repeats_and_compaction(spark, tmp_path):
    root, seen = str(tmp_path / "log"), claims(spark, range(100))
    none, some = conditions(spark, []), conditions(spark, [("b3", "chf", 1)])
    refresh.refresh((seen,), (seen, patients(spark), none), root)
    view = refresh.refresh((some,), (seen, patients(spark), some), root)
    assert {r.elixhauser_count for r in view.where("bene_id = 'b3'").collect()} == {1}
    again = refresh.refresh((some,), (seen, patients(spark), some), root)
    assert rows_of(again) == rows_of(view)
    packed = refresh.compact(spark, root, str(tmp_path / "packed"))
    assert rows_of(packed) == rows_of(view) and len(store.versions(spark, str(tmp_path / "packed"))) == 1
    # A patient who is no longer known has no rows after a batch that touches them.
    gone = refresh.refresh((some,), (seen, patients(spark, 3), some), root)
    assert rows_of(gone) == rows_of(view.where("bene_id <> 'b3'")) != rows_of(view)
    with pytest.raises(FileNotFoundError):
        refresh.current_view(spark, str(tmp_path / "nothing"))


KPI = (
    "admit_dt date, provider_id string, risk_tier string, readmission_label int, readmission_prob double, claim_pmt_amt double,"
    " elixhauser_count int, age_at_admit int, los_days int"
)


def kpi_rows(spark, count=3000, seed=2):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [
            (
                DAY + timedelta(days=rng.randrange(90)), rng.choice(["p1", "p2", None]), rng.choice(["high", "low"]), rng.choice([0, 1, None]),
                rng.random(), rng.uniform(1, 9), rng.randrange(5), rng.randrange(60, 90), rng.choice([None, *range(60)]),
            )
            for _ in range(count)
        ],
        KPI,
    )


@pytest.mark.parametrize("days", [None, 7, 30])
def test_merged_days_equal_the_claims(spark, days):
    rows, as_of = kpi_rows(spark), DAY + timedelta(days=80)
    state = kpi_days.daily_state(rows)
    found = {r.provider_id: r.asDict() for r in kpi_days.snapshot_from_days(state, as_of, days).collect()}
    chosen = rows.where(F.col("admit_dt") <= F.lit(as_of)) if days is None else kpi.lookback(rows, as_of, days)
    exact = {r.provider_id: r.asDict() for r in kpi.kpi_wide(chosen, F.lit(as_of)).collect()}
    assert set(found) == set(exact) == {"p1", "p2", "ALL"}
    stays = chosen.select("provider_id", "los_days").where("los_days is not null").collect()
    for name in exact:
        for metric in kpi.METRICS:
            if metric != "median_los_days":
                assert found[name][metric] == pytest.approx(exact[name][metric], rel=1e-9), metric
        values = np.sort([r.los_days for r in stays if name in ("ALL", r.provider_id)])
        below, upto = (values < found[name]["median_los_days"]).mean(), (values <= found[name]["median_los_days"]).mean()
        assert below - kpi_days.RANK_ERROR <= 0.5 <= upto + kpi_days.RANK_ERROR


def test_lookback_reads_the_state_only(spark, tmp_path):
    rows, root = kpi_rows(spark), str(tmp_path / "days")
    state = kpi_days.publish_days(rows, root)
    plan = kpi_days.snapshot_from_days(state, DAY + timedelta(days=80), 30)._jdf.queryExecution().toString()
    assert "days" in plan and "los_days" not in plan.split("== Physical Plan ==")[1].split("Scan")[-1]
    # A day that comes again with late claims is replaced, other days stay.
    late = kpi_rows(spark, 50, 9).withColumn("admit_dt", F.lit(DAY))
    again = kpi_days.publish_days(late, root)
    assert again.where(F.col("admit_dt") == F.lit(DAY)).agg(F.sum("n")).first()[0] == 50
    assert again.agg(F.sum("n")).first()[0] == 50 + rows.where(F.col("admit_dt") != F.lit(DAY)).count()


def test_no_days(spark):
    empty = kpi_days.daily_state(kpi_rows(spark).limit(0))
    assert kpi_days.snapshot_from_days(empty, DAY).count() == 0


def test_a_large_group_is_bracketed(spark):
    rows = spark.range(60_000).select(F.pmod(F.xxhash64("id"), F.lit(9_973)).cast("double").alias("v"), F.lit(1).alias("k"))
    values = [r.v for r in rows.collect()]
    for fraction in (0.001, 0.5, 0.8, 0.9999):
        assert ordering.grouped_quantile(rows, ["k"], "v", fraction).first().value == pytest.approx(np.quantile(values, fraction))


@pytest.mark.parametrize("fraction", [0.0, 0.37, 0.5, 0.8, 1.0])
def test_grouped_quantiles_are_exact(spark, fraction):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([None, float(rng.randrange(50)), rng.gauss(0, 100)])) for _ in range(4000)]
    rows += [("lone", 1, 7.0), ("null", 1, None), ("same", 2, 3.0), ("same", 2, 3.0)]
    df = spark.createDataFrame(rows, "k string, j int, v double")
    found = {(r.k, r.j): r.value for r in ordering.grouped_quantile(df, ["k", "j"], "v", fraction).collect()}
    groups = {}
    for k, j, v in rows:
        groups.setdefault((k, j), []).extend([] if v is None else [v])
    assert set(found) == set(groups)
    for key, values in groups.items():
        assert found[key] is None if not values else found[key] == pytest.approx(np.quantile(values, fraction))
