import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.features import HIGH_COST_TARGET, LOS_TARGET, TARGET
from wardline.operators import explain, store, training

SETTINGS = Settings(n_cv_folds=2, n_trials=2, max_depth=(2, 3), n_estimators=(3, 6), num_leaves=(3, 6), leafwise_n_estimators=(2, 4))
TREES, LEAFWISE = {"maxIter": 8, "maxDepth": 3}, {"maxIter": 10, "numLeaves": 6, "stepSize": 0.2}


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        routine, prior, age = rng.random() < 0.6, rng.randint(0, 5), rng.randint(60, 95)
        p = 0.06 + 0.4 * (not routine) + 0.07 * prior
        los = 1 + prior + rng.randint(0, 3)
        cost = los > 5
        out.append(
            (f"{seed}-{i}", "b", age, int(not routine), prior, float(los), rng.randint(0, 11), int(rng.random() < p), float(np.log1p(los)), int(cost))
        )
    return out


DDL = (
    "claim_id string, bene_id string, age_at_admit int, is_not_routine_discharge int, prior_admits_90d_capped int, "
    f"log_claim_pmt double, elixhauser_count int, {TARGET} int, {LOS_TARGET} double, {HIGH_COST_TARGET} int"
)


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(rows(1500, 1), DDL), spark.createDataFrame(rows(800, 2), DDL)


@pytest.fixture(scope="module")
def result(spark, sides, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("models"))
    return training.train_readmission(*sides, root, "20090701_0000", SETTINGS, TREES, LEAFWISE), root


def test_ladder_learns_the_planted_signal(result):
    found = {r.model: r for r in result[0].metrics.collect()}
    assert set(found) == {
        "logistic_regression_baseline", "boosted_trees", "leafwise_trees", "ensemble_uncalibrated", "ensemble_calibrated",
    }
    assert all(r.auroc > 0.65 and r.n_samples == 800 for r in found.values())
    assert found["ensemble_calibrated"].brier_score < found["ensemble_uncalibrated"].brier_score
    assert "is_not_routine_discharge" in result[0].baseline["top_features"]


def test_saved_model_scores_the_same(spark, sides, result):
    trained, root = result
    path = training.latest_model_path(spark, root)
    assert path.endswith("v20090701_0000")
    loaded = training.ReadmissionModel.load(spark, path)
    rows_ = training.prepare(sides[1], TARGET, "t")
    a = {r.claim_id: r.readmission_prob for r in trained.model.score(rows_).collect()}
    scored = training.score_assembled(loaded, rows_, path)
    b = {r.claim_id: r.readmission_prob for r in scored.collect()}
    assert a == b and all(0 <= p <= 1 for p in a.values())
    assert all(len(set(r.top_features)) == 3 for r in scored.select("top_features").collect())
    with pytest.raises(FileNotFoundError):
        training.latest_model_path(spark, root + "/none")


def test_top_names_and_sample(spark):
    df = spark.createDataFrame([(1.0, -3.0, 3.0, 0.0)], "a double, b double, c double, d double")
    parts = explain.linear_attributions({"a": 1, "b": 1, "c": 1, "d": 1}, {n: 0.0 for n in "abcd"})
    assert df.select(explain.top_names(parts)).first()[0] == ["b", "c", "a"]
    ids = spark.range(50).withColumnRenamed("id", "claim_id")
    one, two = (explain.attribution_sample(x, rows=9).collect() for x in (ids, ids.repartition(7)))
    assert one == two and len(one) == 9


def test_isotonic_is_monotone_and_clips(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(s / 100, int(rng.random() < s / 100)) for s in range(20, 80) for _ in range(5)], "score double, y int")
    model = training.fit_isotonic(df, "y", "score")
    grid = spark.createDataFrame([(x / 50,) for x in range(51)], "score double")
    found = [r.calibrated for r in model.transform(grid).orderBy("score").collect()]
    assert found == sorted(found) and found[0] == found[10] and found[-1] == found[40]


def test_search_of_both_voters(sides):
    fit_rows = training.with_class_weight(training.prepare(sides[0], TARGET, "t"), TARGET)
    first, second = training.search_params(fit_rows, SETTINGS)
    assert first.score > 0.6 and second.score > 0.6
    assert 2 <= first.best["maxDepth"] <= 3 and 0.01 <= first.best["stepSize"] <= 0.3
    assert 3 <= second.best["numLeaves"] <= 6 and 2 <= second.best["maxIter"] <= 4
    assert first.card()["trials_asked"] == first.card()["trials_run"] == 2


def test_stay_and_cost_models(sides):
    model, row, scored = training.train_los(*sides, 42, {"maxIter": 30, "maxDepth": 3, "stepSize": 0.2})
    assert model.getNumTrees > 1 and row.first().mae_days < 1.5
    assert scored.where("los_predicted_days < 0").count() == 0
    _, row, _ = training.train_high_cost(*sides, 42, {"maxIter": 5, "maxDepth": 3})
    assert row.first().auroc > 0.9


def test_matrix_is_written_once_with_a_folder_for_each_side(spark, sides):
    day = F.make_date(F.lit(1998), F.lit(1) + F.col("elixhauser_count") % 12, F.lit(1))
    known = sides[0].withColumn("admit_dt", F.when(F.col("elixhauser_count") != 3, day))
    spread = known.unionByName(known.limit(5))  # keys may repeat
    root = f"{store.workspace(spark)}/wardline"
    before = set(store.list_names(spark, root))
    train, test = training.prepare_sides(spread, TARGET, date(1998, 6, 1), "sides")
    (written,) = set(store.list_names(spark, root)) - before
    assert written.startswith("sides-")
    whole = training.prepare(spread, TARGET, "whole")
    for side, wanted in ((train, "admit_dt < '1998-06-01'"), (test, "admit_dt >= '1998-06-01'")):
        assert side.schema == whole.schema
        assert sorted(map(str, side.collect())) == sorted(map(str, whole.where(wanted).collect()))
    folders = [{r.f.rsplit("/", 1)[0] for r in side.select(F.input_file_name().alias("f")).collect()} for side in (train, test)]
    assert len(folders[0]) == len(folders[1]) == 1 and folders[0] != folders[1]
    train, test = training.prepare_sides(spread, TARGET, date(1990, 1, 1), "sides")
    assert train.count() == 0 and test.count() == spread.where("admit_dt IS NOT NULL").count()


def test_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(sides):
    fit_rows = training.with_class_weight(training.prepare(sides[0], TARGET, "t"), TARGET)
    learner = training.random_forest(params={"numTrees": 12})
    assert learner.getCacheNodeIds()
    kept, walked = (f.fit(fit_rows) for f in (learner, learner.copy().setCacheNodeIds(False)))
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in walked.trees]
