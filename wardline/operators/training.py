"""Risk models on ``pyspark.ml``: readmission ladder, stay regression, high cost.

The ladder is: standardised logistic regression, gradient-boosted trees, leaf-wise
boosted trees (``operators.boosting``, which Spark lacks), the soft vote of both, and
isotonic calibration of the vote on a stratified hold-out. Matrices are written to the workspace before fitting: learners make many
passes, and a lost executor must not replay the feature pipeline.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressor,
    IsotonicRegression,
    IsotonicRegressionModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import Settings
from wardline.functions.features import (
    FEATURE_COLUMNS,
    HIGH_COST_TARGET,
    LOS_TARGET,
    TARGET,
    model_matrix,
)
from wardline.operators import boosting
from wardline.operators.boosting import LeafwiseModel, LeafwiseTrees
from wardline.operators.drift import score_baseline
from wardline.operators.explain import attribution_sample, global_ranking, top_names
from wardline.operators.labels import (
    stratified_folds,
    stratified_holdout,
    with_class_weight,
)
from wardline.operators.metrics import evaluate, evaluate_models, regression_metrics
from wardline.operators.ordering import seeded_hash
from wardline.operators.search import Bounds, SearchResult, search
from wardline.operators.store import list_names, materialize, materialize_sides, path_exists
from wardline.operators.trees import read_forest, tree_attributions

VECTOR, BLEND, PROB = "features", "blend", "readmission_prob"
LOGISTIC_C, LOGISTIC_ITERATIONS, LOGISTIC_TOLERANCE = 1.0, 500, 1e-4
TREE_DEFAULTS = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8}
FOREST_DEFAULTS = {"numTrees": 100, "maxDepth": 8, "subsamplingRate": 0.8}


def assemble(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Model matrix with the feature vector."""
    kept = [c for c in (names or FEATURE_COLUMNS) if c in df.columns]
    return VectorAssembler(inputCols=kept, outputCol=VECTOR).transform(model_matrix(df, kept))


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in FEATURE_COLUMNS if c in df.columns]


def positive(probability: str) -> Column:
    return vector_to_array(probability)[1]


# --- learners ------------------------------------------------------------------


def fit_logistic(train: DataFrame, label: str = TARGET) -> PipelineModel:
    """L2 logistic regression on standardised features; strength 1 / (C n)."""
    rows = train.count()
    scaler = StandardScaler(inputCol=VECTOR, outputCol="scaled", withMean=True, withStd=True)
    model = LogisticRegression(
        featuresCol="scaled",
        labelCol=label,
        probabilityCol="logistic_probability",
        rawPredictionCol="logistic_raw",
        predictionCol="logistic_class",
        maxIter=LOGISTIC_ITERATIONS,
        tol=LOGISTIC_TOLERANCE,
        regParam=1.0 / (LOGISTIC_C * max(rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
    )
    return Pipeline(stages=[scaler, model]).fit(train)


def boosted_trees(label: str = TARGET, seed: int = 42, params: Mapping | None = None) -> GBTClassifier:
    learner = GBTClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        weightCol="class_weight",
        predictionCol="gbt_class",
        seed=seed,
        **{**TREE_DEFAULTS, **(params or {})},
    )
    return learner.setProbabilityCol("gbt_probability").setRawPredictionCol("gbt_raw")


def random_forest(label: str = TARGET, seed: int = 42, params: Mapping | None = None) -> RandomForestClassifier:
    """Each row's nodes are kept between passes (4 bytes a row and tree): no pass walks all
    trees from their roots. The trees are the same as without."""
    return RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        weightCol="class_weight",
        probabilityCol="forest_probability",
        rawPredictionCol="forest_raw",
        predictionCol="forest_class",
        cacheNodeIds=True,
        seed=seed,
        **{**FOREST_DEFAULTS, **(params or {})},
    )


def fit_isotonic(df: DataFrame, label: str, score: str) -> IsotonicRegressionModel:
    """Isotonic fit on scores grouped first (weight = cases, target = positive share).

    Equal scores are one group; scores are taken as they are. The library pools each
    partition's groups before its last step.
    """
    grouped = df.groupBy(score).agg(
        F.avg(F.col(label).cast("double")).alias("share"), F.count("*").cast("double").alias("cases")
    )
    return IsotonicRegression(
        featuresCol=score, labelCol="share", weightCol="cases", predictionCol="calibrated"
    ).fit(grouped)


# --- search --------------------------------------------------------------------


def tree_space(settings: Settings) -> dict[str, Bounds]:
    """Configured bounds of the gradient-boosted trees."""
    return {
        "maxDepth": Bounds(*settings.max_depth, "int"),
        "stepSize": Bounds(*settings.learning_rate, "log"),
        "maxIter": Bounds(*settings.n_estimators, "int"),
        "subsamplingRate": Bounds(*settings.subsample),
        "featureSubsetStrategy": Bounds(*settings.colsample),
    }


def leafwise_space(settings: Settings) -> dict[str, Bounds]:
    """Configured bounds of the leaf-wise trees."""
    return {
        "numLeaves": Bounds(*settings.num_leaves, "int"),
        "stepSize": Bounds(*settings.leafwise_learning_rate, "log"),
        "maxIter": Bounds(*settings.leafwise_n_estimators, "int"),
        "subsamplingRate": Bounds(*settings.leafwise_subsample),
        "featureShare": Bounds(*settings.leafwise_colsample),
        "alpha": Bounds(*settings.leafwise_alpha),
        "lambda": Bounds(*settings.leafwise_lambda),
    }


def _tree_params(params: Mapping) -> dict:
    """Search values as the library takes them."""
    return {k: f"{v:.4f}" if k == "featureSubsetStrategy" else v for k, v in params.items()}


def guided_search(
    build: Callable[[Mapping], object],
    space: Mapping[str, Bounds],
    raw_score: str,
    train: DataFrame,
    trials: int,
    folds: int = 5,
    seed: int = 42,
    timeout_seconds: float = 3600,
    label: str = TARGET,
) -> SearchResult:
    """Search ``space`` by cross-validated AUROC over stratified folds.

    ``build`` makes a learner from parameters, whose models add the column ``raw_score``.
    """
    folded = materialize(stratified_folds(train, folds, label, seed=seed), "folds")
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw_score, metricName="areaUnderROC")

    def evaluate(params: dict, fold: int) -> float:
        model = build(params).fit(folded.where(F.col("fold") != fold))
        return evaluator.evaluate(model.transform(folded.where(F.col("fold") == fold)))

    return search(space, evaluate, trials, folds, seed, timeout_seconds)


# --- readmission model ---------------------------------------------------------


@dataclass(frozen=True)
class ReadmissionModel:
    """Two voters, their weights and the calibrator."""

    gbt: GBTClassificationModel
    leafwise: LeafwiseModel
    calibrator: IsotonicRegressionModel | None
    weights: tuple[float, float]
    names: tuple[str, ...]

    def blend(self, assembled: DataFrame) -> DataFrame:
        """Add the voters' probabilities and the soft vote."""
        voted = self.leafwise.transform(self.gbt.transform(assembled))
        return voted.withColumns(
            {"gbt_prob": positive("gbt_probability"), "leafwise_prob": F.col(boosting.PROBABILITY)}
        ).withColumn(BLEND, soft_vote(F.col("gbt_prob"), F.col("leafwise_prob"), self.weights))

    def score(self, assembled: DataFrame) -> DataFrame:
        """Blend and calibrate; scores outside the calibrated range take its ends."""
        calibrated = self.calibrator.transform(self.blend(assembled))
        return calibrated.withColumnRenamed("calibrated", PROB)

    def save(self, path: str) -> None:
        """Write the parts; the readable card comes last and marks the model complete."""
        self.gbt.write().overwrite().save(f"{path}/gbt")
        self.leafwise.save(f"{path}/leafwise")
        self.calibrator.write().overwrite().save(f"{path}/calibrator")
        card = {"weights": list(self.weights), "names": list(self.names)}
        spark = SparkSession.getActiveSession()
        row = spark.range(1).select(F.lit(json.dumps(card)).alias("value"))
        row.coalesce(1).write.mode("overwrite").text(f"{path}/card")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ReadmissionModel:
        card = json.loads(spark.read.text(f"{path}/card").first().value)
        return ReadmissionModel(
            GBTClassificationModel.load(f"{path}/gbt"),
            LeafwiseModel.load(spark, f"{path}/leafwise"),
            IsotonicRegressionModel.load(f"{path}/calibrator"),
            tuple(card["weights"]),
            tuple(card["names"]),
        )


def soft_vote(first: Column, second: Column, weights: Sequence[float] = (0.5, 0.5)) -> Column:
    return F.lit(float(weights[0])) * first + F.lit(float(weights[1])) * second


def vote_class(blend: Column) -> Column:
    return (blend >= 0.5).cast("int")


def latest_model_path(spark: SparkSession, root: str) -> str:
    """Newest complete model version under ``root`` (by name)."""
    names = list_names(spark, root)
    complete = sorted(n for n in names if path_exists(spark, f"{root}/{n}/card/_SUCCESS"))
    if not complete:
        raise FileNotFoundError(f"No model version in {root}")
    return f"{root}/{complete[-1]}"


@dataclass(frozen=True)
class TrainingResult:
    model: ReadmissionModel
    metrics: DataFrame
    baseline: dict
    version: str
    path: str
    search: tuple[dict, ...] = ()  # cards of the searches of the two voters


def matrix_rows(df: DataFrame, label: str) -> DataFrame:
    """Assembled matrix with its keys and targets."""
    labelled = df.withColumn(label, F.coalesce(F.col(label), F.lit(0)).cast("double"))
    kept = [c for c in ("claim_id", "bene_id", "admit_dt", "provider_id") if c in df.columns]
    targets = [c for c in (TARGET, LOS_TARGET, HIGH_COST_TARGET) if c in df.columns]
    return assemble(labelled).select(*kept, *targets, VECTOR)


def prepare(df: DataFrame, label: str, name: str) -> DataFrame:
    """Assembled matrix with its keys and targets, written to the workspace."""
    return materialize(matrix_rows(df, label), name)


def prepare_sides(df: DataFrame, label: str, split: date, name: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) matrices of ``prepare``, admitted before the split date and from it on.

    ``df`` is run once and written as the matrix alone, a folder for each side.
    """
    return materialize_sides(matrix_rows(df, label), F.col("admit_dt") >= F.lit(split), name)


def holdout_split(train: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(fit rows with class weights, calibration rows): a stratified 80/20 split, written."""
    rows = prepare(train, TARGET, "train")
    split = materialize(stratified_holdout(rows, TARGET, "claim_id", 0.2, seed), "holdout")
    return with_class_weight(split.where("is_holdout = 0"), TARGET), split.where("is_holdout = 1")


def search_params(fit_rows: DataFrame, settings: Settings) -> tuple[SearchResult, SearchResult]:
    """Guided search of the parameters of both voters."""
    seed = settings.random_state
    learners = (
        (lambda p: boosted_trees(seed=seed, params=_tree_params(p)), tree_space(settings), "gbt_raw"),
        (lambda p: LeafwiseTrees(TARGET, p, seed), leafwise_space(settings), boosting.PROBABILITY),
    )
    first, second = (
        guided_search(*learner, fit_rows, settings.n_trials, settings.n_cv_folds, seed, settings.search_timeout_seconds)
        for learner in learners
    )
    return first, second


def fit_ensemble(
    fit_rows: DataFrame,
    hold_rows: DataFrame,
    names: Sequence[str],
    settings: Settings = Settings(),
    tree_params: Mapping | None = None,
    leafwise_params: Mapping | None = None,
) -> ReadmissionModel:
    """Both voters on the fit rows and the calibrator on the held-out rows."""
    seed = settings.random_state
    gbt = boosted_trees(seed=seed, params=tree_params).fit(fit_rows)
    leafwise = LeafwiseTrees(TARGET, leafwise_params or {}, seed).fit(fit_rows)
    draft = ReadmissionModel(gbt, leafwise, None, settings.ensemble_weights, tuple(names))
    calibrator = fit_isotonic(draft.blend(hold_rows).select(TARGET, BLEND), TARGET, BLEND)
    return replace(draft, calibrator=calibrator)


def train_readmission(
    train: DataFrame,
    test: DataFrame,
    root: str,
    version: str,
    settings: Settings = Settings(),
    tree_params: Mapping | None = None,
    leafwise_params: Mapping | None = None,
    search: bool = False,
) -> TrainingResult:
    """The model ladder: fit, evaluate each step on ``test``, save as ``root/v<version>``.

    With ``search`` both voters' parameters come from guided search. Metrics are
    one row per model; the baseline holds what the drift check compares with.
    """
    names = feature_names(train)
    fit_rows, hold_rows = holdout_split(train, settings.random_state)
    test_rows = prepare(test, TARGET, "test")
    cards: tuple[dict, ...] = ()
    if search:
        found = search_params(fit_rows, settings)
        tree_params, leafwise_params = _tree_params(found[0].best), found[1].best
        cards = tuple({"learner": n, **f.card()} for n, f in zip(("boosted_trees", "leafwise_trees"), found))

    logistic = fit_logistic(fit_rows)
    model = fit_ensemble(fit_rows, hold_rows, names, settings, tree_params, leafwise_params)
    path = f"{root}/v{version}"
    model.save(path)

    scored = logistic.transform(model.score(test_rows)).withColumn("logistic_prob", positive("logistic_probability"))
    kept = ["claim_id", TARGET, VECTOR, "logistic_prob", "gbt_prob", "leafwise_prob", BLEND, PROB]
    scored = materialize(scored.select(*kept), "test-scores")
    steps = {
        "logistic_regression_baseline": "logistic_prob",
        "boosted_trees": "gbt_prob",
        "leafwise_trees": "leafwise_prob",
        "ensemble_uncalibrated": BLEND,
        "ensemble_calibrated": PROB,
    }
    metrics = evaluate_models(scored, TARGET, steps)
    top = [r.feature for r in tree_ranking(scored, model, path, settings.random_state).collect()]
    base = score_baseline(scored, settings.tier_high).first().asDict()
    return TrainingResult(model, metrics, {"version": version, **base, "top_features": top}, version, path, cards)


def tree_ranking(assembled: DataFrame, model: ReadmissionModel, model_path: str, seed: int = 42) -> DataFrame:
    """Top features of the boosted trees by mean absolute attribution over a sample."""
    forest = read_forest(assembled.sparkSession, f"{model_path}/gbt", model.gbt.treeWeights)
    parts = attribution_sample(assembled, seed=seed).withColumn("parts", tree_attributions(assembled, forest, model.names))
    return global_ranking(parts, {n: F.col("parts")[i]["value"] for i, n in enumerate(model.names)})


def model_card(metrics: DataFrame, version: str, split_date: date, searches: Sequence[Mapping] = ()) -> DataFrame:
    """One row that records a model version: what it predicts, how it did, and for each
    search how many trials were asked for, run and given up, and whether time ran out."""
    results = F.sort_array(F.collect_list(F.struct(*metrics.columns))).alias("results")
    return metrics.agg(results).select(
        F.lit(version).alias("version"),
        F.lit("30-day all-cause hospital readmission (binary classification)").alias("task"),
        F.lit("next admission of the same patient 1 to 30 days after discharge").alias("label_definition"),
        F.lit(f"train: admitted before {split_date}, test: admitted from then on").alias("split"),
        F.lit("class weights").alias("class_imbalance_handling"),
        F.lit("isotonic regression on a stratified 20% hold-out").alias("calibration"),
        F.lit(json.dumps(list(searches))).alias("searches"),
        "results",
    )


def score_assembled(model: ReadmissionModel, assembled: DataFrame, model_path: str) -> DataFrame:
    """Calibrated probability and the top-3 features of the boosted-tree voter."""
    forest = read_forest(assembled.sparkSession, f"{model_path}/gbt", model.gbt.treeWeights)
    scored = model.score(assembled)
    return scored.withColumn("top_features", top_names(tree_attributions(scored, forest, model.names)))


# --- length of stay, high cost -------------------------------------------------

LOS_PARAMS = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
LOS_VALIDATION_SHARE = 10  # one row in ten, by key hash
LOS_STOP_TOLERANCE = 1e-4
HIGH_COST_PARAMS = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.05}


def fit_los(train: DataFrame, seed: int = 42, params: Mapping | None = None):
    """Boosted regression of log stay; stops early on a validation part of the training rows."""
    digit = F.conv(F.substring(seeded_hash("claim_id", seed), 1, 4), 16, 10).cast("int")
    marked = train.withColumn("is_validation", digit % LOS_VALIDATION_SHARE == 0)
    return GBTRegressor(
        featuresCol=VECTOR,
        labelCol=LOS_TARGET,
        predictionCol="los_log_prediction",
        validationIndicatorCol="is_validation",
        validationTol=LOS_STOP_TOLERANCE,
        seed=seed,
        **{**LOS_PARAMS, **(params or {})},
    ).fit(marked)


def predict_los(model, assembled: DataFrame) -> DataFrame:
    """Predictions on the log scale and back in days."""
    scored = model.transform(assembled)
    return scored.withColumn("los_predicted_days", F.expm1("los_log_prediction"))


def train_los(train: DataFrame, test: DataFrame, seed: int = 42, params: Mapping | None = None):
    """(model, one metrics row, scored test rows) of the stay regression."""
    return assess_los(prepare(train, LOS_TARGET, "los-train"), prepare(test, LOS_TARGET, "los-test"), seed, params)


def assess_los(fit_rows: DataFrame, test_rows: DataFrame, seed: int = 42, params: Mapping | None = None):
    """``train_los`` on matrices that are written already."""
    model = fit_los(fit_rows, seed, params)
    scored = predict_los(model, test_rows)
    return model, regression_metrics(scored, LOS_TARGET, "los_log_prediction", "los_boosted_trees"), scored


def fit_high_cost(rows: DataFrame, seed: int = 42, params: Mapping | None = None) -> GBTClassificationModel:
    """Boosted classifier of high cost on an assembled matrix, classes weighed."""
    weighed = with_class_weight(rows, HIGH_COST_TARGET)
    return boosted_trees(HIGH_COST_TARGET, seed, {**HIGH_COST_PARAMS, **(params or {})}).fit(weighed)


def train_high_cost(train: DataFrame, test: DataFrame, seed: int = 42, params: Mapping | None = None):
    """(model, one metrics row, scored test rows) of the high-cost classifier."""
    test_rows = prepare(test, HIGH_COST_TARGET, "cost-test")
    return assess_high_cost(prepare(train, HIGH_COST_TARGET, "cost-train"), test_rows, seed, params)


def assess_high_cost(fit_rows: DataFrame, test_rows: DataFrame, seed: int = 42, params: Mapping | None = None):
    """``train_high_cost`` on matrices that are written already."""
    model = fit_high_cost(fit_rows, seed, params)
    scored = model.transform(test_rows).withColumn("high_cost_prob", positive("gbt_probability"))
    scored = materialize(scored.select("claim_id", HIGH_COST_TARGET, "high_cost_prob"), "cost-scores")
    return model, evaluate(scored, HIGH_COST_TARGET, "high_cost_prob", "high_cost_boosted_trees"), scored
