import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators import metrics, ordering, training


def frame(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], "y int, p double")


def brute(pairs):
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, best = 0.0, (0.2, 0.0)
    tp = fp = 0
    for t in sorted({p for _, p in pairs}, reverse=True):
        here = [y for y, p in pairs if p == t]
        tp, fp = tp + sum(here), fp + len(here) - sum(here)
        ap += sum(here) / len(pos) * tp / (tp + fp)
        gap = round(abs(1 - fp / len(neg) - 0.8), 12)
        if gap < best[0]:
            best = (gap, tp / len(pos))
    edges = [i * 0.1 for i in range(11)]
    ece = 0.0
    for lo, hi in zip(edges[:-1], edges[1:]):
        inside = [(y, p) for y, p in pairs if lo <= p < hi]
        if inside:
            ece += len(inside) / len(pairs) * abs(np.mean([y for y, _ in inside]) - np.mean([p for _, p in inside]))
    return auc, ap, best[1], ece, np.mean([(p - y) ** 2 for y, p in pairs])


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_against_brute_force(spark, digits):
    rng = random.Random(digits)
    pairs = []
    for _ in range(400):
        y = rng.random() < 0.3
        pairs.append((y, min(1.0, round(0.3 * y + 0.75 * rng.random(), digits))))
    df = frame(spark, pairs)
    auc, ap, sens, ece, brier = brute(pairs)
    row = metrics.ranking_metrics(df, "y", "p").first()
    assert (row.auroc, row.average_precision, row.sens_at_spec) == pytest.approx((auc, ap, sens))
    assert metrics.expected_calibration_error(df, "y", "p").first()[0] == pytest.approx(ece)
    assert metrics.brier(df, "y", "p").first()[0] == pytest.approx(brier)
    full = metrics.evaluate(df, "y", "p", "m").first()
    assert full.n_samples == 400 and full.auroc == round(auc, 4) and full.brier_score == pytest.approx(brier, abs=1e-4)
    assert full.expected_calibration_error == pytest.approx(ece, abs=1e-4)
    curve = metrics.roc_curve(df, "y", "p")
    assert curve.count() == len({p for _, p in pairs}) + 1
    assert curve.agg(F.max("tpr"), F.max("fpr")).first() == (1.0, 1.0)


def test_perfect_ranking_and_certain_scores(spark):
    df = frame(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 1.0)])
    assert metrics.auroc(df, "y", "p").first()[0] == 1.0
    # The score 1.0 is in no bin but counts in the total.
    assert metrics.expected_calibration_error(df, "y", "p").first()[0] == pytest.approx((0.1 + 0.2 + 0.2) / 4)
    table = {r.bin: r.n for r in metrics.calibration_table(df, "y", "p").collect()}
    assert table == {0: 1, 1: 1, 7: 1, 9: 1}


def test_one_class_has_no_auroc(spark):
    assert metrics.auroc(frame(spark, [(1, 0.2), (1, 0.4)]), "y", "p").first()[0] is None


def test_regression(spark):
    rng = random.Random(3)
    y, f = [rng.randint(0, 9) for _ in range(50)], [rng.uniform(0, 9) for _ in range(50)]
    df = spark.createDataFrame(list(zip(map(float, y), f)), "y double, f double").select(F.log1p("y").alias("y"), F.log1p("f").alias("f"))
    row = metrics.regression_metrics(df, "y", "f", "m").first()
    e = np.array(y) - np.array(f)
    assert row.mae_days == pytest.approx(np.abs(e).mean(), abs=1e-3)
    assert row.rmse_days == pytest.approx(np.sqrt((e**2).mean()), abs=1e-3)
    assert row.r2 == pytest.approx(1 - (e**2).sum() / ((np.array(y) - np.mean(y)) ** 2).sum(), abs=1e-4)


@pytest.mark.parametrize("ascending", [True, False])
def test_running_totals_do_not_depend_on_buckets(spark, ascending):
    rng = random.Random(5)
    values = [round(rng.random() ** 8, 6) for _ in range(3000)]  # crowded near zero
    df = spark.createDataFrame([(v, i % 3 + 1) for i, v in enumerate(sorted(set(values)))], "k double, n int")
    expected, total = {}, 0
    for k, n in sorted(((r.k, r.n) for r in df.collect()), reverse=not ascending):
        total += n
        expected[k] = total
    for buckets in (1, 7, 200):
        found = {r.k: r.run_n for r in ordering.running_totals(df, "k", ["n"], ascending, buckets).collect()}
        assert found == expected


@pytest.mark.parametrize("q", [0.0, 0.25, 0.8, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(9)
    values = [rng.choice([10.0, rng.uniform(0, 100)]) for _ in range(5000)]  # half of them equal
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    assert ordering.exact_quantile(df, "v", q) == pytest.approx(float(np.quantile(values, q)), abs=1e-9)


def test_stratified_rank_is_a_permutation(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("s"))
    ranked = ordering.stratified_rank(df, "s", "k", 1)
    for s, n in ((0, 2700), (1, 300)):
        rows = ranked.where(F.col("s") == s)
        assert sorted(r.stratum_rank for r in rows.collect()) == list(range(1, n + 1))
        assert rows.select("stratum_size").distinct().collect()[0][0] == n


def test_soft_vote(spark):
    df = spark.createDataFrame([(0.8, 0.4), (1.0, 0.0)], "a double, b double")
    found = [r[0] for r in df.select(training.soft_vote(F.col("a"), F.col("b"))).collect()]
    assert found == pytest.approx([0.6, 0.5])
    weighted = df.select(training.soft_vote(F.col("a"), F.col("b"), (0.3, 0.7))).collect()[1][0]
    assert weighted == pytest.approx(0.3)
    assert [r[0] for r in df.select(training.vote_class(F.col("a") - 0.3)).collect()] == [1, 1]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 137, 999, 1500])
@pytest.mark.parametrize("ties", [False, True])
def test_exact_quantile_at_every_size(spark, n, ties):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 5, n).astype(float) if ties else rng.uniform(0, 1000, n)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    for q in (0.0, 0.8, 1.0):
        expected = pytest.approx(float(np.quantile(values, q)), abs=1e-9) if n else None
        assert ordering.exact_quantile(df, "v", q) == expected
