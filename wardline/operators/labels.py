"""Targets, temporal split, target encoding, hold-outs and folds."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.features import HIGH_COST_TARGET, LOS_TARGET, TARGET
from wardline.operators.history import admission_days, next_admission
from wardline.operators.ordering import exact_quantile, stratified_rank
from wardline.operators.store import materialize


def readmitted(next_admit: Column, discharge: Column, window_days: int = 30) -> Column:
    """1 when the next admission comes 1..window days after discharge, else 0."""
    gap = F.datediff(next_admit, discharge)
    return F.when((gap > 0) & (gap <= window_days), 1).otherwise(0)


def readmission_labels(claims: DataFrame, window_days: int = 30, days: DataFrame | None = None) -> DataFrame:
    """Add ``readmitted_30d`` to claims (every claim keeps its row).

    ``days`` is the ``admission_days`` table when the caller has it already.
    """
    days = admission_days(claims, ()) if days is None else days
    days = days.select("bene_id", "admit_dt", "last_claim", "next_day")
    c, d = claims.alias("c"), days.alias("d")
    same = (F.col("c.bene_id") == F.col("d.bene_id")) & F.col("c.admit_dt").eqNullSafe(F.col("d.admit_dt"))
    joined = c.join(d, same, "left").select("c.*", "d.last_claim", "d.next_day")
    following = next_admission(F.col("last_claim"), F.col("next_day"))
    label = readmitted(following, F.col("discharge_dt"), window_days)
    return joined.withColumn(TARGET, label).drop("last_claim", "next_day")


def readmission_rate(claims: DataFrame, window_days: int = 30, days: DataFrame | None = None) -> DataFrame:
    return readmission_labels(claims, window_days, days).agg(F.avg(TARGET).alias("readmission_rate"))


def los_target(los: Column) -> Column:
    return F.log1p(F.greatest(F.coalesce(los, F.lit(0)), F.lit(0)))


def high_cost_target(amount: Column, threshold: float | None) -> Column:
    limit = F.lit(threshold).cast("double")
    return F.coalesce((amount.cast("double") >= limit).cast("int"), F.lit(0))


def fit_high_cost_threshold(df: DataFrame, percentile: float = 80) -> float | None:
    """Payment at the percentile of the whole table given."""
    return exact_quantile(df, "claim_pmt_amt", percentile / 100)


def with_labels(features: DataFrame, threshold: float | None, window_days: int = 30) -> DataFrame:
    """All targets on a feature view that carries ``next_admit_dt``."""
    return features.withColumns(
        {
            TARGET: readmitted(F.col("next_admit_dt"), F.col("discharge_dt"), window_days),
            LOS_TARGET: los_target(F.col("los_days")),
            HIGH_COST_TARGET: high_cost_target(F.col("claim_pmt_amt"), threshold),
        }
    )


def split_by_date(df: DataFrame, split: date, day: str = "admit_dt") -> tuple[DataFrame, DataFrame]:
    """(train, test): strictly before the split date, and from it on."""
    return df.where(F.col(day) < F.lit(split)), df.where(F.col(day) >= F.lit(split))


def split_summary(df: DataFrame, split: date) -> DataFrame:
    """Rows and positive rate on each side of the split."""
    side = F.when(F.col("admit_dt") < F.lit(split), "train").otherwise("test")
    return (
        df.where(F.col("admit_dt").isNotNull())
        .groupBy(side.alias("side"))
        .agg(F.count("*").alias("n_rows"), F.avg(TARGET).alias("positive_rate"))
    )


# --- target encoding -----------------------------------------------------------


@dataclass(frozen=True)
class TargetEncoding:
    """Smoothed target mean per category, and the prior for all other categories."""

    codes: DataFrame
    prior: DataFrame
    column: str

    def apply(self, df: DataFrame, output: str) -> DataFrame:
        """Left join of the code table; unseen and missing categories get the prior.

        The table has one row per category, of any number; Spark's size check chooses
        between a broadcast and a shuffle. The prior is a scalar subquery.
        """
        codes = self.codes.select(F.col("category").alias(self.column), F.col("encoded").alias("_encoded"))
        joined = df.join(codes, self.column, "left")
        return joined.withColumn(output, F.coalesce(F.col("_encoded"), self.prior.scalar())).drop("_encoded")


def fit_target_encoding(
    train: DataFrame,
    column: str = "drg_cd",
    target: str = TARGET,
    smoothing: float = 10.0,
    min_samples: int = 20,
) -> TargetEncoding:
    """Blend each category's mean with the prior: weight 1 / (1 + exp(-(n - k) / s)).

    The formula is Micci-Barreca's (2001). Categories keep their own type; the statistics
    are written, so fitting reads the training rows once.
    """
    grouped = train.groupBy(F.col(column).alias("category")).agg(
        F.count(target).alias("n"), F.sum(target).alias("positives")
    )
    stats = materialize(grouped, "target-means")
    prior = stats.agg((F.sum("positives") / F.sum("n")).alias("prior"))
    weight = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n") - min_samples) / F.lit(smoothing)))
    mean = F.col("positives") / F.col("n")
    known = stats.where(F.col("category").isNotNull() & (F.col("n") > 0))
    blended = known.withColumn("prior", prior.scalar()).select(
        "category", (weight * mean + (F.lit(1.0) - weight) * F.col("prior")).alias("encoded")
    )
    return TargetEncoding(blended, prior, column)


# --- hold-out, folds, weights --------------------------------------------------


def stratified_holdout(
    df: DataFrame, label: str = TARGET, key: str = "claim_id", share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_holdout``: exactly ``floor(share * n)`` rows of each label value."""
    ranked = stratified_rank(df, label, key, seed)
    held = F.col("stratum_rank") <= F.floor(F.col("stratum_size") * F.lit(share))
    return ranked.withColumn("is_holdout", held.cast("int")).drop("stratum_rank", "stratum_size")


def stratified_folds(
    df: DataFrame, k: int = 5, label: str = TARGET, key: str = "claim_id", seed: int = 42
) -> DataFrame:
    """Add ``fold`` in 0..k-1; each label value is dealt out evenly."""
    ranked = stratified_rank(df, label, key, seed)
    fold = ((F.col("stratum_rank") - 1) % k).cast("int")
    return ranked.withColumn("fold", fold).drop("stratum_rank", "stratum_size")


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """One row: negatives, positives and the weight of a positive."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    weight = F.col("negatives") / F.greatest("positives", F.lit(1))
    return counts.withColumn("positive_weight", weight)


def with_class_weight(df: DataFrame, label: str = TARGET, output: str = "class_weight") -> DataFrame:
    weight = float(class_weights(df, label).first().positive_weight)
    return df.withColumn(output, F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))
