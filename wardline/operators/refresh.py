"""Feature view brought up to date by batches: only the batch's patients are recomputed.

The view is a log. A batch appends all rows of the patients that it touches (new or late
claims, changed attributes or conditions), under the batch's number; a patient's rows are
those of the newest batch that has the patient. Nothing written is replaced, so readers and
lost jobs never see half a batch, and a repeated batch changes nothing. ``compact`` writes
the log's current rows as one batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.history import patient_features
from wardline.operators.store import path_exists, publish, versions

BATCH = "batch"


def touched_patients(*changes: DataFrame) -> DataFrame:
    """Distinct patients of the tables of a batch."""
    found = changes[0].select("bene_id")
    for change in changes[1:]:
        found = found.unionByName(change.select("bene_id"))
    return found.where("bene_id IS NOT NULL").distinct()


def features_of(patients: DataFrame, claims: DataFrame, beneficiaries: DataFrame, conditions: DataFrame) -> DataFrame:
    """The feature view of these patients, from their whole history."""
    parts = [t.join(patients, "bene_id", "left_semi") for t in (claims, beneficiaries, conditions)]
    return patient_features(*parts, keep_next_admit=True, condition_flags=True)


def append_batch(view: DataFrame, patients: DataFrame, root: str) -> None:
    """Append a batch's rows, and its patients, also those that have no rows any more."""
    marked = patients.join(view, "bene_id", "left")
    publish(marked.select(*view.columns), root)


def current_view(spark: SparkSession, root: str) -> DataFrame:
    """The rows of each patient's newest batch."""
    names = versions(spark, root)
    if not names:
        raise FileNotFoundError(f"{root} has no complete batch")
    log = spark.read.parquet(*[f"{root}/{n}" for n in names])
    # The batch's folder is its number.
    numbered = log.withColumn(BATCH, F.regexp_extract(F.col("_metadata.file_path"), r"/(v\d{8})-", 1))
    newest = numbered.groupBy("bene_id").agg(F.max(BATCH).alias("newest")).withColumnRenamed("bene_id", "patient")
    kept = numbered.join(newest, (F.col("bene_id") == F.col("patient")) & (F.col(BATCH) == F.col("newest")))
    return kept.where("claim_id IS NOT NULL").select(*log.columns)


def refresh(batch: tuple[DataFrame, ...], tables: tuple[DataFrame, DataFrame, DataFrame], root: str) -> DataFrame:
    """Append the batch's patients and return the current view.

    ``batch`` are the tables that changed, each with ``bene_id``; ``tables`` the whole
    claims, beneficiaries and conditions, the batch included.
    """
    patients = touched_patients(*batch)
    append_batch(features_of(patients, *tables), patients, root)
    return current_view(tables[0].sparkSession, root)


def compact(spark: SparkSession, root: str, into: str) -> DataFrame:
    """Write the current view as the only batch of a new log at ``into``."""
    if path_exists(spark, into):
        raise FileExistsError(f"{into} is in use")
    publish(current_view(spark, root), into)
    return current_view(spark, into)
