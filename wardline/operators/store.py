"""Warehouse tables on Parquet: keep-first, insert-if-absent, upserts, publishing.

Parquet directories cannot be updated in place, so each merge is a function from
DataFrames to a DataFrame, and ``publish`` writes the result to a new version
directory. Readers take the newest version that carries Spark's success marker;
a job lost half-way leaves the previous version current.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RISK_SCORE_KEY = "claim_id"
# Columns an existing risk score takes from a newer run.
RISK_SCORE_UPDATED = ("readmission_prob", "risk_tier", "model_version", "scored_at")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key in the given total order.

    An aggregate rather than a ``row_number`` window: repeats of a hot key are
    reduced map-side instead of meeting in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("picked")
    return df.groupBy(*keys).agg(picked).select(*keys, "picked.*").select(*df.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Rows of ``batch`` to append: first per key, keys already in ``target`` left out."""
    fresh = first_per_key(batch, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; the rest survives."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def upsert_risk_scores(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge scores by claim. Known claims take only ``RISK_SCORE_UPDATED`` columns."""
    key = RISK_SCORE_KEY
    o = old.withColumn("known", F.lit(True)).alias("o")
    n = new.withColumn("seen", F.lit(True)).alias("n")
    known, seen = F.col("o.known").isNotNull(), F.col("n.seen").isNotNull()

    def merged(name: str) -> Column:
        if name == key:
            return F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(name)
        takes_new = seen if name in RISK_SCORE_UPDATED else (seen & ~known)
        return F.when(takes_new, F.col(f"n.{name}")).otherwise(F.col(f"o.{name}")).alias(name)

    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    return joined.select(*[merged(c) for c in old.columns])


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, as typed nulls. Idempotent."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


# --- files ---------------------------------------------------------------------


def workspace(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint directory."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files when they end. Nothing reads these again, but
    else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the workspace and read it back: lineage ends at shared files."""
    spark = df.sparkSession
    path = f"{workspace(spark)}/wardline/{name}-{uuid.uuid4().hex}"
    with dropped_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_sides(df: DataFrame, later: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` once and read it back as the rows where ``later`` is false and where it
    is true, each from its own files. Rows where it is null are on neither side."""
    spark = df.sparkSession
    path = f"{workspace(spark)}/wardline/{name}-{uuid.uuid4().hex}"
    sided = df.withColumn("_side", later.cast("int")).where("_side IS NOT NULL")
    sided.write.partitionBy("_side").parquet(path)
    stored = spark.read.schema(sided.schema).parquet(path)
    first, second = (stored.where(F.col("_side") == side).drop("_side") for side in (0, 1))
    return first, second


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _filesystem(spark, path)
    return fs.exists(jvm_path)


def list_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the entries under ``root``; empty when it does not exist."""
    fs, jvm_path = _filesystem(spark, root)
    if not fs.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jvm_path))


def versions(spark: SparkSession, root: str) -> list[str]:
    """Complete version names under ``root``, oldest first."""
    return [n for n in list_names(spark, root) if path_exists(spark, f"{root}/{n}/_SUCCESS")]


def publish(df: DataFrame, root: str) -> str:
    """Write ``df`` as the next version of the table at ``root``; returns its path."""
    known = versions(df.sparkSession, root)
    number = int(known[-1].split("-")[0][1:]) + 1 if known else 1
    path = f"{root}/v{number:08d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """Newest complete version of the table at ``root``, or None."""
    known = versions(spark, root)
    return spark.read.parquet(f"{root}/{known[-1]}") if known else None


def append_new(batch: DataFrame, root: str, keys: Sequence[str], order) -> DataFrame:
    """Insert-if-absent into a plain Parquet table: only new rows are written.

    The table is read by the batch's schema, so a folder that a lost first write left
    without data is an empty table.
    """
    spark = batch.sparkSession
    reader = spark.read.schema(batch.schema)
    if path_exists(spark, root):
        rows = insert_ignore(reader.parquet(root), batch, keys, order)
    else:
        rows = first_per_key(batch, keys, order)
    rows.write.mode("append").parquet(root)
    return reader.parquet(root)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, empty text for nulls and ISO dates."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
