"""KPI rows in a versioned table: upserts are appends, the newest writing of a key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.operators.manifest import ORDINAL, VersionedTable

KPI_DDL = "snapshot_date date, provider_id string, metric_name string, metric_value double"
WRITTEN_AT = "written_at"
KPI_KEY = ("snapshot_date", "provider_id", "metric_name")


def write_kpis(new: DataFrame, root: str) -> DataFrame:
    """Upsert KPI rows as a part behind all others; returns the merged view (``read_kpis``).

    Nothing already written is replaced, so readers and lost jobs never see a partition
    half rewritten, and writing the same batch again changes nothing. Of several writers at
    once the one that commits last wins.
    """
    spark = new.sparkSession
    VersionedTable(spark, root).append(new.select(*StructType.fromDDL(KPI_DDL).names), "snapshot_date")
    return read_kpis(spark, root)


def written_kpis(spark: SparkSession, root: str) -> DataFrame:
    """All KPI rows as written, older writings of a key included, with their order."""
    rows = VersionedTable(spark, root).read(StructType.fromDDL(KPI_DDL))
    return rows.withColumnRenamed(ORDINAL, WRITTEN_AT)


def compact_kpis(spark: SparkSession, root: str, keep_versions: int = 2) -> None:
    """Merge all writings into one part; versions before the last ones are deleted."""
    table = VersionedTable(spark, root)

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KPI_KEY).agg(F.max_by("metric_value", ORDINAL).alias("metric_value"))

    table.compact(StructType.fromDDL(KPI_DDL), merge, "snapshot_date")
    table.expire(keep_versions)


def read_kpis(spark: SparkSession, root: str) -> DataFrame:
    """KPI rows, the newest writing of each key. Filters on the date prune partitions."""
    written = written_kpis(spark, root)
    return written.groupBy(*KPI_KEY).agg(F.max_by("metric_value", WRITTEN_AT).alias("metric_value"))
