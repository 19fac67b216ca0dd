from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wardline.operators import kpi_store, store

SCORE = "claim_id string, bene_id string, readmission_prob double, risk_tier string, model_version string, scored_at date, readmission_label int"


def test_insert_ignore_and_first(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), (None, 5)], "k string, v int")
    fresh = store.insert_ignore(target, batch, ["k"], [F.col("v")])
    assert {tuple(r) for r in fresh.collect()} == {("b", 2), (None, 5)}


def test_append_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    store.append_new(batch, root, ["k"], [F.col("v")])
    store.append_new(batch.withColumn("v", F.col("v") + 5), root, ["k"], [F.col("v")])
    assert {tuple(r) for r in spark.read.parquet(root).collect()} == {("a", 1), ("b", 2)}


def test_append_after_a_lost_first_write(spark, tmp_path):
    (tmp_path / "t" / "_temporary" / "0").mkdir(parents=True)
    batch = spark.createDataFrame([("a", 1)], "k string, v int")
    store.append_new(batch, str(tmp_path / "t"), ["k"], [F.col("v")])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_score_upsert_updates_only_some_columns(spark):
    d1, d2 = date(2009, 1, 1), date(2009, 2, 1)
    old = spark.createDataFrame([("1", "p", 0.1, "low", "v1", d1, 0), ("2", "q", 0.2, "medium", "v1", d1, 1)], SCORE)
    new = spark.createDataFrame([("2", "X", 0.9, "high", "v2", d2, 0), ("3", "r", None, "low", "v2", d2, 1)], SCORE)
    found = {r.claim_id: tuple(r)[1:] for r in store.upsert_risk_scores(old, new).collect()}
    assert found == {
        "1": ("p", 0.1, "low", "v1", d1, 0),
        "2": ("q", 0.9, "high", "v2", d2, 1),
        "3": ("r", None, "low", "v2", d2, 1),
    }


def test_kpi_rerun_keeps_absent_keys_and_other_dates(spark, tmp_path):
    root = str(tmp_path / "kpi")
    ddl = "snapshot_date date, provider_id string, metric_name string, metric_value double"
    d1, d2 = date(2009, 1, 1), date(2009, 1, 2)
    kpi_store.write_kpis(spark.createDataFrame([(d1, "A", "m", 1.0), (d1, "B", "m", 2.0), (d2, "A", "m", 3.0)], ddl), root)
    for _ in range(2):
        kpi_store.write_kpis(spark.createDataFrame([(d1, "A", "m", 7.0), (d1, "C", "m", 8.0)], ddl), root)
    found = {(r.snapshot_date, r.provider_id): r.metric_value for r in kpi_store.read_kpis(spark, root).collect()}
    assert found == {(d1, "A"): 7.0, (d1, "B"): 2.0, (d1, "C"): 8.0, (d2, "A"): 3.0}


def test_versions_ignore_unfinished_writes(spark, tmp_path):
    root = str(tmp_path / "v")
    assert store.read_current(spark, root) is None
    store.publish(spark.range(1), root)
    store.publish(spark.range(2), root)
    (tmp_path / "v" / "v00000009-dead").mkdir()
    assert store.read_current(spark, root).count() == 2
    assert len(store.versions(spark, root)) == 2


def test_ensure_columns(spark):
    schema = StructType([StructField("x", DoubleType())])
    df = store.ensure_columns(store.ensure_columns(spark.range(1), schema), schema)
    assert df.dtypes == [("id", "bigint"), ("x", "double")]


def test_csv_format(spark, tmp_path):
    df = spark.createDataFrame([("a", None, date(2009, 1, 2)), (None, 5, None)], "s string, n int, d date").coalesce(1)
    store.write_csv(df, str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("*.csv")).read_text().splitlines()
    assert text == ["s,n,d", "a,,2009-01-02", ",5,"]


def test_written_tables_leave_no_shuffle_files(spark):
    import time

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = blocks.getAllBlocks().toString().count("shuffle_")
    grouped = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    assert store.materialize(grouped, "grouped").count() == 100
    assert spark.conf.get(store.DROP_SHUFFLES, None) is None
    for _ in range(50):  # removed in the background
        left = blocks.getAllBlocks().toString().count("shuffle_")
        if left <= before:
            break
        time.sleep(0.1)
    # The count just above has at most one file and its index for each of its tasks.
    assert left - before <= 2 * spark.sparkContext.defaultParallelism
