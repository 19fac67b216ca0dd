import pytest
from pyspark.sql import functions as F

from wardline.operators import quality


@pytest.fixture(scope="module")
def claims(spark):
    rows = [(f"c{i}", f"b{i % 5}", float(i)) for i in range(100)]
    return spark.createDataFrame(rows, "CLM_ID string, DESYNPUF_ID string, CLM_PMT_AMT double").withColumn(
        "CLM_ADMSN_DT", F.lit("2008-01-01").cast("date")
    )


def test_critical(claims):
    quality.check_critical(claims, ["CLM_ID", "DESYNPUF_ID"], "inpatient")
    broken = claims.withColumn("CLM_ID", F.when(F.col("CLM_ID") != "c7", F.col("CLM_ID")))
    with pytest.raises(ValueError, match="CLM_ID"):
        quality.check_critical(broken, ["DESYNPUF_ID", "CLM_ID"], "inpatient")
    with pytest.raises(ValueError, match="not found"):
        quality.check_critical(claims, ["NOPE"], "inpatient")


def test_null_rates(claims):
    half = claims.withColumn("CLM_PMT_AMT", F.when(F.col("CLM_PMT_AMT") >= 50, F.col("CLM_PMT_AMT")))
    assert quality.check_null_rates(half, {"CLM_PMT_AMT": 0.10, "GONE": 0.1}, "t") == {"CLM_PMT_AMT": 0.5}
    assert quality.check_null_rates(half, {"CLM_PMT_AMT": 0.50}, "t") == {}
    status = {r.column_name: r.status for r in quality.null_rates(half, {"CLM_PMT_AMT": 0.1, "GONE": 0.1}, "t").collect()}
    assert status == {"CLM_PMT_AMT": "violation", "GONE": "skipped"}


def test_rules_and_summary(spark, claims, tmp_path):
    bad = claims.withColumn("CLM_PMT_AMT", F.col("CLM_PMT_AMT") - 2)
    bad = bad.unionByName(bad.where("CLM_ID = 'c50'"))
    cases = quality.failure_cases(bad, quality.inpatient_rules(), "CLM_ID", "inpatient")
    assert {(r.row_key, r.failure_case) for r in cases.collect()} == {("c0", "-2.0"), ("c1", "-1.0")}
    repeated = quality.duplicate_failures(bad, "CLM_ID", "inpatient")
    assert [r.row_key for r in repeated.collect()] == ["c50", "c50"]
    contract = {"CLM_ID": "string", "CLM_PMT_AMT": "int", "NOPE": "int"}
    row = quality.table_summary(bad, quality.inpatient_rules(), contract, {"CLM_PMT_AMT": 0.01}, "CLM_ID", "t").first()
    assert (row.rows, row.violations, row.schema_errors, row.passed) == (101, 0, 6, False)
    clean = quality.table_summary(claims, quality.inpatient_rules(), {}, {"CLM_PMT_AMT": 0.01}, "CLM_ID", "t")
    assert clean.first().passed
    assert not quality.write_validation_report(
        quality.table_summary(bad, quality.inpatient_rules(), {}, {}, "CLM_ID", "t"), cases, str(tmp_path / "r")
    )
    assert quality.write_validation_report(clean, cases.limit(0), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "r" / "failures")).count() == 2
    assert quality.failure_view(cases, 1).count() == 1


def test_domains_ignore_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", None)], "DESYNPUF_ID string, BENE_SEX_IDENT_CD int")
    rules = quality.present(quality.beneficiary_rules(), df)
    found = {r.column_name: r.violations for r in quality.violation_counts(df, rules, "t").collect()}
    assert found == {"DESYNPUF_ID": 0, "BENE_SEX_IDENT_CD": 1}


def test_orphans(spark):
    child = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    parent = spark.createDataFrame([("y",)], "k string")
    assert tuple(quality.orphan_summary([("r", child, parent, "k")]).first()) == ("r", 2, 1)
