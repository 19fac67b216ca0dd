"""Physical plans as they would be on large tables (size-based broadcasts switched off)."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import queries

DIRECTORY = "/root/testdata/sf0.001"
# Hinted broadcasts that are allowed: bucket totals and model totals.
HINTED = {"roc_curve": 2}
NAMES = [
    "dedup_keep_first", "failure_cases", "fk_orphans", "patient_features", "prior_admits", "readmission_label",
    "comorbidity_pivot", "feature_pipeline", "target_encode", "soft_vote", "stratified_holdout", "roc_curve",
    "kpi_input", "kpi_snapshot", "kpi_upsert", "risk_score_upsert", "provider_table", "export_risk_scores",
]


@pytest.fixture
def large(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries()[name](spark, DIRECTORY).explain("simple")
    return out.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loops_and_only_bounded_broadcasts(large, name):
    text = plan(large, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("BroadcastHashJoin") == HINTED.get(name, 0)
    # A window prints its functions, its partition keys and, if any, its order.
    for line in text.splitlines():
        if re.search(r"[- ]Window \[", line):
            lists = line.split("], [")
            ordered = " ASC" in lists[-1] or " DESC" in lists[-1]
            assert len(lists) >= (3 if ordered else 2), line


def test_scans_read_only_what_is_needed(large):
    text = plan(large, "prior_admits")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert columns == {"o_orderkey", "o_custkey", "o_orderdate"}


def test_claims_are_shuffled_once_on_patient_and_day(large):
    text = plan(large, "patient_features")
    wide = [s for s in text.split("\n") if "Exchange hashpartitioning(bene_id" in re.sub(r"#\d+L?", "", s)]
    # Claims, admission days (counted, then windowed), their join side, patients, conditions.
    assert len(wide) <= 7
    days = [s for s in wide if "coalesce(admit_dt" in re.sub(r"#\d+L?", "", s)]
    assert len(days) == 2
