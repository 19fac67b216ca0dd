import hashlib
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests import data
from wardline.config import Settings, load_settings, settings_from_dict
from wardline.functions import coerce
from wardline.operators.normalize import long_conditions, long_diagnoses, long_procedures, normalize_claims
from wardline.sources import extracts


def column(spark, values, convert):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", convert(F.col("v")).alias("o")).orderBy("i").collect()]


def test_dates(spark):
    found = column(spark, ["20080115", "20091231", None, "not_a_date", "99999999", "2008011"], coerce.parse_date)
    assert found == [date(2008, 1, 15), date(2009, 12, 31), None, None, None, None]


def test_small_ints(spark):
    found = column(spark, ["1", "2.0", None, "3", "1.5", "99999", "abc", "1d", " 7 "], coerce.to_small_int)
    assert found == [1, 2, None, 3, None, None, None, None, 7]


def test_floats_and_missing(spark):
    assert column(spark, ["1.25", "-3", "1e2", "x", ""], coerce.to_float) == [1.25, -3.0, 100.0, None, None]
    assert column(spark, ["NA", "", "null", "0", "none"], coerce.missing_to_null) == [None, None, None, "0", "none"]


def test_csv_beats_zip_keeps_first_and_unions_columns(spark, tmp_path):
    bene = data.beneficiaries(20)
    data.write_csv(bene, tmp_path / "Beneficiary_a.csv")
    extra = [{**bene[0], "BENE_RACE_CD": "6", "NOTE": "second"}, {**bene[1], "DESYNPUF_ID": "NEW", "NOTE": "n"}]
    data.write_csv(extra, tmp_path / "beneficiary_b.csv")
    data.write_csv(data.inpatient(50, 20), tmp_path / "INPATIENT.csv")
    with zipfile.ZipFile(tmp_path / "bene.zip", "w") as z:
        z.writestr("x.csv", "DESYNPUF_ID\nZ\n")
    loaded = extracts.load_extracts(spark, str(tmp_path))
    rows = {r.DESYNPUF_ID: r for r in loaded.beneficiaries.collect()}
    assert len(rows) == 21 and "Z" not in rows
    assert rows[bene[0]["DESYNPUF_ID"]].BENE_RACE_CD == int(bene[0]["BENE_RACE_CD"])
    assert rows["NEW"].NOTE == "n" and rows[bene[2]["DESYNPUF_ID"]].NOTE is None
    assert loaded.inpatient.count() == 50
    assert dict(loaded.inpatient.dtypes)["CLM_ADMSN_DT"] == "date"


def test_zip_extracts(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "DE1_Bene_1.zip", "w") as z:
        z.writestr("readme.txt", "no")
        z.writestr("a.csv", 'DESYNPUF_ID,BENE_BIRTH_DT,NOTE\nA,19300102,"café, x"\nB,,"q ""z"""\n'.encode("latin-1"))
    with zipfile.ZipFile(tmp_path / "Inpatient_1.zip", "w") as z:
        z.writestr("b.csv", "CLM_ID,DESYNPUF_ID,CLM_ADMSN_DT\n1,A,20080101\n1,B,20080102\n")
    loaded = extracts.load_extracts(spark, str(tmp_path))
    notes = {r.DESYNPUF_ID: (r.BENE_BIRTH_DT, r.NOTE) for r in loaded.beneficiaries.collect()}
    assert notes == {"A": (date(1930, 1, 2), "café, x"), "B": (None, 'q "z"')}
    assert [r.DESYNPUF_ID for r in loaded.inpatient.collect()] == ["A"]


def test_missing_files(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        extracts.load_extracts(spark, str(tmp_path))
    data.write_csv(data.beneficiaries(3), tmp_path / "bene.csv")
    with pytest.raises(FileNotFoundError, match="inpatient"):
        extracts.load_extracts(spark, str(tmp_path))


def test_checksums(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / name).write_bytes(name.encode())
    known = [("a", hashlib.sha256(b"a").hexdigest()), ("b", "0" * 64)]
    manifest = spark.createDataFrame(known, "file_name string, sha256 string")
    found = {r.file_name: r.status for r in extracts.verify_checksums(spark, str(tmp_path), manifest).collect()}
    assert found == {"a": "ok", "b": "mismatch", "c": "skipped"}


def test_long_tables_keep_positions(spark):
    wide = spark.createDataFrame(
        [("1", "250", "  ", " 401 ", None), ("2", None, None, None, "8")],
        "CLM_ID string, ICD9_DGNS_CD_1 string, ICD9_DGNS_CD_2 string, ICD9_DGNS_CD_3 string, ICD9_PRCDR_CD_1 string",
    )
    assert {tuple(r) for r in long_diagnoses(wide).collect()} == {("1", 1, "250"), ("1", 3, "401")}
    assert {tuple(r) for r in long_procedures(wide).collect()} == {("2", 1, "8")}
    assert long_procedures(wide.drop("ICD9_PRCDR_CD_1")).count() == 0
    flags = spark.createDataFrame([("p", 0, 1), ("q", 2, None)], "DESYNPUF_ID string, SP_CHF int, SP_CNCR int")
    assert {tuple(r) for r in long_conditions(flags).collect()} == {("p", "cancer", 1), ("q", "chf", 2)}
    assert long_conditions(flags.select("DESYNPUF_ID")).count() == 0
    assert normalize_claims(wide).columns == ["claim_id"]


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("features:\n  temporal_split_date: '2009-01-01'\nscoring:\n  risk_tiers: {high: 0.4}\n")
    found = load_settings(str(path))
    assert found.split_date == date(2009, 1, 1) and found.tier_high == 0.4 and found.tier_medium == 0.15
    assert settings_from_dict({}) == Settings()
