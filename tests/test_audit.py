"""Checks counted while the typed checkpoint is written."""


import pytest

from tests import data
from wardline.config import Settings, settings_from_dict
from wardline.operators import audit
from wardline.plans import pipeline

SETTINGS = Settings(null_thresholds={"CLM_PMT_AMT": 0.01, "CLM_DRG_CD": 0.1, "CLM_DSCHRGDT": 0.05})


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    raw, root = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("house")
    bene, claims = data.beneficiaries(), data.inpatient()
    bene[3]["BENE_BIRTH_DT"] = "19321301"  # no such month
    bene[4]["BENE_SEX_IDENT_CD"] = "7"
    bene.append({**bene[5], "BENE_RACE_CD": "2"})  # a repeated key
    for k in range(20):
        claims[k]["CLM_PMT_AMT"] = None if k % 2 else "not money"
    claims[30]["CLM_PMT_AMT"] = "-5"
    claims[31]["CLM_PMT_AMT"] = "20000000"
    claims[32]["CLM_PMT_AMT"] = "12345678901.5"
    claims[33]["DESYNPUF_ID"] = "NOBODY"
    claims[34]["CLM_DRG_CD"] = "1.5"
    data.write_csv(bene, raw / "Beneficiary_1.csv")
    data.write_csv(claims, raw / "Inpatient_1.csv")
    house = pipeline.Warehouse(spark, str(root))
    extract, checks = pipeline.stage(str(raw), house, SETTINGS)
    for path in raw.iterdir():
        path.write_text("")  # nothing below may read the raw files again
    return house, extract, checks


def test_counts_of_the_one_pass(staged):
    rows = {(r.table_name, r.column_name, r.check_name): r for r in staged[2].collect()}

    def counted(*key):
        return rows[key].failures, rows[key].status

    assert counted("inpatient", "CLM_PMT_AMT", "null_rate") == (20, "violation")
    assert rows["inpatient", "CLM_PMT_AMT", "null_rate"].percent == pytest.approx(100 * 20 / 900)
    assert rows["inpatient", "CLM_PMT_AMT", "null_rate"].max_percent == 1.0
    assert counted("inpatient", "CLM_DRG_CD", "null_rate") == (1, "ok")
    assert counted("inpatient", "CLM_DSCHRGDT", "null_rate") == (None, "skipped")
    assert counted("inpatient", "CLM_PMT_AMT", "conversion") == (10, "violation")
    assert counted("inpatient", "CLM_DRG_CD", "conversion") == (1, "violation")
    assert counted("inpatient", "CLM_ADMSN_DT", "conversion") == (0, "ok")
    assert counted("beneficiaries", "BENE_BIRTH_DT", "conversion") == (1, "violation")
    assert counted("beneficiaries", "BENE_BIRTH_DT", "critical_null") == (1, "violation")
    assert counted("inpatient", "CLM_PMT_AMT", "in_range(0.0, 10000000.0)") == (3, "violation")
    assert counted("inpatient", "CLM_PMT_AMT", "fits_decimal(12,2)") == (1, "violation")
    assert counted("beneficiaries", "BENE_SEX_IDENT_CD", "isin(1, 2)") == (1, "violation")
    assert counted("beneficiaries", "DESYNPUF_ID", "field_uniqueness") == (2, "violation")
    assert counted("inpatient", "CLM_ID", "field_uniqueness") == (0, "ok")
    assert counted("inpatient", "DESYNPUF_ID", "references(beneficiaries)") == (1, "violation")
    assert all(r.checked in (900, 121) for r in rows.values())


def test_report_and_load_from_the_checkpoint(spark, staged, tmp_path):
    house, extract, checks = staged
    assert extract.beneficiaries.count() == 120 and extract.inpatient.count() == 900
    with pytest.raises(ValueError, match="BENE_BIRTH_DT"):
        pipeline.validate(extract, SETTINGS, str(tmp_path / "r"), checks)
    lenient = Settings(critical_beneficiaries=("DESYNPUF_ID",), null_thresholds=SETTINGS.null_thresholds)
    assert not pipeline.validate(extract, lenient, str(tmp_path / "r"), checks)
    written = spark.read.json(str(tmp_path / "r" / "checks"))
    assert written.count() == checks.count() and written.where("status = 'violation' and percent > 0").count() >= 8
    pipeline.load(extract, house)
    assert house.read("claims/inpatient_claims").where("claim_pmt_amt is null").count() == 21  # one amount too large
    assert house.read("claims/beneficiaries").count() == 120


def test_ranges_of_the_settings_act():
    settings = settings_from_dict({"validation": {"ranges": {"CLM_PMT_AMT": [0, 50]}}})
    assert pipeline.contracts(settings)[1].ranges == {"CLM_PMT_AMT": (0.0, 50.0)}


def test_empty_tables(spark, tmp_path):
    raw = spark.createDataFrame([], "CLM_ID string, CLM_PMT_AMT string")
    contract = audit.Contract("t", "CLM_ID", ["CLM_PMT_AMT"], ["CLM_ID"], {"CLM_PMT_AMT": 0.1})
    table, rows = audit.write_audited(raw, lambda df: df, contract, str(tmp_path / "t"))
    assert table.count() == 0 and {r[-1] for r in rows + audit.key_checks(table, contract)} == {"ok"}
