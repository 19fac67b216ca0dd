"""Column names of the raw extracts and their warehouse names."""

from __future__ import annotations

# Chronic-condition flag columns and their condition codes.
CONDITION_CODES = {
    "SP_ALZHDMTA": "alzheimers",
    "SP_CHF": "chf",
    "SP_CHRNKIDN": "chronic_kidney",
    "SP_CNCR": "cancer",
    "SP_COPD": "copd",
    "SP_DEPRESSN": "depression",
    "SP_DIABETES": "diabetes",
    "SP_ISCHMCHT": "ischemic_heart",
    "SP_OSTEOPRS": "osteoporosis",
    "SP_RA_OA": "ra_oa",
    "SP_STRKETIA": "stroke_tia",
}
HIGH_WEIGHT_CONDITIONS = ("chf", "chronic_kidney", "cancer", "copd", "stroke_tia")

# Raw beneficiary column -> (warehouse column, Spark type).
BENEFICIARY_COLUMNS = {
    "DESYNPUF_ID": ("bene_id", "string"),
    "BENE_BIRTH_DT": ("birth_dt", "date"),
    "BENE_DEATH_DT": ("death_dt", "date"),
    "BENE_SEX_IDENT_CD": ("sex_cd", "int"),
    "BENE_RACE_CD": ("race_cd", "int"),
    "BENE_HI_CVRAGE_TOT_MONS": ("hi_coverage_months", "int"),
    "BENE_SMI_CVRAGE_TOT_MONS": ("smi_coverage_months", "int"),
    "BENE_HMO_CVRAGE_TOT_MONS": ("hmo_coverage_months", "int"),
    "PLAN_CVRG_MOS_NUM": ("plan_coverage_months", "int"),
    "MEDREIMB_IP": ("medreimb_ip", "decimal(12,2)"),
    "BENRES_IP": ("benres_ip", "decimal(12,2)"),
    "PPPYMT_IP": ("pppymt_ip", "decimal(12,2)"),
    "MEDREIMB_OP": ("medreimb_op", "decimal(12,2)"),
    "BENRES_OP": ("benres_op", "decimal(12,2)"),
    "PPPYMT_OP": ("pppymt_op", "decimal(12,2)"),
    "MEDREIMB_CAR": ("medreimb_car", "decimal(12,2)"),
    "BENRES_CAR": ("benres_car", "decimal(12,2)"),
    "PPPYMT_CAR": ("pppymt_car", "decimal(12,2)"),
}

# Raw inpatient column -> (warehouse column, Spark type).
CLAIM_COLUMNS = {
    "CLM_ID": ("claim_id", "string"),
    "DESYNPUF_ID": ("bene_id", "string"),
    "CLM_ADMSN_DT": ("admit_dt", "date"),
    "NCH_BENE_DSCHRG_DT": ("discharge_dt", "date"),
    "PRVDR_NUM": ("provider_id", "string"),
    "CLM_DRG_CD": ("drg_cd", "int"),
    "CLM_ADMSN_SOURCE_CD": ("admit_source_cd", "int"),
    "CLM_IP_ADMSN_TYPE_CD": ("admit_type_cd", "int"),
    "PTNT_DSCHRG_STUS_CD": ("discharge_status_cd", "int"),
    "CLM_PMT_AMT": ("claim_pmt_amt", "decimal(12,2)"),
    "CLM_PASS_THRU_AMT": ("pass_thru_amt", "decimal(12,2)"),
    "NCH_PRMRY_PYR_CLM_PD_AMT": ("nch_prmry_pyr_clm_pd_amt", "decimal(12,2)"),
    "NCH_BENE_IP_DDCTBL_AMT": ("ip_ddctbl_amt", "decimal(12,2)"),
    "NCH_BENE_PTA_COINSRNC_LBLTY_AM": ("pta_coinsrnc_amt", "decimal(12,2)"),
    "NCH_BENE_BLOOD_PNTS_FRNSHD_QTY": ("blood_pnts_qty", "int"),
    "CLM_UTLZTN_DAY_CNT": ("utilization_day_cnt", "int"),
    "ADMTNG_ICD9_DGNS_CD": ("admitting_icd9", "string"),
}

DIAGNOSIS_PREFIX = "ICD9_DGNS_CD_"
PROCEDURE_PREFIX = "ICD9_PRCDR_CD_"


def raw_columns(spec: dict, spark_type: str) -> list[str]:
    """Raw column names of ``spec`` whose warehouse type starts with ``spark_type``."""
    return [raw for raw, (_, kind) in spec.items() if kind.startswith(spark_type)]


BENEFICIARY_INTS = raw_columns(BENEFICIARY_COLUMNS, "int") + list(CONDITION_CODES) + ["BENE_ESRD_IND"]
CLAIM_INTS = raw_columns(CLAIM_COLUMNS, "int") + ["NCH_PTNT_STATUS_IND_CD"]
