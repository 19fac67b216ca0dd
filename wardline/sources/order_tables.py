"""Claims data derived from the driver's order tables.

The driver's Parquet files hold no hospital claims, so customers stand for
beneficiaries, orders for inpatient claims and order lines for service lines and
codes. The mapping is column arithmetic over whole tables: it scales with them. The
raw extracts are the same rows as text, with bad values in some of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wardline.operators.normalize import long_conditions
from wardline.sources.columns import CONDITION_CODES, DIAGNOSIS_PREFIX, PROCEDURE_PREFIX

DIAGNOSES = range(1, 11)
PROCEDURES = range(1, 7)


def _flag(i: int, name: str) -> str:
    v = f"(c_custkey * {2 * i + 3} + {i}) % 10"
    return f"CASE WHEN {v} < 7 THEN 0 WHEN {v} < 9 THEN 1 ELSE 2 END AS {name}"


def _code(key: str) -> str:
    """Three-digit code text; some are blank, some padded with spaces."""
    digits = f"lpad(CAST({key} % 1000 AS STRING), 3, '0')"
    return f"CASE WHEN {key} % 17 = 0 THEN '  ' WHEN {key} % 13 = 0 THEN concat(' ', {digits}, ' ') ELSE {digits} END"


def _text_date(key: str, day: str) -> str:
    """Date as digits, with some impossible, empty and wordy values."""
    return (
        f"CASE WHEN {key} % 97 = 0 THEN '99999999' WHEN {key} % 89 = 0 THEN '' "
        f"WHEN {key} % 83 = 0 THEN 'not_a_date' ELSE date_format({day}, 'yyyyMMdd') END"
    )


_PAID = "CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2))"
_ADMIT = "CAST(o_orderdate AS DATE)"
_DIAGNOSIS_NAMES = [f"{DIAGNOSIS_PREFIX}{k}" for k in DIAGNOSES]
_PROCEDURE_NAMES = [f"{PROCEDURE_PREFIX}{k}" for k in PROCEDURES]


@dataclass(frozen=True)
class OrderTables:
    """Lazy claims tables over one directory of order tables."""

    spark: SparkSession
    directory: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    # --- warehouse tables ---

    @cached_property
    def patients(self) -> DataFrame:
        """Beneficiaries with their condition flags still wide."""
        return self.table("customer").selectExpr(
            "c_custkey AS bene_id",
            "date_add(DATE'1920-01-01', CAST(c_custkey * 7919 % 12784 AS INT)) AS birth_dt",
            "CASE WHEN c_custkey % 12 = 0 THEN date_add(DATE'1996-01-01', CAST(c_custkey * 104729 % 2000 AS INT)) END AS death_dt",
            "CAST(1 + c_custkey % 2 AS INT) AS sex_cd",
            "CAST(1 + c_custkey % 6 AS INT) AS race_cd",
            "CASE WHEN c_custkey % 25 < 7 THEN 12 ELSE 0 END AS hmo_coverage_months",
            "CAST(c_nationkey % 13 AS INT) AS hi_coverage_months",
            "CAST(c_acctbal AS DECIMAL(12,2)) AS medreimb_ip",
            *[_flag(i, name) for i, name in enumerate(CONDITION_CODES)],
        )

    @cached_property
    def beneficiaries(self) -> DataFrame:
        return self.patients.drop(*CONDITION_CODES)

    @cached_property
    def conditions(self) -> DataFrame:
        return long_conditions(self.patients, "bene_id")

    @cached_property
    def admissions(self) -> DataFrame:
        """Keys and days of all claims, without the facts that need the order lines."""
        return self.table("orders").selectExpr("o_orderkey AS claim_id", "o_custkey AS bene_id", f"{_ADMIT} AS admit_dt")

    @cached_property
    def payments(self) -> DataFrame:
        """Payments of all claims."""
        return self.table("orders").selectExpr("o_orderkey AS claim_id", f"{_PAID} AS claim_pmt_amt")

    @cached_property
    def wide_claims(self) -> DataFrame:
        """Claims with their code columns still wide."""
        first_part = [f"min(CASE WHEN l_linenumber = {k} THEN l_partkey END) AS d{k}" for k in DIAGNOSES]
        returned = [
            f"min(CASE WHEN l_linenumber = {k} AND l_returnflag = 'R' THEN l_suppkey END) AS p{k}" for k in PROCEDURES
        ]
        facts = ["CAST(count(*) AS INT) AS n_lines", "min(l_suppkey) AS supplier", "min(l_partkey) AS part"]
        sql = f"""
            SELECT o_orderkey AS claim_id, o_custkey AS bene_id, {_ADMIT} AS admit_dt,
              date_add({_ADMIT}, n_lines) AS discharge_dt,
              concat('PROV', lpad(CAST(supplier % 30 + 1 AS STRING), 3, '0')) AS provider_id,
              p_size AS drg_cd,
              CAST(1 + o_orderkey % 9 AS INT) AS admit_source_cd,
              CAST(substring(o_orderpriority, 1, 1) AS INT) AS admit_type_cd,
              CASE WHEN o_orderkey % 53 = 0 THEN CAST(NULL AS INT) WHEN o_orderstatus = 'F' THEN 1
                WHEN o_orderstatus = 'O' THEN element_at(array(2, 3, 6), CAST(o_orderkey % 3 + 1 AS INT))
                ELSE element_at(array(20, 30, 1, 99), CAST(o_orderkey % 4 + 1 AS INT)) END AS discharge_status_cd,
              {_PAID} AS claim_pmt_amt,
              CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))
                * CAST(1 + o_orderkey % 5 AS DECIMAL(2,0)) AS DECIMAL(12,2)) AS pass_thru_amt,
              n_lines AS utilization_day_cnt,
              trim({_code("d1")}) AS admitting_icd9,
              {", ".join(f"{_code(f'd{k}')} AS {DIAGNOSIS_PREFIX}{k}" for k in DIAGNOSES)},
              {", ".join(f"{_code(f'p{k}')} AS {PROCEDURE_PREFIX}{k}" for k in PROCEDURES)}
            FROM {{orders}}
            LEFT JOIN (SELECT l_orderkey, {", ".join(facts + first_part + returned)} FROM {{lines}} GROUP BY l_orderkey)
              ON o_orderkey = l_orderkey
            LEFT JOIN (SELECT p_partkey, p_size FROM {{parts}}) ON p_partkey = part
        """
        return self.spark.sql(
            sql, orders=self.table("orders"), lines=self.table("lineitem"), parts=self.table("part")
        )

    @cached_property
    def claims(self) -> DataFrame:
        return self.wide_claims.drop(*_DIAGNOSIS_NAMES, *_PROCEDURE_NAMES)

    # --- raw extracts (text) ---

    @cached_property
    def raw_beneficiaries(self) -> DataFrame:
        return self.patients.selectExpr(
            "CAST(bene_id AS STRING) AS DESYNPUF_ID",
            f"{_text_date('bene_id', 'birth_dt')} AS BENE_BIRTH_DT",
            "date_format(death_dt, 'yyyyMMdd') AS BENE_DEATH_DT",
            "CASE WHEN bene_id % 61 = 0 THEN '3' ELSE CAST(sex_cd AS STRING) END AS BENE_SEX_IDENT_CD",
            "CASE WHEN bene_id % 67 = 0 THEN '9' ELSE CAST(race_cd AS STRING) END AS BENE_RACE_CD",
            "CAST(hi_coverage_months AS STRING) AS BENE_HI_CVRAGE_TOT_MONS",
            "CAST(hmo_coverage_months AS STRING) AS BENE_HMO_CVRAGE_TOT_MONS",
            "CAST(medreimb_ip AS STRING) AS MEDREIMB_IP",
            *[
                f"CASE WHEN bene_id % 71 = {i} THEN '5' ELSE CAST({name} AS STRING) END AS {name}"
                for i, name in enumerate(CONDITION_CODES)
            ],
        )

    @cached_property
    def raw_inpatient(self) -> DataFrame:
        return self.wide_claims.selectExpr(
            "CAST(claim_id AS STRING) AS CLM_ID",
            "CASE WHEN claim_id % 499 = 0 THEN '' ELSE CAST(bene_id AS STRING) END AS DESYNPUF_ID",
            f"{_text_date('claim_id', 'admit_dt')} AS CLM_ADMSN_DT",
            "date_format(discharge_dt, 'yyyyMMdd') AS NCH_BENE_DSCHRG_DT",
            "provider_id AS PRVDR_NUM",
            "CASE WHEN claim_id % 59 = 0 THEN 'abc' WHEN claim_id % 61 = 0 THEN '1.5' WHEN claim_id % 67 = 0 THEN '99999' "
            "WHEN claim_id % 7 = 0 THEN concat(drg_cd, '.0') ELSE CAST(drg_cd AS STRING) END AS CLM_DRG_CD",
            "CAST(admit_source_cd AS STRING) AS CLM_ADMSN_SOURCE_CD",
            "CAST(admit_type_cd AS STRING) AS CLM_IP_ADMSN_TYPE_CD",
            "CAST(discharge_status_cd AS STRING) AS PTNT_DSCHRG_STUS_CD",
            "CASE WHEN claim_id % 103 = 0 THEN concat('-', claim_pmt_amt) WHEN claim_id % 107 = 0 THEN 'n/a' "
            "ELSE CAST(claim_pmt_amt AS STRING) END AS CLM_PMT_AMT",
            "CAST(pass_thru_amt AS STRING) AS CLM_PASS_THRU_AMT",
            "CAST(utilization_day_cnt AS STRING) AS CLM_UTLZTN_DAY_CNT",
            "admitting_icd9 AS ADMTNG_ICD9_DGNS_CD",
            *_DIAGNOSIS_NAMES,
            *_PROCEDURE_NAMES,
        )
