"""Oracle SQL (DuckDB) for the catalogue, in a different shape from the Spark jobs.

History is written as correlated subqueries, curves as unpartitioned windows, and
upserts as set operations. All statements share one prefix of common tables over
the order tables.
"""

from __future__ import annotations

from wardline.functions.coerce import NA_TOKENS
from wardline.sources.columns import CONDITION_CODES, HIGH_WEIGHT_CONDITIONS

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_FLAGS = list(CONDITION_CODES)
_NA = ", ".join(f"'{t}'" for t in NA_TOKENS)
_COND_COLS = [f"cond_{c}" for c in CONDITION_CODES.values()]


def _join(parts, separator=",\n  "):
    return separator.join(parts)


def _r(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {name}"


def _d(expression: str, name: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS VARCHAR) AS {name}"


def _flag_sql(i: int, name: str) -> str:
    v = f"(c_custkey * {2 * i + 3} + {i}) % 10"
    return f"CASE WHEN {v} < 7 THEN 0 WHEN {v} < 9 THEN 1 ELSE 2 END AS {name}"


def _code(key: str) -> str:
    digits = f"lpad(CAST({key} % 1000 AS VARCHAR), 3, '0')"
    return f"CASE WHEN {key} % 17 = 0 THEN '  ' WHEN {key} % 13 = 0 THEN ' ' || {digits} || ' ' ELSE {digits} END"


_BAD_DATE = (
    "CASE WHEN {k} % 97 = 0 THEN '99999999' WHEN {k} % 89 = 0 THEN '' "
    "WHEN {k} % 83 = 0 THEN 'not_a_date' ELSE strftime({d}, '%Y%m%d') END"
)


def _text(expression: str, name: str) -> str:
    return f"CASE WHEN ({expression}) NOT IN ({_NA}) THEN ({expression}) END AS {name}"


def _date(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '[0-9]{{8}}') THEN CAST(try_strptime({column}, '%Y%m%d') AS DATE) END"


def _float(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, '{_NUMBER}') THEN TRY_CAST(trim({column}) AS DOUBLE) END"


def _int(column: str) -> str:
    value = _float(column)
    return f"CAST(CASE WHEN ({value}) = floor({value}) THEN TRY_CAST(({value}) AS SMALLINT) END AS INTEGER)"


_PREFIX = f"""WITH lines AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n_lines, min(l_suppkey) AS supp, min(l_partkey) AS part,
  {_join(f"min(CASE WHEN l_linenumber = {k} THEN l_partkey END) AS d{k}" for k in range(1, 11))},
  {_join(f"min(CASE WHEN l_linenumber = {k} AND l_returnflag = 'R' THEN l_suppkey END) AS p{k}" for k in range(1, 7))}
  FROM lineitem GROUP BY l_orderkey
), patients AS (
  SELECT c_custkey AS bene_id,
  DATE '1920-01-01' + CAST(c_custkey * 7919 % 12784 AS INTEGER) AS birth_dt,
  CASE WHEN c_custkey % 12 = 0 THEN DATE '1996-01-01' + CAST(c_custkey * 104729 % 2000 AS INTEGER) END AS death_dt,
  CAST(1 + c_custkey % 2 AS INTEGER) AS sex_cd, CAST(1 + c_custkey % 6 AS INTEGER) AS race_cd,
  CASE WHEN c_custkey % 25 < 7 THEN 12 ELSE 0 END AS hmo_coverage_months,
  CAST(c_nationkey % 13 AS INTEGER) AS hi_coverage_months,
  CAST(c_acctbal AS DECIMAL(12,2)) AS medreimb_ip,
  {_join(_flag_sql(i, n) for i, n in enumerate(_FLAGS))}
  FROM customer
), cond AS (
  {_join((f"SELECT bene_id, '{c}' AS condition_code, {n} AS indicator FROM patients WHERE {n} IN (1, 2)" for n, c in CONDITION_CODES.items()), " UNION ALL ")}
), wide AS MATERIALIZED (
  SELECT o_orderkey AS claim_id, o_custkey AS bene_id, CAST(o_orderdate AS DATE) AS admit_dt,
  CAST(o_orderdate AS DATE) + n_lines AS discharge_dt,
  'PROV' || lpad(CAST(supp % 30 + 1 AS VARCHAR), 3, '0') AS provider_id, p_size AS drg_cd,
  CAST(1 + o_orderkey % 9 AS INTEGER) AS admit_source_cd,
  CAST(o_orderpriority[1] AS INTEGER) AS admit_type_cd,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1
    WHEN o_orderstatus = 'O' THEN CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 6 END
    ELSE CASE o_orderkey % 4 WHEN 0 THEN 20 WHEN 1 THEN 30 WHEN 2 THEN 1 ELSE 99 END END AS discharge_status_cd,
  CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS claim_pmt_amt,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) * CAST(1 + o_orderkey % 5 AS DECIMAL(2,0)) AS DECIMAL(12,2)) AS pass_thru_amt,
  n_lines AS utilization_day_cnt, trim({_code("d1")}) AS admitting_icd9,
  {_join(f"{_code(f'd{k}')} AS ICD9_DGNS_CD_{k}" for k in range(1, 11))},
  {_join(f"{_code(f'p{k}')} AS ICD9_PRCDR_CD_{k}" for k in range(1, 7))}
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = part
), claims AS (
  SELECT claim_id, bene_id, admit_dt, discharge_dt, provider_id, drg_cd, admit_source_cd, admit_type_cd,
  discharge_status_cd, claim_pmt_amt, pass_thru_amt, utilization_day_cnt, admitting_icd9 FROM wide
), rawb AS MATERIALIZED (
  SELECT {_text("CAST(bene_id AS VARCHAR)", "DESYNPUF_ID")},
  {_text(_BAD_DATE.format(k="bene_id", d="birth_dt"), "BENE_BIRTH_DT")},
  strftime(death_dt, '%Y%m%d') AS BENE_DEATH_DT,
  CASE WHEN bene_id % 61 = 0 THEN '3' ELSE CAST(sex_cd AS VARCHAR) END AS BENE_SEX_IDENT_CD,
  CASE WHEN bene_id % 67 = 0 THEN '9' ELSE CAST(race_cd AS VARCHAR) END AS BENE_RACE_CD,
  CAST(hi_coverage_months AS VARCHAR) AS BENE_HI_CVRAGE_TOT_MONS,
  CAST(hmo_coverage_months AS VARCHAR) AS BENE_HMO_CVRAGE_TOT_MONS,
  CAST(medreimb_ip AS VARCHAR) AS MEDREIMB_IP,
  {_join(f"CASE WHEN bene_id % 71 = {i} THEN '5' ELSE CAST({n} AS VARCHAR) END AS {n}" for i, n in enumerate(_FLAGS))}
  FROM patients
), rawc AS MATERIALIZED (
  SELECT CAST(claim_id AS VARCHAR) AS CLM_ID,
  {_text("CASE WHEN claim_id % 499 = 0 THEN '' ELSE CAST(bene_id AS VARCHAR) END", "DESYNPUF_ID")},
  {_text(_BAD_DATE.format(k="claim_id", d="admit_dt"), "CLM_ADMSN_DT")},
  strftime(discharge_dt, '%Y%m%d') AS NCH_BENE_DSCHRG_DT, provider_id AS PRVDR_NUM,
  CASE WHEN claim_id % 59 = 0 THEN 'abc' WHEN claim_id % 61 = 0 THEN '1.5' WHEN claim_id % 67 = 0 THEN '99999'
    WHEN claim_id % 7 = 0 THEN drg_cd || '.0' ELSE CAST(drg_cd AS VARCHAR) END AS CLM_DRG_CD,
  CAST(admit_source_cd AS VARCHAR) AS CLM_ADMSN_SOURCE_CD, CAST(admit_type_cd AS VARCHAR) AS CLM_IP_ADMSN_TYPE_CD,
  CAST(discharge_status_cd AS VARCHAR) AS PTNT_DSCHRG_STUS_CD,
  {_text("CASE WHEN claim_id % 103 = 0 THEN '-' || claim_pmt_amt WHEN claim_id % 107 = 0 THEN 'n/a' ELSE CAST(claim_pmt_amt AS VARCHAR) END", "CLM_PMT_AMT")},
  CAST(pass_thru_amt AS VARCHAR) AS CLM_PASS_THRU_AMT, CAST(utilization_day_cnt AS VARCHAR) AS CLM_UTLZTN_DAY_CNT,
  {_text("admitting_icd9", "ADMTNG_ICD9_DGNS_CD")},
  {_join(f"ICD9_DGNS_CD_{k}" for k in range(1, 11))}, {_join(f"ICD9_PRCDR_CD_{k}" for k in range(1, 7))}
  FROM wide
), typb AS MATERIALIZED (
  SELECT DESYNPUF_ID, {_date("BENE_BIRTH_DT")} AS BENE_BIRTH_DT, {_date("BENE_DEATH_DT")} AS BENE_DEATH_DT,
  {_join(f"{_int(c)} AS {c}" for c in ["BENE_SEX_IDENT_CD", "BENE_RACE_CD", "BENE_HI_CVRAGE_TOT_MONS", "BENE_HMO_CVRAGE_TOT_MONS", *_FLAGS])},
  {_float("MEDREIMB_IP")} AS MEDREIMB_IP FROM rawb
), typc AS MATERIALIZED (
  SELECT CLM_ID, DESYNPUF_ID, {_date("CLM_ADMSN_DT")} AS CLM_ADMSN_DT, {_date("NCH_BENE_DSCHRG_DT")} AS NCH_BENE_DSCHRG_DT,
  PRVDR_NUM, {_join(f"{_int(c)} AS {c}" for c in ["CLM_DRG_CD", "CLM_ADMSN_SOURCE_CD", "CLM_IP_ADMSN_TYPE_CD", "PTNT_DSCHRG_STUS_CD", "CLM_UTLZTN_DAY_CNT"])},
  {_float("CLM_PMT_AMT")} AS CLM_PMT_AMT, {_float("CLM_PASS_THRU_AMT")} AS CLM_PASS_THRU_AMT, ADMTNG_ICD9_DGNS_CD,
  {_join(f"ICD9_DGNS_CD_{k}" for k in range(1, 11))}, {_join(f"ICD9_PRCDR_CD_{k}" for k in range(1, 7))}
  FROM rawc
), elix AS (
  SELECT bene_id, CAST(count(*) AS INTEGER) AS n FROM cond GROUP BY bene_id
), pf AS MATERIALIZED (
  SELECT c.*, CAST(date_part('year', age(c.admit_dt, b.birth_dt)) AS INTEGER) AS age_at_admit,
  CAST(c.discharge_dt - c.admit_dt AS INTEGER) AS los_days,
  CASE WHEN b.death_dt IS NOT NULL AND b.death_dt <= c.discharge_dt + 30 THEN 1 ELSE 0 END AS died_within_30d,
  CAST(coalesce((SELECT n FROM elix e WHERE e.bene_id = c.bene_id), 0) AS INTEGER) AS elixhauser_count,
  CAST((SELECT count(*) FROM claims p WHERE p.bene_id = c.bene_id AND p.admit_dt >= c.admit_dt - 90 AND p.admit_dt < c.admit_dt) AS INTEGER) AS prior_admits_90d,
  CAST((SELECT count(*) FROM claims p WHERE p.bene_id = c.bene_id AND p.admit_dt >= c.admit_dt - 365 AND p.admit_dt < c.admit_dt) AS INTEGER) AS prior_admits_365d,
  CAST((SELECT c.admit_dt - max(p.admit_dt) FROM claims p WHERE p.bene_id = c.bene_id AND p.admit_dt < c.admit_dt) AS INTEGER) AS days_since_last_admit,
  b.sex_cd, b.race_cd, b.hmo_coverage_months, b.hi_coverage_months, b.medreimb_ip, b.death_dt,
  (SELECT min(p.admit_dt) FROM claims p WHERE p.bene_id = c.bene_id
     AND (p.admit_dt > c.admit_dt OR (p.admit_dt = c.admit_dt AND p.claim_id > c.claim_id))) AS next_admit_dt
  FROM claims c JOIN patients b ON b.bene_id = c.bene_id
), lab AS MATERIALIZED (
  SELECT *, CASE WHEN next_admit_dt - discharge_dt BETWEEN 1 AND 30 THEN 1 ELSE 0 END AS readmitted_30d,
  CASE WHEN coalesce(discharge_status_cd, 1) <> 1 THEN 1 ELSE 0 END AS is_not_routine_discharge,
  CASE coalesce(discharge_status_cd, 1) WHEN 1 THEN 0 WHEN 6 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 30 THEN 3 WHEN 20 THEN 4 ELSE 2 END AS discharge_risk_score
  FROM pf
), card AS MATERIALIZED (
  SELECT *, CASE WHEN total < CAST(0.92 AS DOUBLE) THEN total ELSE CAST(0.92 AS DOUBLE) END AS readmission_prob FROM (
    SELECT *, CAST(0.01 AS DOUBLE) + CAST(0.32 AS DOUBLE) * comorbidity + CAST(0.48 AS DOUBLE) * not_routine
      + CAST(0.18 AS DOUBLE) * prior_admits + CAST(0.08 AS DOUBLE) * stay AS total FROM (
      SELECT *, CAST(elixhauser_count AS DOUBLE) / (SELECT greatest(max(n), 1) FROM elix) AS comorbidity,
        CAST(is_not_routine_discharge AS DOUBLE) AS not_routine,
        CAST(CASE WHEN prior_admits_90d > 5 THEN 5 ELSE prior_admits_90d END AS DOUBLE) / 5 AS prior_admits,
        CAST(CASE WHEN coalesce(los_days, 0) > 14 THEN 14 ELSE coalesce(los_days, 0) END AS DOUBLE) / 14 AS stay
      FROM lab))
), scores AS MATERIALIZED (
  SELECT *, CASE WHEN readmission_prob >= CAST(0.30 AS DOUBLE) THEN 'high' WHEN readmission_prob >= CAST(0.15 AS DOUBLE) THEN 'medium' ELSE 'low' END AS risk_tier,
  readmitted_30d AS readmission_label FROM card
)"""

# --- KPI blocks: one aggregate per provider set, unpivoted by UNION ALL ---------

_KPI_SQL = {
    "readmission_rate_30d": "CAST(sum(readmission_label) AS DOUBLE) / count(readmission_label)",
    "high_risk_count": "CAST(count(*) FILTER (WHERE risk_tier = 'high') AS DOUBLE)",
    "high_risk_pct": "CAST(count(*) FILTER (WHERE risk_tier = 'high') AS DOUBLE) * 100 / count(*)",
    "avg_readmit_prob": "avg(readmission_prob)",
    "avg_los_days": "CAST(sum(los_days) AS DOUBLE) / count(los_days)",
    "median_los_days": "median(los_days)",
    "los_vs_national_avg": "CAST(sum(los_days) AS DOUBLE) / count(los_days) - CAST(4.6 AS DOUBLE)",
    "avg_cost_per_admission": "CAST(sum(claim_pmt_amt) AS DOUBLE) / count(claim_pmt_amt)",
    "total_cost": "CAST(sum(claim_pmt_amt) AS DOUBLE)",
    "admission_count": "CAST(count(*) AS DOUBLE)",
    "avg_elixhauser_score": "CAST(sum(elixhauser_count) AS DOUBLE) / count(elixhauser_count)",
    "avg_age_at_admit": "CAST(sum(age_at_admit) AS DOUBLE) / count(age_at_admit)",
}


def _kpi_wide(source: str, snapshot: str) -> str:
    columns = _join(f"{e} AS {n}" for n, e in _KPI_SQL.items())
    return (
        f"SELECT {snapshot} AS snapshot_date, provider_id, {columns} FROM {source} WHERE provider_id IS NOT NULL GROUP BY 1, 2"
        f" UNION ALL SELECT {snapshot} AS snapshot_date, 'ALL' AS provider_id, {columns} FROM {source} GROUP BY 1"
    )


def _kpi_long(wide: str) -> str:
    parts = (
        f"SELECT snapshot_date, provider_id, '{n}' AS metric_name, {n} AS metric_value FROM {wide} WHERE {n} IS NOT NULL"
        for n in _KPI_SQL
    )
    return " UNION ALL ".join(parts)


_HISTORY = (
    f", kw AS MATERIALIZED ({_kpi_wide('scores', 'last_day(admit_dt)')}), kh AS MATERIALIZED ({_kpi_long('kw')}) "
)
_KPI_OUT = f"{_d('snapshot_date', 'snapshot_date')}, provider_id, metric_name, {_r('metric_value', 'metric_value')}"
_AS_OF = "DATE '2001-08-05'"
# Number, condition on the day and the lookback's days.
_LOOKBACKS = ((0, "", "NULL"), (1, f" AND admit_dt > {_AS_OF} - 30", "30"), (2, f" AND admit_dt > {_AS_OF} - 365", "365"))
_SPLIT = "DATE '1998-04-17'"
_CUT = "DATE '2000-01-01'"

_CURVE = """, pts AS (SELECT readmission_prob AS score, count(*) FILTER (WHERE readmitted_30d = 1) AS tp,
  count(*) FILTER (WHERE readmitted_30d = 0) AS fp FROM card GROUP BY 1),
cur AS MATERIALIZED (SELECT score, tp, fp, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp,
  sum(tp) OVER () AS p, sum(fp) OVER () AS n FROM pts WINDOW w AS (ORDER BY score DESC)) """
_AUROC = "sum(fp * (ctp - tp / CAST(2 AS DOUBLE))) / (CAST(max(p) AS DOUBLE) * max(n))"
_AP = "sum(CAST(tp AS DOUBLE) / p * ctp / (ctp + cfp))"
_SENS = """(SELECT tpr FROM (SELECT 0.0 AS tpr, round(abs(CAST(1 AS DOUBLE) - CAST(0.8 AS DOUBLE)), 12) AS dist, 2.0 AS score
  UNION ALL SELECT CAST(ctp AS DOUBLE) / p, round(abs(1 - CAST(cfp AS DOUBLE) / n - CAST(0.8 AS DOUBLE)), 12), score FROM cur) ORDER BY dist, score DESC LIMIT 1)"""
_EDGES = [i * 0.1 for i in range(11)]
_ECE = (
    "(SELECT sum(CASE WHEN bin IS NULL THEN 0 ELSE n * abs(acc - conf) END) / sum(n) FROM (SELECT "
    + "CASE "
    + " ".join(
        f"WHEN readmission_prob >= CAST({_EDGES[i]!r} AS DOUBLE) AND readmission_prob < CAST({_EDGES[i + 1]!r} AS DOUBLE) THEN {i}"
        for i in range(10)
    )
    + " END AS bin, count(*) AS n, avg(readmitted_30d) AS acc, avg(readmission_prob) AS conf FROM card GROUP BY 1))"
)

_AGE_GROUP = (
    "CASE WHEN age_at_admit >= 0 AND age_at_admit < 18 THEN '<18' WHEN age_at_admit >= 18 AND age_at_admit < 35 THEN '18-34' "
    "WHEN age_at_admit >= 35 AND age_at_admit < 50 THEN '35-49' WHEN age_at_admit >= 50 AND age_at_admit < 65 THEN '50-64' "
    "WHEN age_at_admit >= 65 AND age_at_admit < 75 THEN '65-74' WHEN age_at_admit >= 75 AND age_at_admit < 85 THEN '75-84' "
    "WHEN age_at_admit >= 85 AND age_at_admit < 120 THEN '85+' END"
)
_AGE_ORD = (
    "CASE WHEN age_at_admit < 0 OR age_at_admit >= 120 OR age_at_admit IS NULL THEN -1 WHEN age_at_admit < 18 THEN 0 "
    "WHEN age_at_admit < 35 THEN 1 WHEN age_at_admit < 50 THEN 2 WHEN age_at_admit < 65 THEN 3 WHEN age_at_admit < 75 THEN 4 "
    "WHEN age_at_admit < 85 THEN 5 ELSE 6 END"
)
_CALENDAR = {
    "admit_month": "CAST(month(admit_dt) AS INTEGER)",
    "admit_quarter": "CAST(quarter(admit_dt) AS INTEGER)",
    "admit_dow": "CAST(isodow(admit_dt) - 1 AS INTEGER)",
}
_CYCLIC = {
    "admit_month_sin": "sin(2 * pi() * month(admit_dt) / 12)",
    "admit_month_cos": "cos(2 * pi() * month(admit_dt) / 12)",
    "admit_dow_sin": "sin(2 * pi() * (isodow(admit_dt) - 1) / 7)",
    "admit_dow_cos": "cos(2 * pi() * (isodow(admit_dt) - 1) / 7)",
}
_MONEY = {
    "pass_thru_ratio": "CASE WHEN claim_pmt_amt IS NULL OR claim_pmt_amt = 0 OR pass_thru_amt IS NULL THEN 0 ELSE CAST(pass_thru_amt AS DOUBLE) / CAST(claim_pmt_amt AS DOUBLE) END",
    "log_claim_pmt": "ln(1 + CAST(coalesce(claim_pmt_amt, 0) AS DOUBLE))",
}
_USE = {
    "had_prior_admit_90d": "CAST(prior_admits_90d > 0 AS INTEGER)",
    "had_prior_admit_365d": "CAST(prior_admits_365d > 0 AS INTEGER)",
    "is_frequent_flyer": "CAST(prior_admits_365d >= 3 AS INTEGER)",
    "prior_admits_90d_capped": "CASE WHEN prior_admits_90d > 10 THEN 10 ELSE prior_admits_90d END",
    "prior_admits_365d_capped": "CASE WHEN prior_admits_365d > 20 THEN 20 ELSE prior_admits_365d END",
    "los_days_capped": "CASE WHEN los_days IS NULL THEN 0 WHEN los_days > 60 THEN 60 ELSE los_days END",
}
_HAS = {
    f"cond_{c}": f"CAST(EXISTS (SELECT 1 FROM cond x WHERE x.bene_id = t.bene_id AND x.condition_code = '{c}') AS INTEGER)"
    for c in CONDITION_CODES.values()
}
_HEAVY = (
    "CAST(EXISTS (SELECT 1 FROM cond x WHERE x.bene_id = t.bene_id AND x.condition_code IN ("
    + ", ".join(f"'{c}'" for c in HIGH_WEIGHT_CONDITIONS)
    + ")) AS INTEGER)"
)


def _cols(expressions: dict[str, str]) -> str:
    return _join(f"{e} AS {n}" for n, e in expressions.items())


def _rcols(expressions: dict[str, str]) -> str:
    return _join(_r(e, n) for n, e in expressions.items())


def _encoding(source: str) -> str:
    """CTEs ``prior`` and ``enc``: smoothed DRG means over the training side of ``source``."""
    return (
        f", prior AS (SELECT avg(readmitted_30d) AS m FROM {source} WHERE admit_dt < {_SPLIT}), "
        "enc AS (SELECT drg_cd, (1 / (1 + exp(-(count(*) - 20) / CAST(10 AS DOUBLE)))) * avg(readmitted_30d)"
        " + (1 - 1 / (1 + exp(-(count(*) - 20) / CAST(10 AS DOUBLE)))) * (SELECT m FROM prior) AS e"
        f" FROM {source} WHERE admit_dt < {_SPLIT} AND drg_cd IS NOT NULL GROUP BY drg_cd) "
    )


_ENCODED = "coalesce((SELECT e FROM enc WHERE enc.drg_cd = t.drg_cd), (SELECT m FROM prior))"


def _present(table: str, columns: dict[str, str]) -> str:
    """One row per column: count of rows where the condition holds."""
    return " UNION ALL ".join(
        f"SELECT '{table[0]}' AS table_name, '{c}' AS column_name, {e} FROM {table[1]}" for c, e in columns.items()
    )


def _rule_count(name: str, source: str, column: str, check: str, broken: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
        f"CAST(count(*) FILTER (WHERE {broken}) AS BIGINT) AS violations FROM {source}"
    )


def _rule_rows(name: str, source: str, key: str, column: str, check: str, broken: str, value: str | None = None) -> str:
    return (
        f"SELECT '{name}' AS table_name, {key} AS row_key, '{column}' AS column_name, '{check}' AS check_name, "
        f"{value or f'CAST({column} AS VARCHAR)'} AS failure_case FROM {source} WHERE {broken}"
    )


_DOMAINS = [
    ("BENE_SEX_IDENT_CD", "1, 2"),
    ("BENE_RACE_CD", "1, 2, 3, 4, 5, 6"),
    *[(c, "0, 1, 2") for c in _FLAGS],
]
_BENE_RULES = [
    ("DESYNPUF_ID", "not_nullable", "DESYNPUF_ID IS NULL"),
    ("BENE_BIRTH_DT", "not_nullable", "BENE_BIRTH_DT IS NULL"),
    *[(c, f"isin({v})", f"{c} NOT IN ({v})") for c, v in _DOMAINS],
]
_CLAIM_RULES = [
    ("CLM_ID", "not_nullable", "CLM_ID IS NULL"),
    ("DESYNPUF_ID", "not_nullable", "DESYNPUF_ID IS NULL"),
    ("CLM_ADMSN_DT", "not_nullable", "CLM_ADMSN_DT IS NULL"),
    ("CLM_PMT_AMT", "greater_than_or_equal_to(0)", "CLM_PMT_AMT < 0"),
]
_UNION = " UNION ALL "
_AMOUNT_TEXT = "CAST(CLM_PMT_AMT AS VARCHAR)"
_PF_COLUMNS = ["claim_id", "bene_id", "admit_dt", "discharge_dt", "provider_id", "drg_cd", "admit_source_cd",
    "admit_type_cd", "discharge_status_cd", "claim_pmt_amt", "pass_thru_amt", "utilization_day_cnt", "admitting_icd9",
    "age_at_admit", "los_days", "died_within_30d", "elixhauser_count", "prior_admits_90d", "prior_admits_365d",
    "days_since_last_admit", "sex_cd", "race_cd", "hmo_coverage_months", "hi_coverage_months", "medreimb_ip", "death_dt"]
_DATES = {"admit_dt", "discharge_dt", "death_dt", "birth_dt"}
_AMOUNTS = {"claim_pmt_amt", "pass_thru_amt", "medreimb_ip", "readmission_prob"}


def _plain(columns, alias: str = "") -> str:
    """Columns in comparable types: text dates, double amounts."""
    out = []
    for c in columns:
        source = f"{alias}{c}"
        out.append(_d(source, c) if c in _DATES else _r(source, c) if c in _AMOUNTS else f"{source} AS {c}")
    return _join(out, ", ")


_TIER_PCT = ", ".join(
    _r(f"avg(CASE WHEN risk_tier = '{t}' THEN 1.0 ELSE 0 END) * 100", f"{t}_pct") for t in ("high", "medium", "low")
)
_PROVIDERS = (
    f"SELECT provider_id, count(*) AS admission_count, {_TIER_PCT}, {_r('avg(readmission_label)', 'readmission_rate')}, "
    f"{_r('avg(los_days)', 'avg_los')} FROM scores WHERE provider_id IS NOT NULL GROUP BY provider_id "
    "ORDER BY count(*) DESC, provider_id"
)
_NORM_B = (
    ("DESYNPUF_ID", "bene_id", None), ("BENE_BIRTH_DT", "birth_dt", "d"), ("BENE_DEATH_DT", "death_dt", "d"),
    ("BENE_SEX_IDENT_CD", "sex_cd", None), ("BENE_RACE_CD", "race_cd", None),
    ("BENE_HI_CVRAGE_TOT_MONS", "hi_coverage_months", None), ("BENE_HMO_CVRAGE_TOT_MONS", "hmo_coverage_months", None),
    ("MEDREIMB_IP", "medreimb_ip", "r"),
)
_NORM_C = (
    ("CLM_ID", "claim_id", None), ("DESYNPUF_ID", "bene_id", None), ("CLM_ADMSN_DT", "admit_dt", "d"),
    ("NCH_BENE_DSCHRG_DT", "discharge_dt", "d"), ("PRVDR_NUM", "provider_id", None), ("CLM_DRG_CD", "drg_cd", None),
    ("CLM_ADMSN_SOURCE_CD", "admit_source_cd", None), ("CLM_IP_ADMSN_TYPE_CD", "admit_type_cd", None),
    ("PTNT_DSCHRG_STUS_CD", "discharge_status_cd", None), ("CLM_PMT_AMT", "claim_pmt_amt", "r"),
    ("CLM_PASS_THRU_AMT", "pass_thru_amt", "r"), ("CLM_UTLZTN_DAY_CNT", "utilization_day_cnt", None),
    ("ADMTNG_ICD9_DGNS_CD", "admitting_icd9", None),
)


def _normalized(spec) -> str:
    return _join(
        (_d(raw, n) if k == "d" else _r(f"CAST({raw} AS DECIMAL(12,2))", n) if k == "r" else f"{raw} AS {n}" for raw, n, k in spec), ", "
    )


def _codes(prefix: str, count: int, name: str) -> str:
    return _UNION.join(
        f"SELECT CLM_ID AS claim_id, CAST({k} AS INTEGER) AS seq_num, trim({prefix}{k}) AS {name} FROM typc WHERE length(trim({prefix}{k})) > 0"
        for k in range(1, count + 1)
    )


_HASH = "md5(CAST(claim_id AS VARCHAR) || ':42')"
_STRATA = (
    f"SELECT claim_id, readmitted_30d, row_number() OVER (PARTITION BY readmitted_30d ORDER BY {_HASH}, claim_id) AS rk, "
    "count(*) OVER (PARTITION BY readmitted_30d) AS sz FROM lab"
)
_PARTS = ("comorbidity", "not_routine", "prior_admits", "stay")
_WEIGHTS = (0.32, 0.48, 0.18, 0.08)
_LIN = ", ".join(
    f"CAST({w} AS DOUBLE) * ({n} - avg({n}) OVER ()) AS a_{n}" for n, w in zip(_PARTS, _WEIGHTS)
)
_DRIFT = f""", mon AS (SELECT last_day(admit_dt) AS run, avg(readmission_prob) AS mean_prob,
  avg(CASE WHEN readmission_prob >= CAST(0.3 AS DOUBLE) THEN 1.0 ELSE 0 END) * 100 AS pct_high_risk
  FROM card WHERE admit_dt >= {_SPLIT} GROUP BY 1),
base AS (SELECT avg(readmission_prob) AS mean_prob, avg(CASE WHEN readmission_prob >= CAST(0.3 AS DOUBLE) THEN 1.0 ELSE 0 END) * 100 AS pct_high_risk
  FROM card WHERE admit_dt < {_SPLIT}),
chk AS (SELECT run, 'mean_prob' AS check_name, b.mean_prob AS baseline_value, m.mean_prob AS current_value,
  abs(m.mean_prob - b.mean_prob) AS shift, CAST(0.01 AS DOUBLE) AS threshold FROM mon m, base b
  UNION ALL SELECT run, 'pct_high_risk', b.pct_high_risk, m.pct_high_risk, abs(m.pct_high_risk - b.pct_high_risk), CAST(1.0 AS DOUBLE) FROM mon m, base b) """
_SPIKE_COLUMNS = ("days_since_last_admit", "discharge_status_cd", "los_days", "provider_id", "death_dt")

_MATRIX = {
    "age_at_admit": "age_at_admit", "age_group_ord": _AGE_ORD, "is_female": "CASE WHEN sex_cd = 2 THEN 1 ELSE 0 END",
    "race_cd": "race_cd", "admit_source_cd": "admit_source_cd", "admit_type_cd": "admit_type_cd",
    "discharge_status_cd": "discharge_status_cd", "is_not_routine_discharge": "is_not_routine_discharge",
    "discharge_risk_score": "discharge_risk_score", **_CALENDAR, **_CYCLIC, "elixhauser_count": "elixhauser_count",
    "prior_admits_90d_capped": _USE["prior_admits_90d_capped"], "prior_admits_365d_capped": _USE["prior_admits_365d_capped"],
    "had_prior_admit_90d": _USE["had_prior_admit_90d"], "had_prior_admit_365d": _USE["had_prior_admit_365d"],
    "is_frequent_flyer": _USE["is_frequent_flyer"], "los_days_capped": _USE["los_days_capped"],
    "days_since_last_admit": "days_since_last_admit", **{k: _MONEY[k] for k in ("log_claim_pmt", "pass_thru_ratio")},
    "hmo_coverage_months": "hmo_coverage_months",
}
_PIPE_CONDS = ("chf", "diabetes", "copd", "chronic_kidney", "cancer", "ischemic_heart", "stroke_tia", "depression")
_DOUBLES = set(_CYCLIC) | set(_MONEY)
_ISO = """, g AS (SELECT round(readmission_prob, 6) AS score, count(*) AS n, sum(readmitted_30d) AS y FROM card GROUP BY 1),
o AS (SELECT score, n, row_number() OVER (ORDER BY score) AS i, sum(n) OVER (ORDER BY score) AS cn, sum(y) OVER (ORDER BY score) AS cy FROM g),
pr AS (SELECT a.i AS j, b.i AS k, CAST(b.cy - coalesce(z.cy, 0) AS DOUBLE) / (b.cn - coalesce(z.cn, 0)) AS m
  FROM o a JOIN o b ON b.i >= a.i LEFT JOIN o z ON z.i = a.i - 1),
mn AS (SELECT j, k, min(m) OVER (PARTITION BY j ORDER BY k DESC) AS low FROM pr),
fit AS (SELECT k AS i, max(low) AS v FROM mn GROUP BY k) """

# What every fitted model must satisfy on each test row.
_MODEL_CHECKS = (
    "attributions_add_up", "gbt_is_the_sigmoid", "leafwise_is_the_sigmoid", "blend_is_the_mean", "calibrated_is_a_share",
    "calibrated_rises", "logistic_gradient_is_zero",
)

_BODIES: dict[str, str] = {
    # ingest
    "union_extracts": "SELECT c_name AS DESYNPUF_ID, round(c_acctbal, 6) + 0.0 AS MEDREIMB_IP, c_mktsegment AS SEGMENT FROM customer "
    "UNION ALL SELECT s_name, round(s_acctbal, 6) + 0.0, NULL FROM supplier",
    "dedup_keep_first": f"SELECT l_orderkey, {_d('l_shipdate', 'l_shipdate')}, l_linenumber, l_partkey, l_suppkey, {_r('l_extendedprice', 'l_extendedprice')} FROM "
    "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1",
    "parse_dates": f"SELECT CLM_ID, {_d('CLM_ADMSN_DT', 'CLM_ADMSN_DT')}, {_d('NCH_BENE_DSCHRG_DT', 'NCH_BENE_DSCHRG_DT')} FROM typc",
    "coerce_int": "SELECT CLM_ID, CLM_DRG_CD, PTNT_DSCHRG_STUS_CD, CLM_UTLZTN_DAY_CNT FROM typc",
    "coerce_float": f"SELECT CLM_ID, {_r('CLM_PMT_AMT', 'CLM_PMT_AMT')}, {_r('CLM_PASS_THRU_AMT', 'CLM_PASS_THRU_AMT')} FROM typc",
    # quality
    "critical_nulls": _UNION.join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM {s}"
        for t, s, columns in (
            ("beneficiaries", "typb", ("DESYNPUF_ID", "BENE_BIRTH_DT")),
            ("inpatient", "typc", ("DESYNPUF_ID", "CLM_ID", "CLM_ADMSN_DT")),
        )
        for c in columns
    ),
    "null_rate_violations": "SELECT 'inpatient' AS table_name, 'CLM_DSCHRGDT' AS column_name, CAST(NULL AS DOUBLE) AS null_rate, CAST(0.05 AS DOUBLE) AS max_rate, 'skipped' AS status "
    + "".join(
        f"UNION ALL SELECT 'inpatient', '{c}', round(r, 6) + 0.0, CAST({t} AS DOUBLE), CASE WHEN r > CAST({t} AS DOUBLE) THEN 'violation' ELSE 'ok' END "
        f"FROM (SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM typc) "
        for c, t in (("CLM_PMT_AMT", 0.01), ("CLM_DRG_CD", 0.10))
    ),
    "cast_failures": _UNION.join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count(*) FILTER (WHERE r.{c} IS NOT NULL AND x.{c} IS NULL) AS BIGINT) AS failures FROM {raw} r JOIN {typ} x ON r.{k} = x.{k}"
        for t, raw, typ, k, columns in (
            ("beneficiaries", "rawb", "typb", "DESYNPUF_ID", ("BENE_BIRTH_DT", "BENE_SEX_IDENT_CD")),
            (
                "inpatient", "rawc", "typc", "CLM_ID",
                ("CLM_ADMSN_DT", "NCH_BENE_DSCHRG_DT", "CLM_DRG_CD", "PTNT_DSCHRG_STUS_CD", "CLM_UTLZTN_DAY_CNT", "CLM_PMT_AMT", "CLM_PASS_THRU_AMT"),
            ),
        )
        for c in columns
    ),
    "duplicate_keys": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_r('l_quantity', 'l_quantity')} FROM "
    "(SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1",
    "domain_violations": _UNION.join(_rule_count("beneficiaries", "typb", *r) for r in _BENE_RULES if r[1].startswith("isin")),
    "bound_violations": _UNION.join(_rule_count("inpatient", "typc", *r) for r in _CLAIM_RULES),
    "range_violations": _UNION.join(
        [
            _rule_count("inpatient", "typc", "CLM_PMT_AMT", "in_range(0.0, 10000000.0)", "CLM_PMT_AMT < 0 OR CLM_PMT_AMT > 10000000"),
            _rule_count("patient_features", "pf", "age_at_admit", "in_range(0.0, 120.0)", "age_at_admit < 0 OR age_at_admit > 120"),
            _rule_count("patient_features", "pf", "los_days", "in_range(0.0, 730.0)", "los_days < 0 OR los_days > 730"),
        ]
    ),
    "failure_cases": _UNION.join(
        [_rule_rows("beneficiaries", "typb", "DESYNPUF_ID", *r) for r in _BENE_RULES]
        + [_rule_rows("inpatient", "typc", "CLM_ID", *r) for r in _CLAIM_RULES]
    ),
    "fk_orphans": "SELECT 'claims_to_beneficiaries' AS relation, CAST(count(*) AS BIGINT) AS orphan_rows, count(DISTINCT DESYNPUF_ID) AS orphan_keys FROM typc c "
    "WHERE DESYNPUF_ID IS NOT NULL AND NOT EXISTS (SELECT 1 FROM typb b WHERE b.DESYNPUF_ID = c.DESYNPUF_ID AND b.BENE_BIRTH_DT IS NOT NULL) "
    f"UNION ALL SELECT 'diagnoses_to_claims', CAST(count(*) AS BIGINT), count(DISTINCT claim_id) FROM ({_codes('ICD9_DGNS_CD_', 10, 'icd9_code')}) d "
    "WHERE claim_id NOT IN (SELECT CLM_ID FROM typc WHERE CLM_ADMSN_DT IS NOT NULL AND DESYNPUF_ID IS NOT NULL)",
    "validation_summary": "SELECT 'beneficiaries' AS table_name, CAST(count(*) AS BIGINT) AS rows, 0 AS violations, "
    f"CAST({' + '.join(f'count(*) FILTER (WHERE {b})' for _, _, b in _BENE_RULES)} AS BIGINT) AS schema_errors, "
    f"CAST({' + '.join(f'count(*) FILTER (WHERE {b})' for _, _, b in _BENE_RULES)} = 0 AS INTEGER) AS passed FROM typb "
    "UNION ALL SELECT 'inpatient', CAST(rows AS BIGINT), v, e, CAST(v = 0 AND e = 0 AS INTEGER) FROM (SELECT count(*) AS rows, "
    "CAST(count(*) - count(CLM_PMT_AMT) > count(*) * CAST(0.01 AS DOUBLE) AS INTEGER) + CAST(count(*) - count(CLM_DRG_CD) > count(*) * CAST(0.10 AS DOUBLE) AS INTEGER) AS v, "
    f"CAST({' + '.join(f'count(*) FILTER (WHERE {b})' for _, _, b in _CLAIM_RULES)} AS BIGINT) AS e FROM typc)",
    # normalisation
    "norm_beneficiaries": f"SELECT {_normalized(_NORM_B)} FROM typb",
    "norm_claims": f"SELECT {_normalized(_NORM_C)} FROM typc",
    "unpivot_conditions": _UNION.join(
        f"SELECT DESYNPUF_ID AS bene_id, '{c}' AS condition_code, {n} AS indicator FROM typb WHERE {n} IN (1, 2)" for n, c in CONDITION_CODES.items()
    ),
    "unpivot_diagnoses": _codes("ICD9_DGNS_CD_", 10, "icd9_code"),
    "unpivot_procedures": _codes("ICD9_PRCDR_CD_", 6, "icd9_prcdr_code"),
    # history
    "age_at_admit": "SELECT claim_id, age_at_admit FROM pf",
    "elixhauser_count": "SELECT bene_id, n AS elixhauser_count FROM elix",
    "prior_admits": "SELECT claim_id, prior_admits_90d, prior_admits_365d FROM pf",
    "days_since_last": "SELECT claim_id, days_since_last_admit FROM pf",
    "patient_features": f"SELECT {_plain(_PF_COLUMNS)} FROM pf",
    "kpi_input": f"SELECT claim_id, bene_id, risk_tier, {_r('readmission_prob', 'readmission_prob')}, readmission_label, {_d('admit_dt', 'scored_at')}, "
    f"provider_id, {_plain(['admit_dt', 'discharge_dt', 'claim_pmt_amt'])}, drg_cd, age_at_admit, los_days, elixhauser_count FROM scores",
    # feature transforms
    "age_bins": f"SELECT claim_id, age_at_admit, {_AGE_GROUP} AS age_group, {_AGE_ORD} AS age_group_ord FROM pf",
    "sex_flag": "SELECT bene_id, sex_cd, CASE WHEN sex_cd = 2 THEN 1 ELSE 0 END AS is_female FROM patients",
    "admit_calendar": f"SELECT claim_id, {_cols(_CALENDAR)} FROM claims",
    "admit_cyclic": f"SELECT claim_id, {_rcols(_CYCLIC)} FROM claims",
    "financial_ratios": f"SELECT claim_id, {_rcols(_MONEY)} FROM claims",
    "utilization_flags": f"SELECT claim_id, {_cols(_USE)} FROM pf",
    "discharge_risk": "SELECT claim_id, discharge_status_cd, is_not_routine_discharge, discharge_risk_score FROM lab",
    "comorbidity_pivot": f"SELECT claim_id, {_cols(_HAS)}, {_HEAVY} AS has_high_weight_comorbidity FROM claims t",
    "model_matrix": f"SELECT claim_id, {_join(_r(f'coalesce(CAST({e} AS DOUBLE), -1)', n) for n, e in _MATRIX.items())} FROM lab",
    "feature_pipeline": _encoding("lab")
    + f"SELECT claim_id, bene_id, {_d('admit_dt', 'admit_dt')}, provider_id, {_r(_ENCODED, 'drg_cd_encoded')}, "
    + _join(_r(e, n) if n in _DOUBLES else f"{e} AS {n}" for n, e in _MATRIX.items())
    + f", {_join(f'{_HAS[f"cond_{c}"]} AS cond_{c}' for c in _PIPE_CONDS)}, {_HEAVY} AS has_high_weight_comorbidity, readmitted_30d, "
    + f"{_r('ln(1 + CASE WHEN coalesce(los_days, 0) < 0 THEN 0 ELSE coalesce(los_days, 0) END)', 'los_days_log')}, "
    + "CASE WHEN CAST(claim_pmt_amt AS DOUBLE) >= (SELECT quantile_cont(CAST(claim_pmt_amt AS DOUBLE), 0.8) FROM claims) THEN 1 ELSE 0 END AS is_high_cost, "
    + f"CASE WHEN admit_dt < {_SPLIT} THEN 'train' ELSE 'test' END AS side FROM lab t",
    # labels
    "readmission_label": "SELECT claim_id, readmitted_30d FROM lab",
    "readmission_rate": f"SELECT {_r('avg(readmitted_30d)', 'readmission_rate')} FROM lab",
    "label_los": f"SELECT claim_id, {_r('ln(1 + coalesce(los_days, 0))', 'los_days_log')} FROM pf",
    "label_high_cost": "SELECT claim_id, CASE WHEN CAST(claim_pmt_amt AS DOUBLE) >= th THEN 1 ELSE 0 END AS is_high_cost, round(th, 6) + 0.0 AS threshold "
    "FROM claims, (SELECT quantile_cont(CAST(claim_pmt_amt AS DOUBLE), 0.8) AS th FROM claims)",
    "temporal_split": f"SELECT CASE WHEN admit_dt < {_SPLIT} THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows, {_r('avg(readmitted_30d)', 'positive_rate')} FROM lab GROUP BY 1",
    "target_encode": _encoding("lab") + f"SELECT claim_id, drg_cd, {_r(_ENCODED, 'drg_cd_encoded')} FROM lab t",
    "target_encode_text": ", labt AS (SELECT *, 'patient-' || CAST(CAST(bene_id AS BIGINT) * 100003 AS VARCHAR) AS category FROM lab)"
    + _encoding("labt").replace("drg_cd", "category")
    + f"SELECT claim_id, category, {_r(_ENCODED.replace('drg_cd', 'category'), 'encoded')} FROM labt t",
    "quantile_by_month": "SELECT CAST(year(admit_dt) AS INTEGER) AS year, CAST(month(admit_dt) AS INTEGER) AS month, "
    + f"{_r('quantile_cont(CAST(claim_pmt_amt AS DOUBLE), 0.8)', 'value')} FROM claims GROUP BY 1, 2",
    "stratified_holdout": f"SELECT claim_id, readmitted_30d, CAST(rk <= floor(sz * CAST(0.2 AS DOUBLE)) AS INTEGER) AS is_holdout FROM ({_STRATA})",
    "stratified_folds": f"SELECT claim_id, readmitted_30d, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM ({_STRATA})",
    "class_weights": "SELECT count(*) FILTER (WHERE readmitted_30d = 0) AS negatives, count(*) FILTER (WHERE readmitted_30d = 1) AS positives, "
    "round(CAST(count(*) FILTER (WHERE readmitted_30d = 0) AS DOUBLE) / greatest(count(*) FILTER (WHERE readmitted_30d = 1), 1), 6) + 0.0 AS positive_weight FROM lab",
    # evaluation
    "auroc": _CURVE + f"SELECT {_r(_AUROC, 'auroc')} FROM cur",
    "average_precision": _CURVE + f"SELECT {_r(_AP, 'average_precision')} FROM cur",
    "brier": f"SELECT {_r('avg((readmission_prob - readmitted_30d) * (readmission_prob - readmitted_30d))', 'brier')} FROM card",
    "sens_at_spec": _CURVE + f"SELECT {_r(_SENS, 'sens_at_spec')}",
    "ece": f"SELECT {_r(_ECE, 'ece')}",
    "roc_curve": _CURVE + "SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr UNION ALL "
    f"SELECT {_r('score', 'threshold')}, {_r('CAST(cfp AS DOUBLE) / n', 'fpr')}, {_r('CAST(ctp AS DOUBLE) / p', 'tpr')} FROM cur",
    "calibration_table": f"SELECT CAST({' + '.join(f'CAST(readmission_prob > CAST({e!r} AS DOUBLE) AS INTEGER)' for e in _EDGES[1:-1])} AS INTEGER) AS bin, count(*) AS n, "
    f"{_r('avg(readmission_prob)', 'mean_predicted')}, {_r('avg(readmitted_30d)', 'fraction_positive')} FROM card GROUP BY 1",
    "evaluate": _CURVE + "SELECT 'scorecard' AS model, (SELECT count(*) FROM card) AS n_samples, "
    f"{_r('(SELECT avg(readmitted_30d) FROM card)', 'positive_rate')}, round({_AUROC}, 4) AS auroc, round({_AP}, 4) AS auprc, "
    "round((SELECT avg((readmission_prob - readmitted_30d) * (readmission_prob - readmitted_30d)) FROM card), 4) AS brier_score, "
    f"round({_SENS}, 4) AS sensitivity_at_80pct_specificity, round({_ECE}, 4) AS expected_calibration_error FROM cur",
    "regression_metrics": "SELECT 'month_rule' AS model, round(avg(abs(y - f)), 3) AS mae_days, round(sqrt(avg((y - f) * (y - f))), 3) AS rmse_days, "
    "round(1 - avg((y - f) * (y - f)) / var_pop(y), 4) AS r2, round(avg(abs((y - f) / (y + 1e-6))) * 100, 2) AS mape_pct "
    "FROM (SELECT CAST(coalesce(los_days, 0) AS DOUBLE) AS y, CAST(month(admit_dt) AS DOUBLE) AS f FROM pf)",
    "soft_vote": _encoding("card") + f"SELECT claim_id, round(b, 6) + 0.0 AS blend, CAST(b >= CAST(0.5 AS DOUBLE) AS INTEGER) AS vote FROM "
    f"(SELECT claim_id, CAST(0.5 AS DOUBLE) * readmission_prob + CAST(0.5 AS DOUBLE) * {_ENCODED} AS b FROM card t)",
    "isotonic_calibrate": _ISO + f"SELECT {_r('o.score', 'score')}, n AS cases, {_r('fit.v', 'calibrated')} FROM o JOIN fit ON fit.i = o.i",
    # explanation
    "top3_linear": f", lin AS (SELECT claim_id, {_LIN} FROM card), lng AS ("
    + _UNION.join(f"SELECT claim_id, '{n}' AS f, round(abs(a_{n}), 12) AS a FROM lin" for n in _PARTS)
    + "), rkd AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY a DESC, f) AS rn FROM lng) "
    + "SELECT claim_id, "
    + ", ".join(f"max(CASE WHEN rn = {i} THEN f END) AS top_{i}" for i in (1, 2, 3))
    + " FROM rkd GROUP BY claim_id",
    "global_top": f", lin AS (SELECT claim_id, {_LIN} FROM card) SELECT feature, round(mean_abs, 6) + 0.0 AS mean_abs FROM ("
    + _UNION.join(f"SELECT '{n}' AS feature, avg(abs(a_{n})) AS mean_abs FROM lin" for n in _PARTS)
    + ") ORDER BY round(mean_abs, 12) DESC, feature LIMIT 3",
    "attribution_sample": f"SELECT claim_id, bene_id FROM claims ORDER BY {_HASH}, claim_id LIMIT 1000",
    # scoring and drift
    "scorecard": f"SELECT claim_id, {_r('readmission_prob', 'readmission_prob')} FROM card",
    "risk_tiers": f"SELECT claim_id, {_r('readmission_prob', 'readmission_prob')}, risk_tier FROM scores",
    "tier_shares": "SELECT risk_tier, count(*) AS claims, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM scores), 6) + 0.0 AS pct FROM scores GROUP BY risk_tier",
    "score_baseline": f"SELECT {_r('avg(readmission_prob)', 'mean_prob')}, {_r('avg(CASE WHEN readmission_prob >= CAST(0.3 AS DOUBLE) THEN 1.0 ELSE 0 END) * 100', 'pct_high_risk')} FROM card WHERE admit_dt < {_SPLIT}",
    "drift_checks": _DRIFT + f"SELECT {_d('run', 'run')}, check_name, {_r('baseline_value', 'baseline_value')}, {_r('current_value', 'current_value')}, "
    f"{_r('shift', 'shift')}, threshold, CAST(shift > threshold AS INTEGER) AS breached FROM chk",
    "null_spike": "SELECT column_name, round(b, 6) + 0.0 AS baseline_rate, round(c, 6) + 0.0 AS current_rate, round(c - b, 6) + 0.0 AS rise, CAST(c - b > CAST(0.1 AS DOUBLE) AS INTEGER) AS breached FROM ("
    + _UNION.join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FILTER (WHERE admit_dt < {_SPLIT}) AS b, "
        f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FILTER (WHERE admit_dt >= {_SPLIT}) AS c FROM pf"
        for c in _SPIKE_COLUMNS
    )
    + ")",
    "freshness_check": _HISTORY + f"SELECT {_d('max(snapshot_date)', 'last_snapshot')}, {_d(_AS_OF, 'as_of')}, CAST(max(snapshot_date) < {_AS_OF} - 2 AS INTEGER) AS stale FROM kh",
    "open_alerts": _HISTORY.rstrip() + _DRIFT + ", al AS (SELECT 'score_drift' AS alert_type, CASE check_name WHEN 'mean_prob' THEN "
    "printf('Score drift detected: mean prob shifted %.4f (baseline=%.4f, current=%.4f)', shift, baseline_value, current_value) ELSE "
    "printf('High-risk %% drift: %.1fpp shift (baseline=%.1f%%, current=%.1f%%)', shift, baseline_value, current_value) END AS message, run AS created_at "
    f"FROM chk WHERE shift > threshold UNION ALL SELECT 'stale_kpi', 'KPI snapshots not updated in 48+ hours. Last snapshot: ' || max(snapshot_date), {_AS_OF} "
    f"FROM kh WHERE snapshot_date < {_CUT} HAVING max(snapshot_date) < {_AS_OF} - 2) "
    f"SELECT alert_type, message, {_d('created_at', 'created_at')}, CASE WHEN alert_type LIKE '%drift%' THEN 'danger' ELSE 'warning' END AS style "
    "FROM al WHERE al.created_at >= DATE '2001-01-01' ORDER BY al.created_at DESC, alert_type, message LIMIT 10",
    # tables and views
    "insert_ignore": f"SELECT claim_id, CASE WHEN admit_dt < {_CUT} THEN provider_id ELSE 'LATE' END AS provider_id, {_plain(['admit_dt', 'claim_pmt_amt'])} FROM claims",
    "kpi_upsert": f", o1 AS ({_kpi_wide(f'(SELECT * FROM scores WHERE admit_dt < {_CUT})', 'last_day(admit_dt)')}), "
    f"n1 AS ({_kpi_wide(f'(SELECT * FROM scores WHERE admit_dt >= {_SPLIT})', 'last_day(admit_dt)')}), "
    f"ol AS ({_kpi_long('o1')}), nl AS ({_kpi_long('n1')}) "
    f"SELECT {_KPI_OUT} FROM (SELECT * FROM nl UNION ALL SELECT ol.* FROM ol WHERE NOT EXISTS (SELECT 1 FROM nl WHERE nl.snapshot_date = ol.snapshot_date "
    "AND nl.provider_id = ol.provider_id AND nl.metric_name = ol.metric_name))",
    "risk_score_upsert": f"SELECT claim_id, bene_id, CASE WHEN again THEN '2001-08-05' ELSE CAST(admit_dt AS VARCHAR) END AS scored_at, CASE WHEN again THEN 'v2' ELSE 'v1' END AS model_version, "
    f"{_r('p', 'readmission_prob')}, CASE WHEN p >= CAST(0.3 AS DOUBLE) THEN 'high' WHEN p >= CAST(0.15 AS DOUBLE) THEN 'medium' ELSE 'low' END AS risk_tier, "
    f"CASE WHEN admit_dt < {_CUT} THEN readmitted_30d ELSE 1 - readmitted_30d END AS readmission_label FROM "
    f"(SELECT *, admit_dt >= {_SPLIT} AS again, CASE WHEN admit_dt >= {_SPLIT} THEN readmission_prob / 2 ELSE readmission_prob END AS p FROM card)",
    "ensure_columns": f"SELECT claim_id, {_r('readmission_prob', 'readmission_prob')}, CAST(NULL AS VARCHAR) AS model_run_id, CAST(NULL AS DOUBLE) AS readmit_prob_ci_lower, CAST(NULL AS DOUBLE) AS readmit_prob_ci_upper FROM scores",
    "export_risk_scores": f"SELECT claim_id, bene_id, {_d('admit_dt', 'score_date')}, 'v1' AS model_version, {_r('readmission_prob', 'readmission_prob')}, risk_tier, readmission_label, provider_id, "
    f"{_plain(['admit_dt', 'discharge_dt', 'los_days', 'age_at_admit', 'sex_cd', 'race_cd', 'elixhauser_count', 'prior_admits_90d', 'claim_pmt_amt'])} FROM scores",
    "export_kpi": _HISTORY + f"SELECT {_KPI_OUT} FROM kh",
    "export_features": "SELECT "
    + _plain(
        ["claim_id", "bene_id", "provider_id", "admit_dt", "discharge_dt", "los_days", "age_at_admit", "sex_cd", "race_cd", "drg_cd",
         "admit_type_cd", "discharge_status_cd", "elixhauser_count", "prior_admits_90d", "prior_admits_365d", "days_since_last_admit",
         "claim_pmt_amt", "died_within_30d", "hmo_coverage_months"]
    )
    + " FROM pf",
    "v_kpi_readmission": _HISTORY + f"SELECT {_d('snapshot_date', 'snapshot_date')}, provider_id, {_r('metric_value', 'readmission_rate')} FROM kh WHERE metric_name = 'readmission_rate_30d'",
    "v_kpi_avg_los": _HISTORY + f"SELECT {_d('snapshot_date', 'snapshot_date')}, provider_id, {_r('metric_value', 'avg_los_days')} FROM kh WHERE metric_name = 'avg_los_days'",
    "v_risk_summary": f"SELECT {_d('date_trunc(' + chr(39) + 'month' + chr(39) + ', admit_dt)', 'month')}, risk_tier, count(*) AS patient_count, {_r('avg(readmission_prob)', 'avg_readmit_prob')} FROM scores GROUP BY 1, 2",
    "model_checks": f"SELECT (SELECT count(*) FROM lab WHERE admit_dt >= {_SPLIT}) AS rows, check_name, CAST(0 AS BIGINT) AS failures FROM (VALUES "
    + ", ".join(f"('{c}')" for c in _MODEL_CHECKS)
    + ") v(check_name)",
    # KPIs and report
    "kpi_snapshot": f", kw AS ({_kpi_wide('scores', _AS_OF)}), kh AS ({_kpi_long('kw')}) SELECT {_KPI_OUT} FROM kh",
    "kpi_rollup": f", kw AS ({_kpi_wide('scores', _AS_OF)}) SELECT {_d('snapshot_date', 'snapshot_date')}, provider_id, {_join(_r(n, n) for n in _KPI_SQL)} FROM kw",
    "kpi_latest": _HISTORY + f"SELECT metric_name, {_r('metric_value', 'metric_value')} FROM kh WHERE provider_id = 'ALL' AND snapshot_date = (SELECT max(snapshot_date) FROM kh)",
    "kpi_lookback": f", kw AS ({_kpi_wide(f'(SELECT * FROM scores WHERE admit_dt > {_AS_OF} - 30 AND admit_dt <= {_AS_OF})', _AS_OF)}), kh AS ({_kpi_long('kw')}) SELECT {_KPI_OUT} FROM kh",
    "kpi_from_days": ", " + ", ".join(f"kd{n} AS ({_kpi_wide(f'(SELECT * FROM scores WHERE admit_dt <= {_AS_OF}{w})', _AS_OF)})" for n, w, _ in _LOOKBACKS)
    + " SELECT " + f"{_d('snapshot_date', 'snapshot_date')}, provider_id, {_join(_r(n, n) for n in _KPI_SQL if n != 'median_los_days')}, days FROM ("
    + " UNION ALL ".join(f"SELECT *, CAST({days} AS INTEGER) AS days FROM kd{n}" for n, _, days in _LOOKBACKS) + ")",
    "features_by_batches": f"SELECT {_plain(['claim_id', 'bene_id', 'admit_dt', 'age_at_admit', 'los_days', 'died_within_30d', 'elixhauser_count', 'prior_admits_90d', 'prior_admits_365d', 'days_since_last_admit'])} FROM pf",
    "provider_table": _PROVIDERS + " LIMIT 20",
    "tier_chart_data": f"SELECT provider_id, high_pct, medium_pct, low_pct FROM ({_PROVIDERS} LIMIT 10)",
    "kpi_status": _HISTORY + f"SELECT {_KPI_OUT}, CASE WHEN metric_name = 'readmission_rate_30d' THEN CASE WHEN metric_value > CAST(0.15 AS DOUBLE) THEN 'danger' WHEN metric_value > CAST(0.11 AS DOUBLE) THEN 'warn' ELSE 'good' END "
    "WHEN metric_name = 'high_risk_pct' THEN CASE WHEN metric_value > 30 THEN 'warn' ELSE 'good' END "
    "WHEN metric_name = 'los_vs_national_avg' THEN CASE WHEN metric_value > 1 THEN 'warn' WHEN metric_value < -1 THEN 'good' ELSE 'neutral' END ELSE 'neutral' END AS status FROM kh",
    "trend_readmission": _HISTORY + f"SELECT {_d('snapshot_date', 'snapshot_date')}, {_r('metric_value', 'metric_value')} FROM kh WHERE metric_name = 'readmission_rate_30d' AND provider_id = 'ALL'",
    "cost_by_drg": f"SELECT drg_cd, count(*) AS admissions, {_r('avg(CAST(claim_pmt_amt AS DOUBLE))', 'avg_cost')} FROM claims GROUP BY drg_cd",
    "tier_by_provider": "SELECT provider_id, " + ", ".join(f"count(*) FILTER (WHERE risk_tier = '{t}') AS {t}_claims" for t in ("high", "medium", "low")) + " FROM scores GROUP BY provider_id",
    "readmit_by_age": f"SELECT {_AGE_GROUP} AS age_group, count(*) AS admissions, {_r('avg(readmitted_30d)', 'readmission_rate')} FROM lab GROUP BY 1",
    "dow_heatmap": "SELECT CAST(isodow(admit_dt) - 1 AS INTEGER) AS admit_dow, CAST(month(admit_dt) AS INTEGER) AS admit_month, count(*) AS admissions FROM claims GROUP BY 1, 2",
}

ORACLE_SQL: dict[str, str] = {
    name: _PREFIX + (body if body.startswith(",") else "\n" + body) for name, body in _BODIES.items()
}
