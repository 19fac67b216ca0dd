"""Validation of typed extracts: nulls, types, keys, domains, ranges.

Row-level rules are evaluated together in one pass: each row carries an array of
the rules it breaks, which is exploded to long failure rows or counted. Key rules
(uniqueness, references) pre-aggregate before they shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.operators.store import write_json
from wardline.sources.columns import CONDITION_CODES


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for rows that violate the rule on ``column``."""

    column: str
    check: str
    broken: Column


def not_null(column: str) -> Rule:
    return Rule(column, "not_nullable", F.col(column).isNull())


def in_set(column: str, allowed: Sequence) -> Rule:
    broken = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
    return Rule(column, f"isin({', '.join(str(a) for a in allowed)})", broken)


def at_least(column: str, bound: float) -> Rule:
    return Rule(column, f"greater_than_or_equal_to({bound})", F.coalesce(F.col(column) < bound, F.lit(False)))


def in_range(column: str, low: float, high: float) -> Rule:
    broken = F.coalesce(~F.col(column).between(low, high), F.lit(False))
    return Rule(column, f"in_range({low}, {high})", broken)


def beneficiary_rules() -> list[Rule]:
    # Allowed codes of the beneficiary contract.
    return [
        not_null("DESYNPUF_ID"),
        not_null("BENE_BIRTH_DT"),
        in_set("BENE_SEX_IDENT_CD", [1, 2]),
        in_set("BENE_RACE_CD", [1, 2, 3, 4, 5, 6]),
        *[in_set(c, [0, 1, 2]) for c in CONDITION_CODES],
    ]


def inpatient_rules() -> list[Rule]:
    return [
        not_null("CLM_ID"),
        not_null("DESYNPUF_ID"),
        not_null("CLM_ADMSN_DT"),
        at_least("CLM_PMT_AMT", 0),
    ]


# Column types of the contracts (text keys, dates, whole numbers, amounts).
BENEFICIARY_TYPES = {
    "DESYNPUF_ID": "string",
    "BENE_BIRTH_DT": "date",
    "BENE_DEATH_DT": "date",
    "BENE_SEX_IDENT_CD": "int",
    "BENE_RACE_CD": "int",
    **{c: "int" for c in CONDITION_CODES},
}
INPATIENT_TYPES = {
    "CLM_ID": "string",
    "DESYNPUF_ID": "string",
    "CLM_ADMSN_DT": "date",
    "NCH_BENE_DSCHRG_DT": "date",
    "CLM_PMT_AMT": "double",
    "CLM_DRG_CD": "int",
    "PTNT_DSCHRG_STUS_CD": "int",
}


def present(rules: Sequence[Rule], df: DataFrame) -> list[Rule]:
    return [r for r in rules if r.column in df.columns]


def schema_mismatches(schema: StructType, contract: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """Contract columns that are absent or of another type: (column, check, found)."""
    found = {f.name: f.dataType.simpleString() for f in schema.fields}
    problems = []
    for column, wanted in contract.items():
        if column not in found:
            problems.append((column, "column_in_dataframe", "absent"))
        elif found[column] != wanted:
            problems.append((column, f"dtype({wanted})", found[column]))
    return problems


# --- critical columns and null rates -------------------------------------------


def critical_null_counts(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """``table_name, column_name, null_count`` of the critical columns, one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "null_count")
    return long.select(F.lit(table).alias("table_name"), "column_name", "null_count")


def check_critical(df: DataFrame, columns: Sequence[str], table: str) -> None:
    """Raise ValueError if a critical column is missing or holds a null."""
    for column in columns:
        if column not in df.columns:
            raise ValueError(f"[{table}] Critical column '{column}' not found in DataFrame")
    for row in critical_null_counts(df, columns, table).collect():
        if row.null_count > 0:
            raise ValueError(
                f"[{table}] Critical column '{row.column_name}' has {row.null_count} null values"
            )


def null_rates(df: DataFrame, thresholds: Mapping[str, float], table: str) -> DataFrame:
    """Null rate per column against its threshold: ``ok``, ``violation`` or ``skipped``."""
    columns = [c for c in thresholds if c in df.columns]
    rate = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]
    absent = [c for c in thresholds if c not in df.columns]
    rate += [F.lit(None).cast("double").alias(c) for c in absent]
    long = df.agg(F.count("*").alias("rows"), *rate).drop("rows")
    long = long.unpivot([], list(thresholds), "column_name", "null_rate")
    limits = [part for c, t in thresholds.items() for part in (F.lit(c), F.lit(float(t)))]
    limit = F.create_map(*limits)[F.col("column_name")]
    status = (
        F.when(F.col("column_name").isin(*absent), "skipped")
        .when(F.col("null_rate") > limit, "violation")
        .otherwise("ok")
    )
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "null_rate",
        limit.alias("max_rate"),
        status.alias("status"),
    )


def check_null_rates(df: DataFrame, thresholds: Mapping[str, float], table: str) -> dict[str, float]:
    """``{column: rate}`` of the columns above their threshold."""
    rows = null_rates(df, thresholds, table).where(F.col("status") == "violation").collect()
    return {r.column_name: r.null_rate for r in rows}


# --- keys and references -------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated keys with the number of rows that carry them."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    same = [df[k].eqNullSafe(F.col(f"dup_{k}")) for k in keys]
    repeated = duplicate_keys(df, keys).select(*[F.col(k).alias(f"dup_{k}") for k in keys])
    return df.join(repeated, same, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def orphan_summary(pairs: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """``relation, orphan_rows, orphan_keys`` for (name, child, parent, key)."""
    parts = []
    for name, child, parent, key in pairs:
        per_key = orphans(child, parent, key).groupBy(key).agg(F.count("*").alias("rows"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
                F.count("*").alias("orphan_keys"),
            ).select(F.lit(name).alias("relation"), "orphan_rows", "orphan_keys")
        )
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary


# --- rule evaluation -----------------------------------------------------------


def cast_failures(raw: DataFrame, convert, columns: Sequence[str], table: str) -> DataFrame:
    """Count of texts that were present but did not convert, per column, one scan.

    ``convert`` maps the raw frame to the typed frame with the same column names.
    """
    kept = [c for c in columns if c in raw.columns]
    typed = convert(raw.withColumns({f"raw_{c}": F.col(c) for c in kept}))
    counts = typed.agg(
        *[F.count_if(F.col(f"raw_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in kept]
    )
    long = counts.unpivot([], kept, "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), "column_name", "failures")


def violation_counts(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """``table_name, column_name, check_name, violations`` for every rule, one scan."""
    kept = present(rules, df)
    counted = df.agg(*[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(kept)])
    entries = F.array(
        *[
            F.struct(
                F.lit(r.column).alias("column_name"),
                F.lit(r.check).alias("check_name"),
                F.col(f"r{i}").alias("violations"),
            )
            for i, r in enumerate(kept)
        ]
    )
    return counted.select(F.inline(entries)).select(F.lit(table).alias("table_name"), "*")


def failure_cases(df: DataFrame, rules: Sequence[Rule], key: str, table: str) -> DataFrame:
    """One long row per broken rule: the key, the column, the check and the value."""
    entries = F.array(
        *[
            F.when(
                r.broken,
                F.struct(
                    F.lit(r.column).alias("column_name"),
                    F.lit(r.check).alias("check_name"),
                    F.col(r.column).cast("string").alias("failure_case"),
                ),
            )
            for r in present(rules, df)
        ]
    )
    broken = df.select(F.col(key).cast("string").alias("row_key"), F.inline(F.array_compact(entries)))
    return broken.select(F.lit(table).alias("table_name"), "*")


def duplicate_failures(df: DataFrame, key: str, table: str) -> DataFrame:
    """Failure rows of the uniqueness rule: one for each row that repeats a key."""
    rows = duplicate_rows(df.where(F.col(key).isNotNull()), [key])
    text = F.col(key).cast("string")
    return rows.select(
        F.lit(table).alias("table_name"),
        text.alias("row_key"),
        F.lit(key).alias("column_name"),
        F.lit("field_uniqueness").alias("check_name"),
        text.alias("failure_case"),
    )


def failure_view(failures: DataFrame, limit: int = 50) -> DataFrame:
    """The first failures in a fixed order, for a report page."""
    order = ["table_name", "column_name", "check_name", "row_key", "failure_case"]
    return failures.orderBy(*order).limit(limit)


def table_summary(
    df: DataFrame,
    rules: Sequence[Rule],
    contract: Mapping[str, str],
    thresholds: Mapping[str, float],
    key: str,
    table: str,
) -> DataFrame:
    """One row: rows, null-rate violations, schema errors and whether the table passes."""
    limits = {c: t for c, t in thresholds.items() if c in df.columns}
    kept = present(rules, df)
    broken = sum((r.broken.cast("int") for r in kept), F.lit(0))
    # Per key first: the repeats of a key are counted without collecting its rows.
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"),
        F.sum(broken).alias("broken"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(limits)],
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("broken"),
        F.coalesce(F.sum(F.when((F.col("n") > 1) & F.col(key).isNotNull(), F.col("n"))), F.lit(0)).alias("repeated"),
        *[F.sum(f"null_{i}").alias(f"null_{i}") for i in range(len(limits))],
    )
    over = [
        F.coalesce(F.col(f"null_{i}") > F.col("rows") * t, F.lit(False)).cast("int")
        for i, t in enumerate(limits.values())
    ]
    violations = sum(over, F.lit(0))
    errors = F.col("broken") + F.col("repeated") + len(schema_mismatches(df.schema, contract))
    return totals.select(
        F.lit(table).alias("table_name"),
        "rows",
        violations.alias("violations"),
        errors.alias("schema_errors"),
        ((violations == 0) & (errors == 0)).alias("passed"),
    )


def write_validation_report(summary: DataFrame, failures: DataFrame, path: str) -> bool:
    """Write summary and failure rows as JSON; returns whether every table passed."""
    write_json(summary, f"{path}/summary")
    write_json(failures, f"{path}/failures")
    return summary.where(~F.col("passed")).isEmpty()
