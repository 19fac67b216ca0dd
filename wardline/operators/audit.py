"""Checks that ride on the write of a typed extract.

Whatever can be judged row by row (nulls, texts that did not convert, codes outside their
set, values outside their range, amounts too large for the warehouse) is counted by metrics
that Spark collects while the checkpoint is written: the raw text is parsed once. What needs
other rows (repeated keys, keys without a parent) is counted from the typed checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline.operators.quality import Rule, in_range, orphan_summary
from wardline.operators.store import publish

CHECKS = (
    "table_name string, column_name string, check_name string, checked bigint, failures bigint, percent double,"
    " max_percent double, status string"
)
OK, VIOLATION, SKIPPED = "ok", "violation", "skipped"
# The warehouse's amounts are decimal(12, 2).
AMOUNT_LIMIT = 10.0**10


@dataclass(frozen=True)
class Contract:
    """What is expected of one typed extract.

    ``casts`` are the columns that are converted from text; ``null_limits`` the largest
    share of nulls by column; ``ranges`` bounds by column; ``amounts`` the columns that must
    fit the warehouse's amounts.
    """

    table: str
    key: str
    casts: Sequence[str] = ()
    critical: Sequence[str] = ()
    null_limits: Mapping[str, float] = field(default_factory=dict)
    rules: Sequence[Rule] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    amounts: Sequence[str] = ()


def _raw(column: str) -> str:
    return f"raw__{column}"


def check_row(table: str, column: str, check: str, checked: int, failures: int | None, limit: float = 0.0) -> tuple:
    """One row of ``CHECKS``; without ``failures`` the check was skipped."""
    if failures is None:
        return (table, column, check, checked, None, None, 100.0 * limit, SKIPPED)
    percent = 100.0 * failures / checked if checked else 0.0
    status = VIOLATION if failures > limit * checked else OK
    return (table, column, check, checked, failures, percent, 100.0 * limit, status)


def planned_checks(contract: Contract, columns: Sequence[str]) -> list[tuple[str, str, Column | None, float]]:
    """(column, check, failing rows, largest share allowed); no condition for absent columns."""
    have, null = set(columns), "null_rate"
    plan: list[tuple[str, str, Column | None, float]] = []
    for name in contract.critical:
        plan.append((name, "critical_null", F.col(name).isNull() if name in have else None, 0.0))
    for name, limit in contract.null_limits.items():
        plan.append((name, null, F.col(name).isNull() if name in have else None, float(limit)))
    for name in contract.casts:
        if name in have:
            plan.append((name, "conversion", F.col(_raw(name)).isNotNull() & F.col(name).isNull(), 0.0))
    rules = [*contract.rules, *[in_range(c, *bounds) for c, bounds in contract.ranges.items()]]
    for rule in rules:
        if rule.column in have:
            plan.append((rule.column, rule.check, rule.broken, 0.0))
    for name in contract.amounts:
        if name in have:
            too_large = F.coalesce(F.abs(F.round(F.col(name).cast("double"), 2)) >= AMOUNT_LIMIT, F.lit(False))
            plan.append((name, "fits_decimal(12,2)", too_large, 0.0))
    return plan


def write_audited(raw: DataFrame, convert: Callable[[DataFrame], DataFrame], contract: Contract, root: str) -> tuple[DataFrame, list[tuple]]:
    """Write ``convert(raw)`` as the next version at ``root``; the typed table and its checks.

    The checks are counted during the write. A task that is repeated after the loss of an
    executor is counted once; only where Spark repeats a finished write stage as a whole may
    counts be higher.
    """
    kept = [c for c in contract.casts if c in raw.columns]
    typed = convert(raw.withColumns({_raw(c): F.col(c) for c in kept}) if kept else raw)
    plan = planned_checks(contract, [c for c in typed.columns if not c.startswith(_raw(""))])
    counted = [F.count_if(bad).alias(f"c{k}") for k, (_, _, bad, _) in enumerate(plan) if bad is not None]
    seen = Observation(f"{contract.table}-{uuid.uuid4().hex}")
    watched = typed.observe(seen, F.count("*").alias("rows"), *counted).drop(*[_raw(c) for c in kept])
    path = publish(watched, root)
    found = seen.get
    rows = [
        check_row(contract.table, name, check, found["rows"], None if bad is None else found[f"c{k}"], limit)
        for k, (name, check, bad, limit) in enumerate(plan)
    ]
    written = raw.sparkSession.read.schema(watched.schema).parquet(path)
    return written, rows


def key_checks(typed: DataFrame, contract: Contract) -> list[tuple]:
    """Rows that repeat a key, counted per key first."""
    per_key = typed.where(F.col(contract.key).isNotNull()).groupBy(contract.key).agg(F.count("*").alias("n"))
    checked, repeated = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    ).first()
    return [check_row(contract.table, contract.key, "field_uniqueness", checked, repeated)]


def reference_checks(child: DataFrame, parent: DataFrame, key: str, table: str, parent_table: str) -> list[tuple]:
    """Child rows whose key has no parent."""
    found = orphan_summary([(table, child, parent, key)]).first()
    return [check_row(table, key, f"references({parent_table})", child.count(), found.orphan_rows)]


def checks_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), CHECKS)


def contract_ranges(ranges: Mapping[str, Sequence[float]], columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Configured bounds of the columns that an extract has."""
    return {c: (float(b[0]), float(b[1])) for c, b in ranges.items() if c in columns}

