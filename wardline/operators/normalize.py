"""Wide raw extracts to warehouse tables: renames and long code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.operators.store import ensure_columns
from wardline.sources.columns import (
    BENEFICIARY_COLUMNS,
    CLAIM_COLUMNS,
    CONDITION_CODES,
    DIAGNOSIS_PREFIX,
    PROCEDURE_PREFIX,
)


def _rename_available(df: DataFrame, spec: dict) -> DataFrame:
    return df.select(
        *[
            F.col(raw).try_cast(kind).alias(name)
            for raw, (name, kind) in spec.items()
            if raw in df.columns
        ]
    )


def normalize_beneficiaries(typed: DataFrame) -> DataFrame:
    return _rename_available(typed, BENEFICIARY_COLUMNS)


def normalize_claims(typed: DataFrame) -> DataFrame:
    return _rename_available(typed, CLAIM_COLUMNS)


def with_all_columns(df: DataFrame, spec: dict) -> DataFrame:
    """A normalized table with every warehouse column of ``spec``, absent ones as nulls."""
    wanted = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in spec.values()))
    return ensure_columns(df, wanted).select(*[name for name, _ in spec.values()])


def long_conditions(wide: DataFrame, key: str = "DESYNPUF_ID") -> DataFrame:
    """One row per patient and flagged condition: ``bene_id, condition_code, indicator``."""
    flags = [c for c in CONDITION_CODES if c in wide.columns]
    if not flags:
        empty = F.lit(None)
        return wide.select(
            F.col(key).alias("bene_id"),
            empty.cast("string").alias("condition_code"),
            empty.cast("int").alias("indicator"),
        ).where(F.lit(False))
    entries = F.array(
        *[
            F.struct(F.lit(CONDITION_CODES[c]).alias("condition_code"),
                     F.col(c).cast("int").alias("indicator"))
            for c in flags
        ]
    )
    return wide.select(F.col(key).alias("bene_id"), F.inline(entries)).where(
        F.col("indicator").isin(1, 2)
    )


def long_codes(wide: DataFrame, prefix: str, code_name: str, key: str = "CLM_ID") -> DataFrame:
    """Unpivot numbered code columns; blanks go, ``seq_num`` keeps the column position."""
    columns = [c for c in wide.columns if c.startswith(prefix)]
    if not columns:
        return wide.select(
            F.col(key).alias("claim_id"),
            F.lit(None).cast("int").alias("seq_num"),
            F.lit(None).cast("string").alias(code_name),
        ).where(F.lit(False))
    exploded = wide.select(
        F.col(key).alias("claim_id"), F.posexplode(F.array(*columns)).alias("position", "code")
    )
    code = F.trim("code")
    return exploded.where(F.length(code) > 0).select(
        "claim_id", (F.col("position") + 1).alias("seq_num"), code.alias(code_name)
    )


def long_diagnoses(wide: DataFrame) -> DataFrame:
    return long_codes(wide, DIAGNOSIS_PREFIX, "icd9_code")


def long_procedures(wide: DataFrame) -> DataFrame:
    return long_codes(wide, PROCEDURE_PREFIX, "icd9_prcdr_code")
