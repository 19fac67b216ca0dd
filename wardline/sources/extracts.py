"""Raw extracts: CSV files and zipped CSV files, every column read as text.

Files are listed through Spark's own file source, so any Hadoop-compatible path
works. Headers are found in one pass over all files; reading is grouped by distinct
header: one scan per header, not per file.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wardline.functions.coerce import (
    coerce_floats,
    coerce_ints,
    missing_texts_to_null,
    parse_dates,
)
from wardline.operators.store import first_per_key
from wardline.sources.archives import csv_members, read_members
from wardline.sources.columns import (
    BENEFICIARY_COLUMNS,
    BENEFICIARY_INTS,
    CLAIM_COLUMNS,
    CLAIM_INTS,
    raw_columns,
)
from wardline.sources.files import file_digests
from wardline.sources.records import file_key, layout, read_records

FILE_COL, BLOCK_COL, LINE_COL = "_file", "_block", "_line"
POSITION_COLS = (FILE_COL, BLOCK_COL, LINE_COL)


@dataclass(frozen=True)
class ClaimsExtract:
    """Typed beneficiaries and inpatient claims."""

    beneficiaries: DataFrame
    inpatient: DataFrame


def _text_schema(columns: Iterable[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def list_files(spark: SparkSession, directory: str, suffix: str) -> list[str]:
    """Paths of the files in ``directory`` with this suffix, in name order.

    The file source prunes ``content``, so this lists and does not read.
    """
    listed = spark.read.format("binaryFile").load(directory).select("path").collect()
    return sorted(r.path for r in listed if r.path.lower().endswith(suffix))


def _named(paths: Iterable[str], word: str) -> list[str]:
    return [p for p in paths if word in p.rsplit("/", 1)[-1].lower()]


def _by_header(headers: dict[Any, tuple]) -> dict[tuple, list]:
    groups: dict[tuple, list] = {}
    for path, header in headers.items():
        groups.setdefault(header, []).append(path)
    return groups


def union_extracts(frames: list[DataFrame]) -> DataFrame:
    """Stack extracts; columns absent from one of them are null there."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def column_names(header: str) -> tuple[str, ...]:
    """Names in a header record; nameless and repeated ones take their place as well."""
    names = next(csv.reader(io.StringIO(header, newline="")), [])
    return tuple(f"{n}{k}" if names.count(n) > 1 else n or f"_c{k}" for k, n in enumerate(names))


def _parsed(records: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """Records as text columns with their positions."""
    row = F.from_csv("record", F.lit(_text_schema(header).toDDL()), {"escape": '"'})
    name = F.element_at(F.split("path", "/"), -1)
    return records.select(
        row.alias("row"), name.alias(FILE_COL), F.col("block").alias(BLOCK_COL), F.col("number").alias(LINE_COL)
    ).select("row.*", *POSITION_COLS)


def read_csv_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV files as text columns plus the position of each row in its file.

    Quoted fields may hold line breaks; files are split all the same.
    """
    found = layout(spark, paths)
    headers = {p: column_names(found.headers.get(file_key(p), "")) for p in paths}
    frames = [_parsed(read_records(spark, group, found), header) for header, group in _by_header(headers).items()]
    return missing_texts_to_null(union_extracts(frames))


def read_zip_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """First CSV of each ZIP archive as text columns plus row positions."""
    members = [m for m in csv_members(spark, paths) if m.place == 0]
    without = [m.path for m in members if m.member is None]
    if without:
        raise ValueError(f"archive without a CSV member: {', '.join(without)}")
    chosen = {(m.path, m.member): column_names(m.header) for m in members}
    frames = []
    for header, group in _by_header(chosen).items():
        records = read_members(spark, group).withColumn("block", F.lit(0).cast("bigint"))
        frames.append(_parsed(records, header))
    return missing_texts_to_null(union_extracts(frames))


def type_beneficiaries(raw: DataFrame) -> DataFrame:
    """Text beneficiary columns to dates, whole numbers and amounts, where present."""
    df = parse_dates(raw, raw_columns(BENEFICIARY_COLUMNS, "date"))
    df = coerce_ints(df, BENEFICIARY_INTS)
    return coerce_floats(df, raw_columns(BENEFICIARY_COLUMNS, "decimal"))


def type_inpatient(raw: DataFrame) -> DataFrame:
    """Text claim columns to dates, whole numbers and amounts, where present."""
    df = parse_dates(raw, raw_columns(CLAIM_COLUMNS, "date"))
    df = coerce_ints(df, CLAIM_INTS)
    return coerce_floats(df, raw_columns(CLAIM_COLUMNS, "decimal"))


def _keep_first(df: DataFrame, key: str) -> DataFrame:
    return first_per_key(df, [key], [F.col(c) for c in POSITION_COLS]).drop(*POSITION_COLS)


def read_raw_extracts(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Text rows of (beneficiaries, inpatient) of a directory; CSV files beat ZIPs."""
    csvs, zips = list_files(spark, directory, ".csv"), list_files(spark, directory, ".zip")
    if not csvs and not zips:
        raise FileNotFoundError(f"{directory} holds neither CSV files nor ZIP archives")
    paths, read, kind = (csvs, read_csv_text, "CSV") if csvs else (zips, read_zip_text, "ZIP")
    frames = []
    for word, what in (("bene", "beneficiary"), ("inpatient", "inpatient")):
        group = _named(paths, word)
        if not group:
            raise FileNotFoundError(f"{directory} holds no {kind} of {what} rows")
        frames.append(read(spark, group))
    return frames[0], frames[1]


def first_of_each(beneficiaries: DataFrame, inpatient: DataFrame) -> ClaimsExtract:
    """Typed rows with their positions, reduced to the first row of each key."""
    return ClaimsExtract(_keep_first(beneficiaries, "DESYNPUF_ID"), _keep_first(inpatient, "CLM_ID"))


def load_extracts(spark: SparkSession, directory: str) -> ClaimsExtract:
    """Read, type and de-duplicate (first row per key) all extracts of a directory."""
    beneficiaries, inpatient = read_raw_extracts(spark, directory)
    return first_of_each(type_beneficiaries(beneficiaries), type_inpatient(inpatient))


def verify_checksums(spark: SparkSession, directory: str, manifest: DataFrame) -> DataFrame:
    """SHA-256 of each raw file, of any size, against ``manifest(file_name, sha256)``.

    ``status`` is ``ok``, ``mismatch``, or ``skipped`` for files not in the manifest.
    """
    name: Column = F.element_at(F.split("path", "/"), -1)
    actual = file_digests(spark, directory).select(name.alias("file_name"), "actual_sha256")
    return actual.join(manifest, "file_name", "left").select(
        "file_name",
        "actual_sha256",
        F.col("sha256").alias("expected_sha256"),
        F.when(F.col("sha256").isNull(), "skipped")
        .when(F.lower("sha256") == F.col("actual_sha256"), "ok")
        .otherwise("mismatch")
        .alias("status"),
    )
