"""CSV members of ZIP archives as a data source: one partition per member, streamed.

A member's bytes are inflated as they are read and leave the task in bounded Arrow batches,
so neither an archive nor a member is ever held in memory, whatever its size, and one member
is read once. A deflated member cannot be split; members are read side by side.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from wardline.sources.files import open_stream
from wardline.sources.records import whole_records, without_return

ENCODING = "latin-1"
RECORDS_PER_BATCH = 10_000
SOURCE = "wardline_zip_records"


def member_records(path: str, member: str) -> Iterator[str]:
    """Records of one member, inflated on the way."""
    with open_stream(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(member) as raw:
        lines = io.TextIOWrapper(raw, encoding=ENCODING, newline="\n")
        yield from map(without_return, whole_records(line.removesuffix("\n") for line in lines))


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with open_stream(path) as stream, zipfile.ZipFile(stream) as archive:
                names = [n for n in archive.namelist() if n.lower().endswith(".csv")]
            rows = [(path, n, k, next(member_records(path, n), "")) for k, n in enumerate(names)]
            yield pd.DataFrame(rows or [(path, None, 0, "")], columns=["path", "member", "place", "header"])


def csv_members(spark: SparkSession, paths: list[str]) -> list:
    """``path, member, place, header`` of the CSV members of all archives, in their order.

    Reads the archives' directories and the members' first records. An archive without a
    CSV member has one row with a null member.
    """
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths), "path")
    found = listed.mapInPandas(_describe, "path string, member string, place int, header string")
    return found.orderBy("path", "place").collect()  # one row per member


@dataclass
class Member(InputPartition):
    path: str
    name: str


class ZipRecordReader(DataSourceReader):
    def __init__(self, members: list[tuple[str, str]]):
        self.members = members

    def partitions(self) -> list[Member]:
        return [Member(path, name) for path, name in self.members]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str]] = []

        def batch() -> pa.RecordBatch:
            columns = [
                pa.array([partition.path] * len(held), pa.string()), pa.array([partition.name] * len(held), pa.string()),
                pa.array([n for n, _ in held], pa.int64()), pa.array([r for _, r in held], pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["path", "member", "number", "record"])

        for number, record in enumerate(member_records(partition.path, partition.name)):
            if number and record:  # behind the header
                held.append((number - 1, record))
            if len(held) == RECORDS_PER_BATCH:
                yield batch()
                held = []
        if held:
            yield batch()


class ZipRecords(DataSource):
    """``path, member, number, record`` of the members given by the option ``members``, a
    JSON list of (path, member); headers and blank lines are left out."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "path string, member string, number bigint, record string"

    def reader(self, schema) -> ZipRecordReader:
        return ZipRecordReader([tuple(m) for m in json.loads(self.options["members"])])


def read_members(spark: SparkSession, members: list[tuple[str, str]]) -> DataFrame:
    """Records of these members, a task for each."""
    spark.dataSource.register(ZipRecords)
    return spark.read.format(SOURCE).option("members", json.dumps(members)).load().where(F.length("record") > 0)
