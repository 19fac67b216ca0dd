"""Byte streams of files, read where they lie: local or shared folders and object stores."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
# Spark's names for stores that the client library calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfs"}


def open_stream(path: str) -> BinaryIO:
    """A seekable stream of a file that Spark listed."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else path, "rb")
    scheme = SCHEMES.get(parts.scheme, parts.scheme)
    system, inner = arrow_fs.FileSystem.from_uri(parts._replace(scheme=scheme).geturl())
    return system.open_input_file(inner)


def digest(stream: BinaryIO, chunk: int = CHUNK_BYTES) -> str:
    """SHA-256 of a stream, a chunk at a time."""
    found = hashlib.sha256()
    while part := stream.read(chunk):
        found.update(part)
    return found.hexdigest()


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with open_stream(path) as stream:
                yield pd.DataFrame({"path": [path], "actual_sha256": [digest(stream)]})


def file_digests(spark: SparkSession, directory: str) -> DataFrame:
    """``path, actual_sha256`` of each file in a directory, of any size, one task per file.

    The listing prunes the content; the bytes stream through the task.
    """
    listed = spark.read.format("binaryFile").load(directory).select("path")
    count = listed.count()
    # One file per task: a large one does not wait behind others.
    spread = listed.repartition(max(count, 1), F.col("path")) if count else listed
    return spread.mapInPandas(_digests, "path string, actual_sha256 string")
