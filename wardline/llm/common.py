"""Shared pieces of the text operators: reading, bounded slices, shipped resources."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of the contracts: runs without ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Maps the other ASCII white space to a space, so that str.split(" ") finds those words.
_SPACES = {c: " " for c in range(0x09, 0x0E)}
_LOWER = {c: chr(c + 32) for c in range(ord("A"), ord("Z") + 1)}
SLICE_BYTES = 4 << 20
# Where a worker needs many times the text that it handles at once.
SMALL_SLICE_BYTES = 1 << 20

_RESOURCES: dict[tuple[str, str], Any] = {}
# Gives the C library's unused heap back to the system, where it can (glibc).
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", lambda keep: 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for a null id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % modulus == remainder, F.lit(False))


def words(text: str) -> list[str]:
    """Words in the sense of ``WORD_PATTERN``; other Unicode spaces belong to words."""
    if "\n" in text or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text:
        text = text.translate(_SPACES)
    found = text.split(" ")
    return [w for w in found if w] if "" in found else found


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that no slice of several rows holds over ``limit`` bytes of text.

    Between batches and after the last one, unused memory goes back: workers live on after a
    stage, and their heaps would keep what its largest slice took. A task begins with giving
    back what the worker's earlier tasks of other kinds left.
    """
    for number, batch in enumerate(batches):
        if number or TaskContext.get():
            give_back()
        else:
            _TRIM(0)
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
    give_back()


def give_back() -> None:
    """Return memory that Arrow and the C library hold unused."""
    pa.default_memory_pool().release_unused()
    _TRIM(0)


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Values of a text column, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


class Shipped:
    """A small file, read once on the driver and sent to the executors in a broadcast.

    Executors need no local copy. ``build`` makes the object from the bytes, once per
    Python worker.
    """

    LIMIT = 64 << 20

    def __init__(self, spark: SparkSession, path: str, build: Callable[[bytes], Any]):
        with open(path, "rb") as file:
            content = file.read()
        if len(content) > self.LIMIT:
            raise ValueError(f"{path}: {len(content)} bytes are too many to ship")
        self.build, self.digest = build, hashlib.sha256(content).hexdigest()
        self.content = spark.sparkContext.broadcast(content)

    def get(self) -> Any:
        key = (self.build.__qualname__, self.digest)
        if key not in _RESOURCES:
            _RESOURCES[key] = self.build(self.content.value)
        return _RESOURCES[key]

    def __getstate__(self):
        return {"build": self.build, "digest": self.digest, "content": self.content}


def array(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


def text_list(texts: pa.Array) -> list[str]:
    """Values of texts without null; much faster than ``to_pylist``."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class Split:
    """Texts cut into parts: distinct parts, the part of each position, rows' offsets."""

    def __init__(self, texts: pa.Array, separator: str):
        lists = pc.split_pattern(texts, separator)
        coded = lists.flatten().dictionary_encode()
        self.dictionary: pa.Array = coded.dictionary
        self.index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.offsets = offsets - offsets[0]

    @cached_property
    def parts(self) -> list[str]:
        return text_list(self.dictionary)

    def without_first(self) -> Split:
        """Drop the first part of each text, in place."""
        keep = np.ones(len(self.index), bool)
        keep[self.offsets[:-1]] = False
        self.index = self.index[keep]
        self.offsets = self.offsets - np.arange(len(self.offsets))
        return self

    def without_empty(self) -> Split:
        """Drop empty parts, in place."""
        empty = pc.index(self.dictionary, "").as_py()
        if empty >= 0:
            keep = self.index != empty
            kept = np.concatenate([[0], np.cumsum(keep)])
            self.index, self.offsets = self.index[keep], kept[self.offsets]
        return self


def text_array(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def split_words(texts: pa.Array) -> Split:
    """``WORD_PATTERN`` words of each text."""
    for space in "\t\n\x0b\x0c\r":
        if pc.any(pc.match_substring(texts, space)).as_py():
            texts = pc.replace_substring(texts, space, " ")
    return Split(texts, " ").without_empty()


def spread(lengths: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a flat array of runs with ``lengths``, run after run in ``index`` order,
    and where each run ends in the result."""
    starts = np.cumsum(lengths) - lengths
    taken = lengths[index]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts[index] - (ends - taken), taken) + np.arange(total), ends
