"""Records of CSV text whose quoted fields may hold line breaks, read in splits.

A line ends either between records or inside a quoted field. What a line does to that
state depends only on the state before it, so each split of a file is a function from
``outside``/``inside`` to ``outside``/``inside``. One pass finds these functions; composed
along a file's splits (one row per split) they say which splits begin inside
a field, and in which split that record began. The second pass then cuts every split into
whole records on its own; only the pieces of records that cross a split meet in a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A line whose quoted fields all close in it, apart from text behind a closing quote.
_WHOLE = re.compile(r'(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*')
_CLOSE = re.compile(r'(?:[^"]|"")*"(?!")')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open behind the line.

    A quote opens a field only at its start; inside, two quotes are one character.
    """
    if '"' not in line:
        return inside
    if not inside and _WHOLE.fullmatch(line):
        return False
    at = 0
    while True:
        if inside:
            closed = _CLOSE.match(line, at)
            if closed is None:
                return True
            at, inside = closed.end(), False
        elif line.startswith('"', at):
            at, inside = at + 1, True
            continue
        comma = line.find(",", at)
        if comma < 0:
            return False
        at = comma + 1


def whole_records(lines: Iterable[str]) -> Iterator[str]:
    """Lines of one stream joined to records; what is open at its end is the last one."""
    held: list[str] = []
    inside = False
    for line in lines:
        inside = ends_inside(line, inside)
        held.append(line)
        if not inside:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def without_return(record: str) -> str:
    return record[:-1] if record.endswith("\r") else record


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines in file order with their file and the start of their split."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """Runs of lines of one split within each batch."""
    for batch in batches:
        paths, blocks = batch.column("path"), batch.column("block")
        start = 0
        while start < batch.num_rows:
            path, block = paths[start].as_py(), blocks[start].as_py()
            same = pc.and_(pc.equal(paths.slice(start), path), pc.equal(blocks.slice(start), block))
            change = pc.index(same, False).as_py()
            size = batch.num_rows - start if change < 0 else change
            yield path, block, batch.column("value").slice(start, size)
            start += size


_SPLIT = "path string, block bigint, from_outside boolean, from_inside boolean, opens boolean, header string"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: the state behind it from either state before it, whether a record
    that is open behind it began in it (from outside; from inside if it closes first), and
    the first record of a file."""
    current, row, header = None, {}, None

    def finished() -> pa.RecordBatch:
        row["header"] = "\n".join(header) if header is not None else None
        return pa.RecordBatch.from_pylist([row], schema=_SPLIT_ARROW)

    for path, block, values in _by_split(batches):
        if (path, block) != current:
            if current is not None:
                yield finished()
            current = (path, block)
            row = {"path": path, "block": block, "from_outside": False, "from_inside": True, "opens": False}
            header, heading = ([], True) if block == 0 else (None, False)
        quoted = pc.indices_nonzero(pc.match_substring(values, '"')).to_pylist()
        if block == 0 and heading:
            for line in values.to_pylist():
                header.append(line)
                if not ends_inside("\n".join(header), False):
                    heading = False
                    break
        for line in values.take(pa.array(quoted, pa.int64())).to_pylist():
            after = ends_inside(line, row["from_inside"])
            # A field that was open before this split has closed once the two states meet
            # or this state has been outside.
            row["opens"] = row["opens"] or not after
            row["from_inside"] = after
            row["from_outside"] = ends_inside(line, row["from_outside"])
    if current is not None:
        yield finished()


_SPLIT_ARROW = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_()),
    ("opens", pa.bool_()), ("header", pa.string()),
])


@dataclass(frozen=True)
class Layout:
    """Header of each file, and by file the splits that begin inside a record (split to the
    split where the record began)."""

    headers: dict[str, str]
    crossing: dict[str, dict[int, int]]
    unfinished: frozenset[str]  # files with pieces: crossing records or an open last one


def file_key(path: str) -> str:
    """A file's place, however the path to it is written."""
    return unquote(urlsplit(path).path)


def layout(spark: SparkSession, paths: list[str]) -> Layout:
    """Headers and crossing records of files, in one pass over them.

    The driver gets one row per file and one per split that begins inside a record.
    """
    splits = _lines(spark, paths).mapInArrow(_describe, _SPLIT)
    ordered = F.sort_array(F.collect_list(F.struct("block", "from_outside", "from_inside", "opens", "header")))
    files = splits.groupBy("path").agg(ordered.alias("splits"))
    # Composition along a file: the state before each split and the split that opened it.
    step = F.aggregate(
        "splits",
        F.struct(F.lit(False).alias("inside"), F.lit(-1).cast("bigint").alias("owner"), F.expr("cast(array() as array<struct<block: bigint, owner: bigint>>)").alias("found")),
        lambda s, x: F.struct(
            F.when(s["inside"], x["from_inside"]).otherwise(x["from_outside"]).alias("inside"),
            F.when(~s["inside"] | x["opens"], x["block"]).otherwise(s["owner"]).alias("owner"),
            F.when(s["inside"], F.array_append(s["found"], F.struct(x["block"].alias("block"), s["owner"].alias("owner")))).otherwise(s["found"]).alias("found"),
        ),
    )
    files = files.select("path", F.get("splits", 0)["header"].alias("header"), step.alias("s"))
    rows = files.select("path", "header", "s.found", "s.inside").collect()
    headers = {file_key(r.path): without_return(r.header or "").removeprefix("\ufeff") for r in rows}
    crossing = {r.path: {x.block: x.owner for x in r.found} for r in rows if r.found}
    return Layout(headers, crossing, frozenset(file_key(r.path) for r in rows if r.found or r.inside))


_RECORD = "path string, block bigint, number bigint, record string, owner bigint"


def _cutter(crossing: dict[str, dict[int, int]]):
    """A function that cuts the splits of a task into records; pieces have an owner."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, inside, number, held, owner = None, False, 0, [], None

        def rows(records: list[tuple]) -> pa.RecordBatch:
            path, block = current
            size = len(records)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * size, pa.string()), pa.array([block] * size, pa.int64()),
                    pa.array([r[0] for r in records], pa.int64()), pa.array([r[1] for r in records], pa.string()),
                    pa.array([r[2] for r in records], pa.int64()),
                ],
                ["path", "block", "number", "record", "owner"],
            )

        def left_over() -> list[tuple]:
            # Open behind the split: a piece of a record that goes on in the next one, of
            # which this split is the owner unless it began before it.
            return [(number, "\n".join(held), owner if owner is not None else current[1])] if held else []

        for path, block, values in _by_split(batches):
            if (path, block) != current:
                if held:
                    yield rows(left_over())
                current, number, held = (path, block), 0, []
                owner = crossing.get(path, {}).get(block)
                inside = owner is not None
            records: list[tuple] = []
            plain = not inside and not held and not pc.any(pc.match_substring(values, '"')).as_py()
            if plain:
                records = [(number + k, line, None) for k, line in enumerate(values.to_pylist())]
                number += len(records)
            else:
                for line in values.to_pylist():
                    inside = ends_inside(line, inside)
                    held.append(line)
                    if not inside:
                        records.append((number, "\n".join(held), owner))
                        number, held, owner = number + 1, [], None
            if records:
                yield rows(records)
        if held:
            yield rows(left_over())

    return cut


def read_records(spark: SparkSession, paths: list[str], found: Layout) -> DataFrame:
    """``path, block, number, record`` of all records behind the headers.

    Blank lines between records are left out. A record that crosses splits has the place of
    the split where it began. A field still open at the end of a file ends there.
    """
    cut = _cutter(found.crossing)
    rows = _lines(spark, paths).mapInArrow(cut, _RECORD).where("owner is null").drop("owner")
    unfinished = [p for p in paths if file_key(p) in found.unfinished]
    if unfinished:
        parts = _lines(spark, unfinished).mapInArrow(cut, _RECORD).where("owner is not null")
        rows = rows.unionByName(_joined(parts))
    bare = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    first = (F.col("block") == 0) & (F.col("number") == 0)
    # The listing writes paths as addresses: a space is %20 there, a plus sign itself.
    path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    return rows.where(~first).withColumns({"record": bare, "path": path}).where(F.length("record") > 0)


def _joined(parts: DataFrame) -> DataFrame:
    """Records from the pieces that each split has of them."""
    pieces = F.sort_array(F.collect_list(F.struct("block", "number", "record")))
    return parts.groupBy("path", "owner").agg(pieces.alias("p")).select(
        "path", F.col("owner").alias("block"), F.element_at("p", 1)["number"].alias("number"),
        F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"),
    )
