"""Product codes of vectors, fitted and assigned through a trie over distinct parts.

A vector becomes whole numbers, floor(1024 x), cut into ``PARTS`` equal consecutive parts.
Each position of a part has a codebook of ``ENTRIES`` entries.

**Trie.** Distinct parts are counted over the whole table and put in lexicographic order,
so parts with a common prefix of dimensions lie side by side. A traversal, depth first,
carries for each prefix the 256 squared distances to the entries accumulated so far: a
prefix's vector is computed once for all parts below it. Below the point where a part
shares its prefix with no other, the rest of its path has no branches and is one step.
A leaf takes the nearest entry and adds its part, times its count, to that entry's sum.
Nodes are expanded in blocks, the first block of a level down to its leaves before the
second, so memory is bounded by depth times block size.

**Rounds.** Each round is one pass over the distinct parts, which were shuffled and written
once; only the codebooks (4 x 256 parts) reach the driver and go out again. All distances
and sums are whole numbers, so results do not depend on partitions or on repeated tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import array
from wardline.operators.store import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Numbers from this on have no exact squared distance in a long; such vectors are dropped.
BOUND = 1 << 24
BLOCK_NODES = 256
SLICE_ROWS = 4096
_OFFSET = 1 << 31


def numbers(vectors: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be coded, and their whole numbers (those rows x size).

    A vector is left out where it is null, has another size, or has a component that is
    null, not finite, or ``BOUND`` / 1024 or more in absolute value.
    """
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    if size is None:
        size = int(sizes.max(initial=0))
    good = sizes == size if size > 0 else np.zeros(len(sizes), bool)
    held = vectors.filter(pa.array(good))
    flat = held.flatten().cast(pa.float64())
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, max(size, 1))
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(values * SCALE)
        fine = (np.abs(scaled) < BOUND).all(axis=1)  # false for NaN and infinities
    good[good] = fine
    return good, scaled[fine].astype(np.int64)


def pack(parts: np.ndarray) -> list[bytes]:
    """Parts as bytes whose order is the lexicographic order of the numbers."""
    raw = np.ascontiguousarray((parts + _OFFSET).astype(">u4"))
    width = raw.shape[1] * 4
    content = raw.tobytes()
    return [content[i : i + width] for i in range(0, len(content), width)]


def unpack(packed: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), ">u4").reshape(-1, width).astype(np.int64) - _OFFSET


def nearest(parts: np.ndarray, entries: np.ndarray, block: int = BLOCK_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties to the lower index) and squared distance of each part.

    ``parts`` are distinct and in lexicographic order.
    """
    count, depth = parts.shape
    code, error = np.zeros(count, np.int64), np.zeros(count, np.int64)
    # changed[i]: first dimension in which part i differs from the one before it.
    changed = np.zeros(count, np.int64)
    if count > 1:
        changed[1:] = (parts[1:] != parts[:-1]).argmax(axis=1)
    # Sums of products of these numbers are exact in floating point, else whole numbers do.
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)
    kind = np.float64 if 4 * most * most * depth < 1 << 52 else np.int64
    points, table = parts.astype(kind), entries.astype(kind)

    def settle(rows: np.ndarray, sums: np.ndarray) -> None:
        code[rows] = sums.argmin(axis=1)
        error[rows] = sums[np.arange(len(rows)), code[rows]].astype(np.int64)

    # A block: nodes of one level as ranges of parts, the sums of their parents, and whose
    # child each node is. The last block put on the stack is taken first.
    root = (0, np.array([0]), np.array([count]), np.zeros((1, len(entries)), kind), np.array([0]))
    stack = [root] if count else []
    while stack:
        level, starts, ends, above, parent = stack.pop()
        sums = above[parent]
        if level:  # the step from the parents to these nodes
            sums = sums + (points[starts, level - 1][:, None] - table[None, :, level - 1]) ** 2
        alone = (ends - starts == 1) | (level == depth)
        if alone.any():
            rows, left = starts[alone], table[:, level:]
            rest = points[rows][:, level:]
            tail = (rest**2).sum(axis=1)[:, None] - 2 * (rest @ left.T) + (left**2).sum(axis=1)[None, :]
            settle(rows, sums[alone] + tail)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            continue
        # Children: runs of an equal next number inside each open node.
        inside = np.concatenate([np.arange(starts[k], ends[k]) for k in open_.tolist()])
        owner = np.repeat(open_, (ends - starts)[open_])
        begins = (changed[inside] <= level) | (inside == starts[owner])
        child, mine = inside[begins], owner[begins]
        stops = np.append(child[1:], 0)
        last = np.append(mine[1:] != mine[:-1], True)
        stops[last] = ends[mine[last]]
        for at in range((len(child) - 1) // block * block, -1, -block):
            cut = slice(at, at + block)
            stack.append((level + 1, child[cut], stops[cut], sums, mine[cut]))
    return code, error


def _distinct(vectors: DataFrame, width: int) -> DataFrame:
    """``position, part, n`` of all distinct parts, written in lexicographic order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, values = numbers(batch.column("vector"), PARTS * width)
            for position in range(PARTS if len(values) else 0):
                parts, counts = np.unique(values[:, position * width : (position + 1) * width], axis=0, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "position": array(np.full(len(parts), position), pa.int32()),
                    "part": array(pack(parts), pa.binary()),
                    "n": array(counts, pa.int64()),
                })

    parts = vectors.select("vector").mapInArrow(run, "position int, part binary, n bigint")
    counted = parts.groupBy("position", "part").agg(F.sum("n").alias("n"))
    ordered = counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part")
    return materialize(ordered, "code-parts")


def _sums(parts: DataFrame, width: int, shared) -> DataFrame:
    """``position, entry, n, dimension, total`` of the parts by their nearest entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts = np.zeros((PARTS, ENTRIES), np.int64)
        totals = np.zeros((PARTS, ENTRIES, width), np.int64)
        for batch in batches:
            at = batch.column("position").to_numpy()
            n = batch.column("n").to_numpy()
            values = unpack(batch.column("part").to_pylist(), width)
            for position in np.unique(at).tolist():
                own = at == position
                mine, times = values[own], n[own]
                order = np.lexsort(mine.T[::-1])  # files are in order; a split keeps it
                mine, times = mine[order], times[order]
                code, _ = nearest(mine, books[position])
                np.add.at(counts[position], code, times)
                np.add.at(totals[position], code, mine * times[:, None])
        position, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "position": array(position, pa.int32()),
            "entry": array(entry, pa.int32()),
            "n": array(counts[position, entry], pa.int64()),
            "totals": array(totals[position, entry].tolist(), pa.list_(pa.int64())),
        })

    found = parts.mapInArrow(run, "position int, entry int, n bigint, totals array<bigint>")
    # Elementwise sums: one column for the count and one for each dimension of a part.
    sums = [F.sum(F.col("totals")[d]).alias(f"t{d}") for d in range(width)]
    return found.groupBy("position", "entry").agg(F.sum("n").alias("n"), *sums)


def fit(vectors: DataFrame) -> list[np.ndarray]:
    """Codebooks of ``vec_id, vector`` rows, by position; empty without any vector."""
    spark = vectors.sparkSession
    first = _first_vectors(vectors)
    if not len(first):
        return []
    width = first.shape[1] // PARTS
    books = [first[:, p * width : (p + 1) * width].copy() for p in range(PARTS)]
    parts = _distinct(vectors, width)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(books)
        # At most PARTS x ENTRIES rows.
        for row in _sums(parts, width, shared).collect():
            total = np.array(row[3:], np.int64)
            books[row["position"]][row["entry"]] = total // row["n"]
        shared.unpersist()
    return books


def _first_vectors(vectors: DataFrame) -> np.ndarray:
    """Numbers of the vectors with the ``ENTRIES`` smallest ids, one vector per id.

    Each task passes on its own smallest; the size of all vectors is that of the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            ids, column = batch.column("vec_id").to_pylist(), batch.column("vector")
            order = pc.sort_indices(batch.column("vec_id")).to_pylist()
            for row in order:
                if ids[row] is None or (len(held) >= ENTRIES and ids[row] > max(held)):
                    break
                good, values = numbers(column.slice(row, 1))
                if good[0]:
                    value = values[0].tolist()
                    if len(value) % PARTS == 0:
                        held[ids[row]] = min(held.get(ids[row], value), value)
                    while len(held) > ENTRIES:
                        del held[max(held)]
        yield pa.RecordBatch.from_pydict({
            "vec_id": array(list(held), pa.int64()),
            "numbers": array(list(held.values()), pa.list_(pa.int64())),
        })

    found = vectors.select("vec_id", "vector").mapInArrow(run, "vec_id bigint, numbers array<bigint>")
    found = found.groupBy("vec_id").agg(F.min("numbers").alias("numbers"))
    rows = found.orderBy("vec_id").limit(ENTRIES).collect()  # at most ENTRIES rows
    size = len(rows[0]["numbers"]) if rows else 0
    return np.array([r["numbers"] for r in rows if len(r["numbers"]) == size], np.int64)


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` of each row that can be coded."""
    schema = "vec_id bigint, label bigint, code string, error bigint"
    width = books[0].shape[1] if books else 0
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows if books else 0, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                good, values = numbers(batch.column("vector"), PARTS * width)
                codes = np.zeros((len(values), PARTS), np.uint8)
                errors = np.zeros(len(values), np.int64)
                for position in range(PARTS if len(values) else 0):
                    own = values[:, position * width : (position + 1) * width]
                    parts, place = np.unique(own, axis=0, return_inverse=True)
                    code, error = nearest(parts, books[position])
                    codes[:, position] = code[place.ravel()]
                    errors += error[place.ravel()]
                text = codes.tobytes().hex()
                kept = pa.array(good)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").filter(kept).cast(pa.int64()),
                    "label": batch.column("label").filter(kept).cast(pa.int64()),
                    "code": array([text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)], pa.string()),
                    "error": array(errors, pa.int64()),
                })

    return vectors.select("vec_id", "vector", "label").mapInArrow(run, schema)


def decode(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p][k] for p, k in enumerate(bytes.fromhex(code))]) / SCALE


def codebook_digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' decimal components, by part, entry and position."""
    flat = np.concatenate([b.ravel() for b in books]).tolist() if books else []
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def compress(embeddings: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of ``vec_id, embedding, label`` rows, and the codebooks.

    The codes are ``vec_id, label, code, error, label_error``; ``label_error`` sums the
    errors of equal labels, null labels together.
    Left out are rows whose vector is null, empty, holds null, NaN or infinite components
    or one of ``BOUND`` / 1024 or more in absolute value, or has another size than the
    vector with the smallest id; a size that ``PARTS`` does not divide has no codes. Rows
    with a null id are coded, but start no codebook entry; of several vectors with one id
    the smallest starts an entry. Repeated rows are repeated and count each time. Further
    columns are not read. An empty table gives no rows.
    """
    vectors = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"), "label")
    books = fit(vectors)
    coded = materialize(encode(vectors, books), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.withColumnRenamed("label", "sum_label")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("sum_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error"), books
