"""Near-duplicate embeddings by a subspace pigeonhole join. Exact.

Unit vectors with cosine c have the squared distance 2 - 2c, and a rotation keeps it. Cut
into ``BLOCKS`` blocks of rotated coordinates, a pair within the budget is, in one block at
least, within the block's share of the budget. Such pairs are candidates, and the exact
cosine of the whole vectors decides.

Equal vectors of a label are one class and compared once. The classes of a label are cut
into chunks, and each pair of chunks is a group of its own: a vector travels once per chunk
of its label, in the precision that it came in, and not once per block and cell. There are
at most ``SPREAD`` chunks until they reach ``CHUNK_BYTES`` each, so what is shuffled stays
in proportion to the input up to there; all pairs of larger labels take one copy more per
chunk. Within a group, vectors are ordered by the cells of a grid, a few times wider than a
block's radius, and joined tile by tile; a block in which the boxes of two tiles are too far
apart gives no candidates.

Per group the results are linear in its rows: numbers of links, and one edge per vector to
the least vector that it hangs together with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import array
from wardline.llm.graph import components
from wardline.operators.store import materialize

BLOCKS = 8
GRID = 3
CELL_RADII = 2.5
# Vectors of a tile, and the fewest that are worth a chunk.
CHUNK_ROWS = 2048
SPREAD = 3
CHUNK_BYTES = 32 << 20
SLACK = 1e-9
LEAST_COSINE = 0.93


def rotation(dimensions: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(dimensions).standard_normal((dimensions, dimensions)))[0]


def block_slices(dimensions: int, blocks: int = BLOCKS) -> list[slice]:
    edges = np.linspace(0, dimensions, min(blocks, dimensions) + 1).round().astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors.astype(np.float64, copy=False)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def grid_order(rotated: np.ndarray, budget: float) -> np.ndarray:
    """An order in which vectors of one cell of the first block's grid follow each other."""
    part = block_slices(rotated.shape[1])[0]
    radius = math.sqrt(budget * (part.stop - part.start) / rotated.shape[1] + SLACK)
    cells = np.floor(rotated[:, part][:, :GRID] / (CELL_RADII * radius))
    return np.lexsort(cells.T[::-1])


def tiles(vectors: np.ndarray, ids: np.ndarray, copies: np.ndarray, budget: float) -> list[dict]:
    """Tiles of unit vectors in grid order; per block the terms of squared distances in single
    precision and the box of each tile."""
    turn, parts, out = rotation(vectors.shape[1]), block_slices(vectors.shape[1]), []
    order = np.concatenate([
        s + grid_order(unit(vectors[s : s + 16 * CHUNK_ROWS]) @ turn, budget) for s in range(0, len(ids), 16 * CHUNK_ROWS)
    ]) if len(ids) else np.zeros(0, np.int64)
    for start in range(0, len(ids), CHUNK_ROWS):
        some = order[start : start + CHUNK_ROWS]
        rotated = unit(vectors[some]) @ turn
        blocks = []
        for part in parts:
            x = rotated[:, part]
            length = (x * x).sum(axis=1)[:, None]
            one = np.ones_like(length)
            left, right = np.hstack([x, length, one]), np.hstack([-2 * x, one, length])
            blocks.append((left.astype(np.float32), right.astype(np.float32), x.min(axis=0), x.max(axis=0)))
        out.append({"rows": some, "ids": ids[some], "copies": copies[some], "blocks": blocks})
    return out


def _candidates(left: dict, right: dict, budget: float, dimensions: int) -> np.ndarray:
    """Which pairs of two tiles are within the budget's share in some block."""
    found = np.zeros((len(left["ids"]), len(right["ids"])), bool)
    for part, (x, _, low, high), (_, y, least, most) in zip(block_slices(dimensions), left["blocks"], right["blocks"]):
        width = part.stop - part.start
        share = budget * width / dimensions + SLACK
        gap = np.maximum(0, np.maximum(least - high, low - most))
        if (gap * gap).sum() <= share:
            # Single precision may be off by some units in the last place per term.
            found |= x @ y.T <= np.float32(share + 4e-7 * (width + 8))
    return found


def _linked(left: dict, right: dict, same: bool, vectors: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """Pairs of two tiles that link, as a matrix; of a tile with itself, above the diagonal."""
    link = _candidates(left, right, 2 - 2 * least, vectors[0].shape[1])
    if same:
        link = np.triu(link, 1)
    count = np.count_nonzero(link)
    if not count:
        return link
    a, b = unit(vectors[0][left["rows"]]), unit(vectors[1][right["rows"]])
    if count > link.size // 64:
        return link & (left["ids"][:, None] != right["ids"]) & (a @ b.T >= least)
    link &= left["ids"][:, None] != right["ids"]
    x, y = np.nonzero(link)
    for k in range(0, len(x), 1 << 14):
        i, j = x[k : k + (1 << 14)], y[k : k + (1 << 14)]
        link[i, j] = np.einsum("ij,ij->i", a[i], b[j]) >= least
    return link


def _group_links(left: dict, right: dict | None, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a pair of chunks, or of one within itself: ids of linked classes, their numbers of
    links, and the least id that each hangs together with."""
    sides = [left] if right is None else [left, right]
    cut = [tiles(s["vectors"], s["ids"], s["copies"], 2 - 2 * least) for s in sides]
    starts = np.cumsum([0, *(len(s["ids"]) for s in sides)])
    ids = np.concatenate([s["ids"] for s in sides])
    counts, edges = np.zeros(len(ids), np.int64), []
    for k, x in enumerate(cut[0]):
        for y in cut[0][k:] if right is None else cut[1]:
            link = _linked(x, y, x is y, (sides[0]["vectors"], sides[-1]["vectors"]), least)
            rows, columns = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
            if not len(rows):
                continue
            some = link[np.ix_(rows, columns)]
            mine, others = x["rows"][rows], starts[len(sides) - 1] + y["rows"][columns]
            np.add.at(counts, mine, some @ y["copies"][columns])
            np.add.at(counts, others, x["copies"][rows] @ some)
            edges.extend(_joined(some, mine, others))
    some = np.flatnonzero(counts)
    return ids[some], counts[some], _roots(ids, edges)[some]


def _joined(link: np.ndarray, mine: np.ndarray, others: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges from the vectors of two tiles to the first of their component."""
    big = len(mine)
    a = np.arange(len(mine))
    while True:
        b = np.where(link, a[:, None], big).min(axis=0)
        best = np.minimum(a, np.where(link, b, big).min(axis=1))
        if (best == a).all():
            return [(mine, mine[a]), (others, mine[b])]
        a = best


def _roots(ids: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least id that each one hangs together with."""
    a, b = (np.concatenate([e[k] for e in edges]) if edges else np.zeros(0, np.int64) for k in (0, 1))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    a, b = rank[a], rank[b]
    root = np.arange(len(ids))
    while True:
        # Hang the greater of two roots under the smaller, then shorten all ways.
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return ids[order[root[rank]]]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding, label``.

    Two vectors link when their labels and lengths are equal, the label is not null and
    their cosine is ``least`` or more. Null, empty and zero vectors, and those with null or
    non-finite components, link with nothing. Ids are unique; rows that repeat an id in
    full count as one vector and are repeated in the result. Further columns are not read.
    """
    base = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    label = base.schema["label"].dataType.simpleString()
    # Kept in single precision if it came so; only digests are worked out from all other kinds.
    kind = base.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    base = base.withColumn("embedding", F.col("embedding").cast(kind))

    def digest(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            hashes, sizes = [], []
            for value in lists:
                found = np.array(value.values.to_numpy(zero_copy_only=False) if value.is_valid else [], np.float64)
                fine = bool(len(found) and np.isfinite(found).all() and found.any())
                sizes.append(len(found))
                hashes.append(xxhash.xxh3_128_digest(found.tobytes()) if fine else None)
            columns = {"vec_id": batch.column("vec_id"), "label": batch.column("label")}
            columns |= {"digest": array(hashes, pa.binary()), "size": array(sizes, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns | ({"embedding": lists} if whole else {}))

    schema = f"vec_id bigint, label {label}, digest binary, size int"
    hashed = materialize(base.mapInArrow(lambda batches: digest(batches, False), schema), "vectors")
    usable = "digest IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL"
    classes = materialize(
        hashed.where(usable).select("label", "digest", "vec_id", "size").distinct().groupBy("label", "digest")
        .agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"), F.max("size").alias("size")),
        "vector-classes",
    )
    # The vectors are read again, rather than written, and travel to their classes once.
    heads = base.mapInArrow(lambda batches: digest(batches, True), f"{schema}, embedding {kind}").where(usable)
    dealt = _dealt(classes, 4 if kind == "array<float>" else 8).withColumnRenamed("class_id", "vec_id")
    key = ["label", "digest", "vec_id"]
    heads = heads.drop("size").join(dealt, key).dropDuplicates(key).withColumnRenamed("vec_id", "class_id").drop("digest")
    found = materialize(_links(heads, least), "vector-links")
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    edges = found.where("root <> class_id").select("class_id", "root")
    parts = components(edges).withColumnsRenamed({"node": "class_id"})
    result = classes.join(counts, "class_id", "left").join(parts, "class_id", "left").select(
        "label", "digest",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "class_id").alias("component_id"),
    )
    out = hashed.select("vec_id", "label", "digest").join(result, ["label", "digest"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _dealt(classes: DataFrame, width: int) -> DataFrame:
    """The classes that others of their label and size may link with, and in how many chunks
    these are cut; ``width`` is the number of bytes of a component."""
    held = classes.groupBy("label", "size").agg(F.count("*").alias("held")).where("held > 1")
    few = F.least(F.ceil(F.col("held") / CHUNK_ROWS), F.lit(SPREAD))
    chunks = F.greatest(few, F.ceil(F.col("held") * F.col("size") * width / CHUNK_BYTES)).cast("int")
    return classes.join(held.select("label", "size", chunks.alias("chunks")), ["label", "size"])


def _links(heads: DataFrame, least: float) -> DataFrame:
    """``class_id, links, root``, several rows per class; links are of vectors."""
    keys = ["label", "size"]
    spread = heads.withColumn("mine", F.pmod(F.xxhash64("class_id"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    spread = spread.select("class_id", *keys, "copies", "embedding", "mine", other)
    spread = spread.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})

    def join(group: pa.Table) -> pa.Table:
        size = group.column("size")[0].as_py()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        mine = group.column("mine").to_numpy()

        def side(chunk: int) -> dict:
            some = group.filter(pa.array(mine == chunk)).combine_chunks()
            flat = some.column("embedding").combine_chunks().flatten().to_numpy()
            return {
                "ids": some.column("class_id").to_numpy(), "copies": some.column("copies").to_numpy(),
                "vectors": flat.reshape(-1, size),
            }

        found = _group_links(side(low), None if low == high else side(high), least)
        return pa.table([array(c, pa.int64()) for c in found], ["class_id", "links", "root"])

    groups = spread.withColumn("pair", F.struct(*keys, "low", "high")).drop("other").groupBy("pair")
    return groups.applyInArrow(join, "class_id bigint, links bigint, root bigint")
