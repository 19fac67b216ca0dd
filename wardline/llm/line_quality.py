"""Quality rules: word statistics, and lines that too many documents of a host share.

Lines are normalised (A-Z lower-cased, white space runs as one space) and hashed. Per host
the distinct texts with a line are counted, so exact copies count once. A line in more than
``MIN_TEXTS`` of them, or more than ``LONG_TEXTS`` where it has ``LONG_WORDS`` words, is above
the limits: it is removed from the host's documents, except from the one with the lowest id,
which keeps it. The limits do not grow with the host. A document is depleted when fewer than
``MIN_LEFT_WORDS`` words, or less than ``MIN_LEFT_SHARE`` of its words, remain.

Counting aggregates (host, line, text) with map-side combine; a line that a third of all
documents have is one row per text, and its count is a sum. The lines above the limits
come back to the documents by an equi-join whose document side adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wardline.llm.common import SMALL_SLICE_BYTES, array, lower_ascii, slices, split_words, strings, words
from wardline.operators.store import materialize

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_TEXTS = 50
LONG_WORDS = 50
LONG_TEXTS = 4
MIN_LEFT_WORDS = 10
MIN_LEFT_SHARE = 0.2
SYMBOLS = "[#*$%&|<>]"
STATS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def line_hash(line: str) -> tuple[int, int]:
    """Hash of a normalised line (signed 64 bits) and its number of words; 0 words: blank."""
    found = words(lower_ascii(line))
    return int.from_bytes(xxhash.xxh3_64_digest(" ".join(found)), "big", signed=True), len(found)


def repeated_words(index: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text: words inside windows of words that its text has twice or more."""
    count, n = len(offsets) - 1, len(index)
    if n < window:
        return np.zeros(count, np.int64)
    owner = np.repeat(np.arange(count), np.diff(offsets))
    rolled = np.zeros(n - window + 1, np.uint64)
    for k in range(window):
        rolled = (rolled ^ index[k : n - window + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    starts = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    keys = (rolled[starts] ^ owner[starts].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = starts[np.unique(np.concatenate([order[1:][same], order[:-1][same]]))]
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, twice, 1)
    np.add.at(marks, twice + window, -1)
    covered = np.cumsum(marks[:-1]) > 0
    return np.bincount(owner[covered], minlength=count)


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, host``, the statistics, ``text_hash`` and ``lines``
    (of each distinct line with a word: hash, words over all its places, words of one)."""
    schema = f"doc_id bigint, host string, text_hash bigint, {STATS}, lines array<struct<line:bigint,n_words:bigint,size:bigint>>"
    lines_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("line", "n_words", "size")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            texts = strings(batch)
            arrow = pa.array(texts, pa.large_string())
            split = split_words(arrow)
            doubles, lines, hashes = [], [], []
            for text in texts:
                seen, found, again = set(), {}, 0
                for line in text.split("\n"):
                    key, size = line_hash(line)
                    if size:
                        again += line in seen
                        seen.add(line)
                        found[key] = (found.get(key, (0,))[0] + size, size)
                doubles.append(again)
                lines.append([{"line": k, "n_words": n, "size": size} for k, (n, size) in found.items()])
                hashes.append(int.from_bytes(xxhash.xxh3_64_digest(text), "big", signed=True))
            spaces = pc.count_substring_regex(arrow, r"[\x20\x09-\x0D]")
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "host": batch.column("host"),
                "text_hash": array(hashes, pa.int64()),
                "n_words": array(np.diff(split.offsets), pa.int64()),
                "word_chars": pc.subtract(pc.utf8_length(arrow), spaces).cast(pa.int64()),
                "n_symbols": pc.count_substring_regex(arrow, SYMBOLS).cast(pa.int64()),
                "n_dup_lines": array(doubles, pa.int64()),
                "n_repeat_words": array(repeated_words(split.index, split.offsets), pa.int64()),
                "lines": array(lines, lines_type),
            })

    host = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host")
    return docs.select("doc_id", host, "text").mapInArrow(run, schema)


def frequent_lines(stats: DataFrame) -> DataFrame:
    """``host, line, first_doc_id`` of the lines above the limits."""
    texts = stats.groupBy("host", "text_hash").agg(F.min("doc_id").alias("doc_id"), F.first("lines").alias("lines"))
    lines = texts.select("host", "doc_id", F.inline("lines"))
    counted = lines.groupBy("host", "line").agg(
        F.count("*").alias("n_texts"), F.min("doc_id").alias("first_doc_id"), F.max("size").alias("size")
    )
    most = F.when(F.col("size") >= LONG_WORDS, min(LONG_TEXTS, MIN_TEXTS)).otherwise(MIN_TEXTS)
    return counted.where(F.col("n_texts") > most).select("host", "line", "first_doc_id")


def judge(docs: DataFrame, keep_lines: bool = False) -> DataFrame:
    """Verdicts: ``doc_id``, statistics, ``n_left_words, base_failed, kept``.

    With ``keep_lines`` there are also ``host, text_hash`` and ``removed``, the hashes of the
    lines to remove, for ``clean``. Null and empty texts have no words and fail. A null source
    is a host of its own. Repeated rows are judged each; an empty table gives no rows.
    """
    stats = materialize(statistics(docs).withColumn("row_id", F.monotonically_increasing_id()), "line-statistics")
    exploded = stats.select("row_id", "doc_id", "host", F.inline("lines"))
    joined = exploded.join(frequent_lines(stats), ["host", "line"])
    hit = joined.where(~F.col("doc_id").eqNullSafe(F.col("first_doc_id")))
    removed = hit.groupBy("row_id").agg(
        F.sum(F.col("n_words")).alias("n_removed"), F.sort_array(F.collect_set("line")).alias("removed")
    )
    left = F.col("n_words") - F.coalesce("n_removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    whole = (left >= MIN_LEFT_WORDS) & (left >= MIN_LEFT_SHARE * F.col("n_words"))
    found = stats.drop("lines").join(removed, "row_id", "left")
    columns = ["doc_id", *[c.split()[0] for c in STATS.split(", ")]]
    found = found.select(
        *columns, left.alias("n_left_words"), failed.alias("base_failed"), (~failed & whole).alias("kept"),
        "host", "text_hash", "removed",
    )
    return found if keep_lines else found.drop("host", "text_hash", "removed")


def clean(docs: DataFrame) -> DataFrame:
    """Documents that are kept, without the lines above the limits; columns unchanged.

    Rows that share id, host and text share their verdict. ``n_chars``, where it exists,
    is brought in line with the text.
    """
    verdicts = judge(docs, keep_lines=True).where("kept")
    keys = ["doc_id", "host", "text_hash"]
    verdicts = verdicts.groupBy(*keys).agg(F.first("removed").alias("removed"))
    names = docs.columns
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    tagged = docs.select(F.struct(*names).alias("row"), source.alias("host"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.struct_field(batch.column("row"), "text").to_pylist()
            sums = [int.from_bytes(xxhash.xxh3_64_digest(t or ""), "big", signed=True) for t in texts]
            columns = [batch.column("row"), batch.column("host"), array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "host", "text_hash"])

    schema = StructType(tagged.schema.fields + [StructField("text_hash", LongType())])
    keyed = tagged.mapInArrow(hashed, schema)
    keyed = keyed.select("row", "host", "text_hash", F.col("row.doc_id").alias("doc_id"))
    joined = keyed.join(
        verdicts.select(*[F.col(k).alias(f"v_{k}") for k in keys], "removed"),
        F.expr("doc_id <=> v_doc_id AND host = v_host AND text_hash = v_text_hash"),
    )

    @F.pandas_udf("string")
    def without(texts, removed):
        out = []
        for text, gone in zip(texts, removed):
            if text is not None and gone is not None:
                gone = set(gone)
                text = "\n".join(line for line in text.split("\n") if line_hash(line)[0] not in gone)
            out.append(text)
        return type(texts)(out, index=texts.index)

    text = without("row.text", "removed")
    out = joined.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names])
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in names else out
