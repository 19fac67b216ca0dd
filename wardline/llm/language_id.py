"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the 1- to 3-grams of the lower-cased text with every run of other characters
than letters as one space; each n-gram hashes to one of ``BUCKETS`` buckets. Training adds
up, per language, the buckets' counts over a sample of labelled documents that is drawn by
a hash of the id and bounded per language (``max_docs``); tasks count with numpy, Spark adds
up. The log-probability matrix (languages x buckets, both bounded) is broadcast, and each
slice of documents is scored as one sparse matrix product: a gather and a segmented sum.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from wardline.llm.common import array, slices, strings

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_DOCS = 20_000
MAX_LANGUAGES = 256
SMOOTHING = 0.5
# Each byte of text takes tens of bytes of n-gram arrays.
SLICE_BYTES = 1 << 20
UNDETERMINED = "und"
# Texts are cut into windows of this many characters, so that one huge text is not one array.
WINDOW = 1 << 20
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams in text order and the offset of each text in them."""
    coded = "\0".join(["", *[t.lower() for t in texts], ""]).encode("utf-32-le")
    codes = np.frombuffer(coded, "<u4")
    lengths = np.fromiter((len(t.lower()) for t in texts), np.int64, len(texts))
    return _features(codes, lengths)


def _features(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    letter = _is_letter()[codes]
    border = np.zeros(len(codes), bool)
    border[np.concatenate([[0], np.cumsum(lengths + 1)])] = True
    # One space per run of other characters; borders stand between texts as spaces.
    keep = letter | border
    keep[1:] |= letter[:-1] & ~border[1:]
    keep[:-1] &= letter[:-1] | border[:-1] | ~border[1:]
    kept = np.where(letter, codes, 32).astype(np.uint32)[keep]
    starts = np.flatnonzero(border[keep])
    texts = np.cumsum(border[keep]) - 1
    return _hashed(kept, letter[keep], texts, len(starts) - 1)


def _hashed(kept: np.ndarray, letter: np.ndarray, texts: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    found, owners = [], []
    rolled, some = kept.copy(), letter.copy()
    for n in range(1, max(ORDERS) + 1):
        if n > 1:
            rolled = rolled[:-1] * np.uint32(0x01000193) ^ kept[n - 1 :] * np.uint32(0x9E3779B1)
            some = some[:-1] | letter[n - 1 :]
        if n not in ORDERS:
            continue
        # An n-gram belongs to the text where it starts and may end on the next border.
        last = texts[n - 1 :]
        inside = some & ((last == texts[: len(last)]) | ((last == texts[: len(last)] + 1) & ~letter[n - 1 :]))
        hashed = (rolled ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
        found.append((hashed >> np.uint32(16))[inside])
        owners.append(texts[: len(last)][inside])
    buckets, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count)[:count])])


def fit(docs: DataFrame, labelled: Column, max_docs: int = MAX_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and their matrix (buckets + 1, languages) of log-probabilities.

    ``labelled`` says which rows may be learned from; rows without a language or text never
    are. Per language about ``max_docs`` documents are taken, those with the lowest hashes
    of their ids. The last row of the matrix has the log-priors.
    """
    rows = docs.where(labelled & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return [], np.zeros((BUCKETS + 1, 0))
    languages, counts = [r["lang"] for r in sizes], np.array([r["count"] for r in sizes], float)
    share = F.lit(0.0)
    for language, n in zip(languages, counts):
        share = F.when(F.col("lang") == language, F.lit(min(1.0, max_docs / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)), F.lit(1 << 30)) < share * (1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches, limit=SLICE_BYTES):
            langs, texts = batch.column("lang").to_pylist(), strings(batch)
            for language in set(langs):
                mine = [t for t, l in zip(texts, langs) if l == language]
                found = np.bincount(features(mine)[0], minlength=BUCKETS)
                totals[language] = totals[language] + found if language in totals else found
        for language, found in totals.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({
                "lang": array([language] * len(used), pa.string()),
                "bucket": array(used, pa.int32()), "n": array(found[used], pa.int64()),
            })

    parts = rows.where(drawn).select("lang", "text").mapInArrow(count, "lang string, bucket int, n bigint")
    # At most MAX_LANGUAGES x BUCKETS rows.
    found = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros((BUCKETS, len(languages)))
    columns = np.array([languages.index(l) for l in found.column("lang").to_pylist()], np.int64)
    matrix[found.column("bucket").to_numpy(), columns] = found.column("n").to_numpy()
    matrix = np.log((matrix + SMOOTHING) / (matrix.sum(axis=0) + SMOOTHING * BUCKETS))
    return languages, np.vstack([matrix, np.log(counts / counts.sum())])


def score(texts: list[str], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of each text under each language, and its number of n-grams."""
    sums, grams = np.zeros((len(texts), matrix.shape[1])), np.zeros(len(texts), np.int64)
    # Huge texts go window by window; n-grams across two windows are counted once, with
    # the space at a window's edge, like those at the edge of a text.
    pieces, owner = [], []
    for k, text in enumerate(texts):
        for at in range(0, len(text), WINDOW):
            pieces.append(text[at : at + WINDOW])
            owner.append(k)
    if not pieces:
        return sums, grams
    buckets, offsets = features(pieces)
    sizes = np.diff(offsets)
    rows = np.flatnonzero(sizes)
    if len(rows):
        for column in range(matrix.shape[1]):
            found = np.add.reduceat(matrix[:-1, column][buckets], offsets[:-1][rows])
            np.add.at(sums[:, column], np.array(owner)[rows], found)
        np.add.at(grams, np.array(owner), sizes)
    return sums, grams


def predict(docs: DataFrame, languages: list[str], matrix: np.ndarray) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the posterior of the predicted language.

    Null texts, texts without a letter, and all texts under a model without languages are
    ``und`` with score 0. Ties go to the first language in alphabetical order. Repeated rows
    are repeated; further columns are kept as they are.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE_BYTES):
            sums, grams = score(strings(batch), model.value)
            known = grams > 0
            if languages:
                joint = sums + model.value[-1]
                best = joint.argmax(axis=1)
                spread = np.exp(joint - joint.max(axis=1, keepdims=True))
                top = np.where(known, 1 / spread.sum(axis=1), 0.0)
                names = [languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
            else:
                top, names = np.zeros(batch.num_rows), [UNDETERMINED] * batch.num_rows
            columns = [*batch.columns, array(names, pa.string()), array(top, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    out = docs.drop("lang_pred", "score")
    schema = StructType(out.schema.fields + [StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return out.mapInArrow(run, schema)


def keep_known(docs: DataFrame, labelled: Column, least: float = 0.5) -> DataFrame:
    """Documents whose language is determined with a score of ``least`` or more.

    Fits on the labelled rows first; without any, nothing is determined and no row stays.
    Columns are unchanged.
    """
    languages, matrix = fit(docs, labelled)
    row = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = predict(row, languages, matrix)
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.select("row.*")
