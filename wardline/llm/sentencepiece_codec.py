"""SentencePiece encoding and decoding through a table of distinct marked chunks.

A text becomes ``▁`` + text with spaces as ``▁``. Where no piece of the vocabulary has a
marker after another character, no merge can cross from a character into a marker, so the
text falls into chunks (a run of markers and the characters up to the next one) that the
library segments independently. Each task keeps a table of its distinct chunks, asks the
library once for each, and joins their ids back by position in the text. The table is
bounded: it is emptied between slices of text once it is full.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from wardline.llm.common import SMALL_SLICE_BYTES, Shipped, Split, array, give_back, slices, spread, text_array

MARK = "▁"
TABLE_CHUNKS = 250_000
# Candidates for a character that no text of a slice has: private use, 6,400 of them.
_CUTS = [chr(c) for c in range(0xE000, 0xF900)]


def has_runs(texts: pa.Array) -> bool:
    """Whether any text has two spaces in a row, or one at its start or end."""
    tests = pc.match_substring(texts, "  "), pc.starts_with(texts, " "), pc.ends_with(texts, " ")
    return any(pc.any(found).as_py() for found in tests)


class ChunkTable:
    """Distinct chunks of a SentencePiece model with their ids."""

    def __init__(self, model: bytes, limit: int = TABLE_CHUNKS):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.limit = limit
        self.decimals = pa.array([str(i) for i in range(len(self.processor))], pa.large_string())
        self.clear()
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        normalizer, pieces = spec.normalizer_spec, [p.piece for p in spec.pieces]
        plain = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.separable = (
            spec.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
            and not normalizer.precompiled_charsmap
            and normalizer.add_dummy_prefix
            and normalizer.escape_whitespaces
            and not normalizer.remove_extra_whitespaces
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and all(p.type != plain.USER_DEFINED for p in spec.pieces)
            and not any(MARK in p.lstrip(MARK) for p in pieces)
        )

    def plain_chunks(self, texts: pa.Array) -> Split | None:
        """Chunks of texts without markers, of which none has a run of spaces or begins or
        ends with one; else None."""
        if not self.separable or has_runs(texts) or pc.any(pc.match_substring(texts, MARK)).as_py():
            return None
        return Split(texts, " ")

    def chunks(self, texts: pa.Array) -> Split | None:
        """Chunks of each text, without their first marker; spaces are further markers.

        None where the texts leave no character to cut at.
        """
        texts = pc.replace_substring(texts, MARK, " ")
        if not has_runs(texts):
            return Split(texts, " ")
        # Cut before each run of spaces, at a character that the texts lack.
        cut = next((c for c in _CUTS if not pc.any(pc.match_substring(texts, c)).as_py()), None)
        if cut is None:
            return None
        texts = pc.binary_join_element_wise(" ", texts, "")
        split = Split(pc.replace_substring_regex(texts, " ( *)", cut + r"\1"), cut)
        return split.without_first()

    def learn(self, chunks: list[str]) -> np.ndarray:
        """Rows of the table for these chunks, which lack their first marker."""
        if len(self.rows) > self.limit:
            self.clear()
        rows = self.rows
        new = [c for c in chunks if c not in rows]
        if new:
            # The library puts one marker in front of every text but the empty one.
            encoded = self.processor.encode([c or "a " for c in new], num_threads=1)
            if "" in new:
                lone = new.index("")
                encoded[lone] = encoded[lone][len(self.processor.encode("a")) :]
            rows.update(zip(new, range(len(rows), len(rows) + len(new)), strict=True))
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(lengths.sum()))
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, flat])
        return np.fromiter(map(rows.__getitem__, chunks), np.int64, len(chunks))

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: pa.Array, split: Split | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offsets of each text in them; ``split`` has their chunks."""
        if split is None and self.separable:
            split = self.chunks(texts)
        if split is not None:
            index = self.learn(split.parts)[split.index]
            positions, ends = spread(self.lengths, index)
            ids, offsets = self.flat[positions], np.concatenate([[0], ends])[split.offsets]
            empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
            if empty.any():  # unlike a lone marker, the empty text has no ids
                sizes = np.diff(offsets)
                ids = ids[np.repeat(~empty, sizes)]
                offsets = np.concatenate([[0], np.cumsum(np.where(empty, 0, sizes))])
            return ids, offsets
        encoded = self.processor.encode(texts.to_pylist(), num_threads=1) if len(texts) else []
        offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)
        return np.fromiter(chain.from_iterable(encoded), np.int32, int(offsets[-1])), offsets

    def join_decimals(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        lists = pa.LargeListArray.from_arrays(pa.array(offsets), self.decimals.take(pa.array(ids)))
        return pc.binary_join(lists, pa.scalar(",", pa.large_string())).to_pylist()

    def decode(self, encoded: list[list[int]]) -> list[str]:
        return self.processor.decode(encoded, num_threads=1) if encoded else []


def encode_documents(docs: DataFrame, model_path: str, keep_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``; with ``keep_ids`` also
    ``ids`` (array of int) and ``decoded``. Null and empty texts have no ids and decode to
    the empty text. Repeated rows are repeated; other columns are not read.
    """
    model = Shipped(docs.sparkSession, model_path, ChunkTable)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec: ChunkTable = model.get()
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            ids, offsets = codec.encode(text_array(batch))
            lists = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
            decoded, joined = codec.decode(lists), codec.join_decimals(ids, offsets)
            columns = {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_tokens": array(np.diff(offsets), pa.int64()),
                "ids_sha256": array([hashlib.sha256(j.encode()).hexdigest() for j in joined], pa.string()),
                "decoded_sha256": array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            }
            if keep_ids:
                columns |= {"ids": array(lists, pa.list_(pa.int32())), "decoded": array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)
        codec.clear()  # workers live on; later stages need the memory
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
