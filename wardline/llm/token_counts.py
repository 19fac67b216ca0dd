"""Exact token counts; huge documents are encoded in overlapping chunks and spliced.

**Stable boundaries.** BPE only merges neighbours whose concatenation is a piece. A cut
between two characters that stand side by side in no piece is never crossed by a merge,
and merges on its two sides do not influence each other. So at such a cut the encoding of
a text is the encoding of its left part and that of its right part, whatever surrounds
them. This is derived from the vocabulary and holds for every text.

**Splicing.** Chunks of a huge document overlap. A chunk that begins inside the text starts
with a marker that is not there, and may begin inside a token; it agrees with the text from
its first stable boundary on. Each pair of neighbours is spliced at a boundary in their
overlap that is stable and a token boundary of both. Without one the overlap is doubled and
the left chunk encoded again, up to the end of the text, where nothing is left to splice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from wardline.llm.common import Shipped, array, slices, strings

MARK = "▁"
CHUNK_CHARS = 8192
OVERLAP_CHARS = 128


class Counter:
    """Token counts under a SentencePiece model."""

    def __init__(self, model: bytes, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chunk, self.overlap = chunk, overlap
        self.widened = 0
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        kinds, normalizer = sentencepiece_model_pb2.ModelProto.SentencePiece, spec.normalizer_spec
        # Else nothing can be proven here, and texts are encoded whole.
        self.provable = (
            spec.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
            and spec.trainer_spec.byte_fallback
            and not normalizer.precompiled_charsmap
            and normalizer.add_dummy_prefix
            and not normalizer.remove_extra_whitespaces
            and all(p.type != kinds.USER_DEFINED for p in spec.pieces)
        )
        pairs = {(a, b) for p in spec.pieces if p.type == kinds.NORMAL for a, b in zip(p.piece, p.piece[1:])}
        self.pairs = np.sort(np.array([self._pair(ord(a), ord(b)) for a, b in pairs], np.int64))
        # Bytes of text behind each token; a marker stands for a space.
        self.widths = np.array(
            [1 if p.type == kinds.BYTE else len(p.piece.replace(MARK, " ").encode()) for p in spec.pieces], np.int64
        )

    @staticmethod
    def _pair(left, right):
        return (left << 21) | right

    def stable(self, text: str, start: int, stop: int) -> np.ndarray:
        """Byte offsets, from that of ``start``, of the stable boundaries inside a range."""
        codes = np.frombuffer(text[start:stop].replace(" ", MARK).encode("utf-32-le"), "<u4").astype(np.int64)
        raw = np.frombuffer(text[start:stop].encode("utf-32-le"), "<u4")
        pairs = self._pair(codes[:-1], codes[1:])
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        sizes = 1 + (raw > 0x7F).astype(np.int64) + (raw > 0x7FF) + (raw > 0xFFFF)
        return np.cumsum(sizes)[:-1][self.pairs[at] != pairs]

    def _ends(self, text: str, start: int, stop: int) -> np.ndarray:
        """Byte offset, from that of ``start``, where each token of a chunk ends."""
        ids = np.asarray(self.processor.encode(text[start:stop], return_type="numpy"), np.int64)
        return np.cumsum(self.widths[ids]) - 1

    def count_huge(self, text: str) -> int:
        text, total, left = text.replace(MARK, " "), 0, -1
        start = 0
        while True:
            overlap = self.overlap
            following = start + self.chunk
            while following < len(text):
                stop = min(following + overlap, len(text))
                ends = self._ends(text, start, stop)
                head = len(text[start:following].encode())
                after = self._ends(text, following, min(following + self.chunk + self.overlap, len(text)))
                common = np.intersect1d(ends, self.stable(text, following, stop) + head, assume_unique=True)
                common = common[np.isin(common - head, after) & (common > left)]
                if len(common):
                    break
                if stop == len(text):
                    following = len(text)
                    break
                overlap *= 2
                self.widened += 1
            if following >= len(text):
                ends = self._ends(text, start, len(text))
                return total + int((ends > left).sum())
            cut = int(common[-1])
            total += int(((ends > left) & (ends <= cut)).sum())
            start, left = following, cut - head

    def count(self, texts: list[str]) -> list[int]:
        huge = [self.provable and len(t) > 2 * self.chunk for t in texts]
        whole = [t for t, h in zip(texts, huge) if not h]
        small = self.processor.encode(whole, num_threads=1, return_type="numpy") if whole else []
        found = iter([len(ids) for ids in small])
        return [self.count_huge(t) if h else next(found) for t, h in zip(texts, huge)]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    Null and empty texts have none. Repeated rows are repeated; other columns are not read.
    """
    model = Shipped(docs.sparkSession, model_path, Counter)
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = model.get()
        for batch in slices(batches):
            counts = array(counter.count(strings(batch)), pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_bytes": pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64()),
                "n_tokens": counts,
                "over_limit": pc.greater(counts, limit),
            })

    return docs.select("doc_id", "text").mapInArrow(run, schema)
