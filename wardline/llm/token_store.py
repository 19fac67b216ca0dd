"""Token ids in binary shards with keyed access through a minimal perfect hash.

A store is a folder of shards, each a range of document ids:

- ``<name>.ids``: the raw ids, little-endian, two bytes each where the vocabulary allows it,
  else four; documents in ascending order of their key, each closed by the end id.
- ``<name>.index``: a perfect hash over the shard's distinct keys, and per slot the key's
  fingerprint, first offset, number of ids and number of documents with that key; then the
  keys and lengths of all documents in order, for scans.
- ``manifest``: Parquet, one row per shard. It alone says which files count, so what lost
  or repeated tasks leave behind is never read.

Executors write and read the shards through ``pyarrow.fs`` at the given address.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from wardline.llm.common import Shipped, array, slices, split_words, spread, text_array, text_list
from wardline.llm.perfect_hash import PerfectHash, fingerprints

MANIFEST = "shard int, name string, n_docs bigint, n_tokens bigint, width int, first_doc_id bigint, last_doc_id bigint"
TABLE_WORDS = 350_000
_JOINED = 50
SHARD_BYTES = 16 << 20
# Letters of Latin-1. Composed, each its own lower-case pair: the tokenizer's normaliser
# and pre-tokenizer leave a lower-cased word of these whole.
WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
# Characters that close a word and go into tokens of their own; the apostrophe may not.
CLOSING = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def byte_letters() -> list[str]:
    """The characters that stand for the 256 bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordTable:
    """Ids of distinct space-separated chunks under a word-wise BPE tokenizer.

    White space never enters a token of such a tokenizer, so a text's ids are those of its
    chunks in turn. A chunk of Latin letters goes to the library's BPE model right away
    (its normaliser would lower-case it, its pre-tokenizer keep it whole), any other chunk
    through the whole tokenizer.
    """

    def __init__(self, content: bytes, limit: int = TABLE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.model, self.limit = self.tokenizer.model, limit
        letters = byte_letters()
        self.by_byte = {b: letters[b] for b in range(256)}
        self.clear()
        self._forget()
        self.plain = Tokenizer(self.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # The short way must give what the library gives, else everything goes the long way.
        sample = ["Été", "the", "naïve,", "Ørsted...", "STRAßE*#"]
        self.by_model = True
        self.learn(sample)
        encoded = self.tokenizer.encode_batch(sample, add_special_tokens=False)
        self.by_model = self.flat.tolist() == [i for e in encoded for i in e.ids]
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _forget(self) -> None:
        """Start the table of units: first the empty one, then words and closings."""
        self.words: dict[str, int] = {}
        self.closings: dict[str, int] = {"": 0}
        self.unit_lengths, self.unit_flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Rows of new units."""
        first = len(self.unit_lengths)
        self.unit_lengths = np.concatenate([self.unit_lengths, lengths])
        self.unit_flat = np.concatenate([self.unit_flat, ids.astype(np.uint32)])
        return np.arange(first, first + len(lengths))

    def _library(self, texts: list[str]) -> np.ndarray:
        """Units of texts that go through the whole tokenizer."""
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return self._add(lengths, np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum())))

    def _by_model(self, words: list[str]) -> np.ndarray:
        """Units of distinct lower-case words, many new words in one call."""
        new = [w for w in words if w not in self.words]
        if new:
            spelled = [w if w.isascii() else w.encode().decode("latin-1").translate(self.by_byte) for w in new]
            joined = [" ".join(spelled[i : i + _JOINED]) for i in range(0, len(spelled), _JOINED)]
            found = [e.ids for e in self.plain.encode_batch_fast(joined, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found)))
            lengths = np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0)
            self.words.update(zip(new, self._add(lengths, ids).tolist(), strict=True))
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def _encode_new(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of chunks: a word that the model can take alone in lower case and
        what closes it are a unit each, any other chunk is one."""
        if len(self.words) > self.limit or len(self.closings) > 10_000:
            self._forget()
        texts = pa.array(chunks, pa.string())
        cores = pc.utf8_rtrim(texts, CLOSING)
        alone = pc.match_substring_regex(cores, WORD) if self.by_model else pa.array(np.zeros(len(chunks), bool))
        taken = alone.to_numpy(zero_copy_only=False)
        units = np.zeros((len(chunks), 2), np.int64)
        lowered = pc.utf8_lower(cores.filter(alone)).dictionary_encode()
        units[taken, 0] = self._by_model(text_list(lowered.dictionary))[lowered.indices.to_numpy(zero_copy_only=False)]
        closing = pc.subtract(pc.binary_length(texts), pc.binary_length(cores)).to_numpy(zero_copy_only=False)
        closed = np.flatnonzero(taken & (closing > 0))
        ends = [chunks[k][-n:] for k, n in zip(closed.tolist(), closing[closed].tolist())]
        new = [e for e in dict.fromkeys(ends) if e not in self.closings]
        self.closings.update(zip(new, self._library(new).tolist(), strict=True))
        units[closed, 1] = [self.closings[e] for e in ends]
        kept = len(self.unit_lengths), len(self.unit_flat)
        hard = np.flatnonzero(~taken)
        units[hard, 0] = self._library([chunks[k] for k in hard.tolist()])
        positions, stops = spread(self.unit_lengths, units.ravel())
        flat = self.unit_flat[positions]
        self.unit_lengths, self.unit_flat = self.unit_lengths[: kept[0]], self.unit_flat[: kept[1]]
        return np.diff(stops[1::2], prepend=0), flat

    def learn(self, chunks: list[str]) -> np.ndarray:
        if len(self.rows) > self.limit:
            self.clear()
        rows = self.rows
        new = [c for c in chunks if c not in rows]
        if new:
            lengths, flat = self._encode_new(new)
            rows.update(zip(new, range(len(rows), len(rows) + len(new)), strict=True))
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, flat])
        return np.fromiter(map(rows.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and each text's offsets."""
        split = split_words(texts)
        index = self.learn(split.parts)[split.index]
        positions, ends = spread(self.lengths, index)
        cuts = np.concatenate([[0], ends])[split.offsets]
        ids = np.insert(self.flat[positions], cuts[1:], np.uint32(end_id))
        return ids, cuts + np.arange(len(cuts))


def _open(address: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(address if ":/" in address else f"file://{address}")


class Shard:
    """One shard, opened for keyed access: one probe of the index, one range of the ids."""

    def __init__(self, address: str, name: str, width: int):
        self.fs, self.root = _open(address)
        self.name, self.kind = name, np.dtype("<u2" if width == 2 else "<u4")
        content = self.fs.open_input_file(f"{self.root}/{name}.index").read()
        hash_bytes, keys, docs, self.nulls = struct.unpack_from("<qqqq", content)
        at = 32
        self.hash = PerfectHash.from_bytes(content[at : at + hash_bytes])
        at += hash_bytes

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        self.starts, self.sizes, self.repeats = take("<i8", keys), take("<i8", keys), take("<i8", keys)
        self.doc_ids, self.lengths = take("<i8", docs), take("<i8", docs)
        self.prints = take("<u4", keys)

    def locate(self, doc_ids: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that the shard lacks."""
        keys = np.asarray(doc_ids, np.int64)
        slots = self.hash.slots(keys)
        if not len(self.prints):
            return slots
        return np.where((slots >= 0) & (self.prints[slots] == fingerprints(keys)), slots, -1)

    def read(self, start: int, count: int) -> np.ndarray:
        with self.fs.open_input_file(f"{self.root}/{self.name}.ids") as file:
            return np.frombuffer(file.read_at(count * self.kind.itemsize, start * self.kind.itemsize), self.kind)

    def get(self, doc_id: int) -> np.ndarray | None:
        """Ids of the first document with this key, None without one."""
        (slot,) = self.locate(np.array([doc_id]))
        if slot < 0:
            return None
        return self.read(int(self.starts[slot]), int(self.sizes[slot]))


def _index(doc_ids: np.ndarray, nulls: int, lengths: np.ndarray) -> bytes:
    """Index of documents in key order, the ``nulls`` first ones without a key."""
    keys, first, repeats = np.unique(doc_ids[nulls:], return_index=True, return_counts=True)
    offsets = np.cumsum(lengths) - lengths
    ph = PerfectHash.build(keys)
    order = np.argsort(ph.slots(keys))
    starts, sizes = offsets[nulls:][first[order]], lengths[nulls:][first[order]]
    blob = ph.to_bytes()
    parts = [struct.pack("<qqqq", len(blob), len(keys), len(doc_ids), nulls), blob]
    parts += [x.astype("<i8").tobytes() for x in (starts, sizes, repeats[order], doc_ids, lengths)]
    return b"".join([*parts, fingerprints(keys[order]).astype("<u4").tobytes()])


def write_store(docs: DataFrame, tokenizer_path: str, address: str, end_id: int = 2) -> DataFrame:
    """Encode whole texts into a store at ``address``; returns its manifest.

    Null texts are empty and have the end id alone. Repeated keys keep all their documents,
    ordered by text; null keys come first and are found by scans only. No rows, no shards.
    """
    spark = docs.sparkSession
    table = Shipped(spark, tokenizer_path, WordTable)
    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id) < 1 << 16 else 4
    parts = max(docs.rdd.getNumPartitions(), 1)
    kind = "<u2" if width == 2 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (fs, root) = table.get(), _open(address)
        name = f"shard-{uuid.uuid4().hex}"
        keys, sizes, nulls, out = [], [], 0, None
        for batch in slices(batches):
            ids, offsets = words.encode(text_array(batch), end_id)
            out = out or fs.open_output_stream(f"{root}/{name}.ids")
            out.write(ids.astype(kind).tobytes())
            nulls += batch.column("doc_id").null_count
            keys.append(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            sizes.append(np.diff(offsets))
        if out is None:
            return
        out.close()
        doc_ids, lengths = np.concatenate(keys), np.concatenate(sizes)
        with fs.open_output_stream(f"{root}/{name}.index") as file:
            file.write(_index(doc_ids, nulls, lengths))
        row = {
            "shard": array([0], pa.int32()), "name": array([name], pa.string()),
            "n_docs": array([len(doc_ids)], pa.int64()), "n_tokens": array([int(lengths.sum())], pa.int64()),
            "width": array([width], pa.int32()),
            "first_doc_id": array([int(doc_ids[nulls])] if nulls < len(doc_ids) else [None], pa.int64()),
            "last_doc_id": array([int(doc_ids[-1])] if nulls < len(doc_ids) else [None], pa.int64()),
        }
        yield pa.RecordBatch.from_pydict(row)

    _open(address)[0].create_dir(_open(address)[1], recursive=True)
    ranged = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id")
    ordered = ranged.sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(run, MANIFEST).withColumn("shard", F.spark_partition_id())
    shards.write.parquet(f"{address}/manifest")
    return manifest(spark, address)


def manifest(spark: SparkSession, address: str) -> DataFrame:
    """Shards of a store in key order with ``start``, the number of ids before each."""
    found = spark.read.schema(MANIFEST).parquet(f"{address}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_store(spark: SparkSession, address: str) -> DataFrame:
    """All documents of a store: ``doc_id, start, n_tokens, ids_crc32``.

    Every key is looked up through its shard's perfect hash, and its ids are read from the
    place found there.
    """
    shards = manifest(spark, address)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(address, row["name"], row["width"])
                offsets = np.cumsum(shard.lengths) - shard.lengths
                keyed = shard.doc_ids[shard.nulls :]
                slots = shard.locate(keyed)
                # A key's slot has its first document; repeats follow it in the payload.
                ahead = offsets[shard.nulls :] - offsets[shard.nulls :][np.searchsorted(keyed, keyed)]
                offsets[shard.nulls :] = shard.starts[slots] + ahead
                step = 4096
                for a in range(0, len(offsets), step):
                    begin, sizes = offsets[a : a + step], shard.lengths[a : a + step]
                    ids = shard.read(int(begin[0]), int(sizes.sum())).astype("<u4")
                    at = begin - begin[0]
                    sums = [zlib.crc32(ids[i : i + n].tobytes()) for i, n in zip(at, sizes)]
                    missing = np.arange(a, a + len(begin)) < shard.nulls
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(shard.doc_ids[a : a + step], mask=missing),
                        "start": array(begin + row["start"], pa.int64()),
                        "n_tokens": array(sizes, pa.int64()),
                        "ids_crc32": array(sums, pa.int64()),
                    })

    count = max(shards.count(), 1)
    return shards.repartition(count).mapInArrow(run, schema)
