"""Tokenizer operators against the libraries, and the keyed store."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.frames import documents, frame, with_clashes
from wardline.llm import sentencepiece_codec, token_counts, token_store
from wardline.llm.perfect_hash import PerfectHash, fingerprints
from wardline.llm.queries import PIECE_MODEL, WORD_TOKENIZER

MODEL = public_tokenizers.path(PIECE_MODEL)
WORDS = public_tokenizers.path(WORD_TOKENIZER)
PARTS = ["a", "B", "the", " ", "  ", "▁", "\n", "é", "É", "日本", "🙂", "\0", "'s", ",", ".", "###", "<s>", "<|endoftext|>", "<0x41>", "İ", "1", "\t", "ﬁ"]
TEXTS = st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=20)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.ChunkTable(open(MODEL, "rb").read(), limit=50)


@pytest.fixture(scope="module")
def words():
    return token_store.WordTable(open(WORDS, "rb").read(), limit=50)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_chunks_encode_like_the_library(codec, pieces, texts):
    assert codec.separable
    ids, offsets = codec.encode(pa.array(texts))
    found = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert found == pieces.encode(texts)
    assert codec.join_decimals(ids, offsets) == [",".join(map(str, f)) for f in found]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_word_table_encodes_like_the_library(words, texts):
    assert words.by_model
    ids, offsets = words.encode(pa.array(texts), 2)
    expected = [e.ids + [2] for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(3, 12), st.integers(1, 4))
def test_spliced_counts_equal_whole_counts(pieces, texts, chunk, overlap):
    counter = _counter()
    counter.chunk, counter.overlap = chunk, overlap
    texts = [t * 5 for t in texts]
    assert counter.provable and counter.count(texts) == [len(i) for i in pieces.encode(texts)]


def _counter(cache=[]):  # noqa: B006
    if not cache:
        cache.append(token_counts.Counter(open(MODEL, "rb").read()))
    return cache[0]


def test_overlap_widens_where_nothing_is_stable(pieces):
    counter = token_counts.Counter(open(MODEL, "rb").read(), chunk=20, overlap=2)
    text = "a" * 400 + " b" * 50
    assert counter.count([text]) == [len(pieces.encode(text))] and counter.widened > 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal_and_fingerprints_reject_strangers(n):
    keys = np.random.default_rng(n).integers(-(2**62), 2**62, n)
    ph = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    slots = ph.slots(keys)
    assert sorted(slots) == list(range(n))
    if n:
        prints = np.zeros(n, np.uint32)
        prints[slots] = fingerprints(keys)
        strange = np.setdiff1d(np.arange(10_000), keys)
        hit = ph.slots(strange)
        assert ((hit >= 0) & (prints[hit] == fingerprints(strange))).sum() <= 1


@pytest.mark.parametrize("extra", [False, True])
def test_encode_documents(spark, pieces, extra):
    rows = documents()
    df = frame(spark, [*rows, rows[0]])
    found = sentencepiece_codec.encode_documents(with_clashes(df) if extra else df, MODEL, keep_ids=True).collect()
    assert len(found) == len(rows) + 1
    texts = {r[0]: r[1] or "" for r in rows}
    for row in found:
        ids = pieces.encode(texts[row.doc_id])
        assert row.ids == ids and row.n_tokens == len(ids) and row.decoded == pieces.decode(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()


def test_count_tokens(spark, pieces):
    rows = documents()
    found = token_counts.count_tokens(with_clashes(frame(spark, rows)), MODEL, limit=100).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(found) == len(rows)
    for row in found:
        n = len(pieces.encode(texts[row.doc_id]))
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (n, len(texts[row.doc_id].encode()), n > 100)


def test_store_round_trip(spark, tmp_path):
    rows = documents()
    random.Random(1).shuffle(rows)
    rows += [rows[0], (None, "no key", None, None, None)]
    address = str(tmp_path / "store")
    manifest = token_store.write_store(with_clashes(frame(spark, rows)).repartition(3), WORDS, address)
    library = tokenizers.Tokenizer.from_file(WORDS)
    start = 0
    expected = []
    for doc_id, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(r) for r in token_store.read_store(spark, address).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected
    shards = [token_store.Shard(address, r["name"], r["width"]) for r in manifest.collect()]
    ids = [s.get(rows[0][0]) for s in shards]
    assert [len(i) for i in ids if i is not None] == [len(library.encode(rows[0][1] or "", add_special_tokens=False).ids) + 1]
    assert all(s.get(10**12) is None for s in shards)


def test_lost_tasks_files_are_not_read(spark, tmp_path):
    address = str(tmp_path / "store")
    token_store.write_store(frame(spark, documents(10)), WORDS, address)
    before = token_store.read_store(spark, address).count()
    (tmp_path / "store" / "shard-lost.ids").write_bytes(b"\0\0")
    assert token_store.read_store(spark, address).count() == before


def test_empty_tables(spark, tmp_path):
    empty = frame(spark, [])
    assert sentencepiece_codec.encode_documents(empty, MODEL).count() == 0
    assert token_counts.count_tokens(empty, MODEL).count() == 0
    token_store.write_store(empty, WORDS, str(tmp_path / "store"))
    assert token_store.read_store(spark, str(tmp_path / "store")).count() == 0
