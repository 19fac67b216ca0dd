"""Vector codes and token alignment against brute force."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.frames import documents, frame, with_clashes
from tests.llm.test_tokens import PARTS
from wardline.llm import token_alignment, vector_codes
from wardline.llm.queries import BYTE_TOKENIZER, PIECE_MODEL

# --- vector codes ----------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_codes(rows):
    kept = []
    for vec_id, value, label in rows:
        if value and None not in value and np.isfinite(value).all():
            kept.append((vec_id, np.floor(np.array(value, np.float64) * 1024).astype(int).tolist(), label))
    width = len(kept[0][1]) // 4 if kept else 0
    first = {}
    for vec_id, value, _ in sorted((k for k in kept if k[0] is not None), key=lambda k: k[:2]):
        first.setdefault(vec_id, value)
    heads = [first[i] for i in sorted(first)[:256]]
    books = [[h[p * width : (p + 1) * width] for h in heads] for p in range(4)]

    def assign(value):
        out = []
        for p in range(4):
            own = value[p * width : (p + 1) * width]
            out.append(min((sum((x - y) ** 2 for x, y in zip(own, e)), k) for k, e in enumerate(books[p])))
        return out

    for _ in range(4):
        found = [assign(v) for _, v, _ in kept]
        for p in range(4):
            for k in range(len(books[p])):
                mine = [v[p * width : (p + 1) * width] for (_, v, _), f in zip(kept, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [assign(v) for _, v, _ in kept]
    errors = Counter()
    for (_, _, label), f in zip(kept, found):
        errors[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return digest, sorted(
        (i if i is not None else -1, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), errors[label])
        for (i, _, label), f in zip(kept, found)
    )


def vectors(count, size, seed=0, grid=None):
    rng = np.random.default_rng(seed)
    values = rng.standard_normal((count, size)).astype(np.float32)
    if grid:
        values = (np.round(values * grid) / grid).astype(np.float32)
    return [(int(k), [float(x) for x in v], int(k % 3) if k % 7 else None) for k, v in zip(rng.permutation(count), values)]


@pytest.mark.parametrize("count, size, grid", [(330, 12, None), (300, 8, 2), (40, 4, 1), (1, 4, None)])
def test_codes_equal_brute_force(spark, count, size, grid):
    rows = vectors(count, size, grid=grid)
    nan = float("nan")
    rows += [rows[0], rows[0], (None, rows[0][1], 1), (rows[0][0], [0.25] * size, 2)]
    rows += [(900, None, 1), (901, [], 1), (902, [nan] * size, 1), (903, [None] * size, 1), (904, [float("inf")] * size, None)]
    df = with_clashes(spark.createDataFrame(rows, VECTORS)).withColumnRenamed("tokens", "code").repartition(3)
    coded, books = vector_codes.compress(df)
    digest, expected = brute_codes(rows)
    assert vector_codes.codebook_digest(books) == digest
    found = [(r.vec_id if r.vec_id is not None else -1, r.code, r.error, r.label_error) for r in coded.collect()]
    assert sorted(found) == expected


def test_codes_decode_within_their_error(spark):
    rows = vectors(300, 8)
    coded, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    values = {r[0]: np.floor(np.array(r[1], np.float64) * 1024) for r in rows}
    for row in coded.collect():
        assert ((vector_codes.decode(row.code, books) * 1024 - values[row.vec_id]) ** 2).sum() == row.error


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1, 2, 5, 400, 1 << 23]), st.integers(1, 9), st.integers(1, 60), st.integers(1, 9))
def test_nearest_equals_brute_force(seed, most, width, count, block):
    rng = np.random.default_rng(seed)
    parts = np.unique(rng.integers(-most, most, (count, width)), axis=0)
    entries = rng.integers(-most, most, (rng.integers(1, 40), width))
    code, error = vector_codes.nearest(parts, entries, block)
    distances = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == distances.argmin(axis=1)).all() and (error == distances.min(axis=1)).all()


def test_packed_parts_keep_their_order():
    parts = np.array([[-5, 3], [-5, -1], [0, 0], [7, -(1 << 24)], [-(1 << 24), 1 << 24]])
    packed = vector_codes.pack(parts)
    assert (vector_codes.unpack(packed, 2) == parts).all()
    assert sorted(packed) == [p for _, p in sorted(zip(parts.tolist(), packed))]


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0, 3.0], 1)], [(1, [1e9] * 4, 1)]])
def test_nothing_to_code(spark, rows):
    coded, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    assert coded.count() == 0 and books == []
    assert vector_codes.codebook_digest(books) == hashlib.sha256(b"").hexdigest()


def test_other_sizes_and_huge_numbers_are_left_out(spark):
    rows = vectors(20, 4) + [(500, [1.0] * 8, 1), (501, [1e30] * 4, 1), (502, [20_000.0] * 4, 1)]
    coded, _ = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    assert sorted(r.vec_id for r in coded.collect()) == list(range(20))


# --- alignment -------------------------------------------------------------------------

BYTES, MODEL = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)
TEXTS = st.lists(st.lists(st.sampled_from([*PARTS, " ", " ", "12", "don't", "\r\n", "▁"]), max_size=14).map("".join), min_size=1, max_size=12)


@pytest.fixture(scope="module")
def byte_level():
    return token_alignment.ByteLevel(open(BYTES, "rb").read(), limit=50)


@pytest.fixture(scope="module")
def pieces():
    return token_alignment.Pieces(open(MODEL, "rb").read(), limit=50)


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def brute_alignment(rows, library):
    """Ids, groups and links of each row by comparing all token ranges."""
    tokenizer, processor = library
    letters = {c: bytes([b]) for b, c in enumerate(token_alignment.byte_letters())}
    per_row, counts = [], Counter()
    for doc_id, text in rows:
        text = text or ""
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = processor.encode(text)
        spell_a = [b"".join(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        spell_b = [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [processor.id_to_piece(i)]]
        whole = (" " + text).encode()
        if not text or b"".join(spell_a) != whole or b"".join(spell_b) != whole:
            per_row.append((doc_id, [], [], "", []))
            continue
        ends_a, ends_b = np.cumsum([len(s) for s in spell_a]), np.cumsum([len(s) for s in spell_b])
        common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, at = [], 0
        for end in common:
            own_a = [str(i) for i, e in zip(a, ends_a) if at < e <= end]
            own_b = [str(i) for i, e in zip(b, ends_b) if at < e <= end]
            groups.append(",".join(own_a) + "|" + ",".join(own_b))
            at = end
        links = []
        starts_a, starts_b = ends_a - [len(s) for s in spell_a], ends_b - [len(s) for s in spell_b]
        for i, sa, ea in zip(a, starts_a, ends_a):
            for k in np.flatnonzero((starts_b < ea) & (ends_b > sa)):
                links.append((i, b[k]))
        counts.update(links)
        per_row.append((doc_id, a, b, hashlib.sha256(";".join(groups).encode()).hexdigest(), links, len(groups)))
    best = Counter()
    for (i, k), c in counts.items():
        best[k] = max(best[k], c)
    out = []
    for doc_id, a, b, digest, links, *groups in per_row:
        n_best = sum(counts[link] == best[link[1]] for link in links)
        out.append((doc_id, len(a), len(b), groups[0] if groups else 0, len(links), n_best, sum(counts[k] for k in links), digest))
    return out


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_byte_level_encodes_like_the_library(byte_level, library, texts):
    assert byte_level.separable
    ids, offsets = byte_level.encode(pa.array(texts))
    found = [ids[x:y].tolist() for x, y in zip(offsets, offsets[1:])]
    assert found == [library[0].encode(" " + t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_batches_equal_brute_force(byte_level, pieces, library, texts):
    decimals = token_alignment._Decimals(60_000)
    found = token_alignment.align_batch(pa.array(texts), byte_level, pieces, decimals)
    expected = brute_alignment(list(enumerate(texts)), library)
    columns = [found[c].tolist() for c in ("n_a", "n_b", "n_groups", "n_links")]
    assert list(zip(*columns, found["groups_sha256"])) == [(*e[1:5], e[7]) for e in expected]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=30), st.lists(st.integers(0, 70), max_size=30), st.data())
def test_gallop_finds_ranks(among, ends, data):
    among, ends = np.unique(among), np.array(ends, np.int64)
    low = np.array([data.draw(st.integers(0, len(among))) for _ in ends], np.int64)
    high = np.array([data.draw(st.integers(int(k), len(among))) for k in low], np.int64)
    guess = np.array([data.draw(st.integers(-3, len(among) + 3)) for _ in ends], np.int64)
    found = token_alignment.gallop(ends, among, low, high, guess)
    assert found.tolist() == [int(k + np.searchsorted(among[k:h], e)) for e, k, h in zip(ends, low, high)]


def test_alignment_equals_brute_force(spark, library, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 6000)
    rows = documents() + [(500, "a  b ▁ c", None, None, 1), (501, "<s> <|endoftext|> <0x41>", None, None, 1), (502, "日本語 🙂🙂 naïve", None, None, 1)]
    rows += [rows[0], rows[0], (None, "no id here", None, None, 1)]
    df = with_clashes(frame(spark, rows)).withColumnRenamed("a", "pair").repartition(3)
    found = sorted((tuple(r) for r in token_alignment.align(df, BYTES, MODEL).collect()), key=str)
    assert found == sorted(brute_alignment([r[:2] for r in rows], library), key=str)
    assert sum(r[5] < r[4] for r in found) > 50 and any(r[1] == 0 for r in found)


def test_alignment_of_nothing(spark):
    assert token_alignment.align(frame(spark, []), BYTES, MODEL).count() == 0
    (row,) = token_alignment.align(frame(spark, [(1, None, None, None, None)]), BYTES, MODEL).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "")


def test_chunks_without_a_free_character(pieces, library):
    text = "".join(chr(c) for c in range(0xE000, 0xF900)) + "  b"
    ids, offsets = pieces.encode(pa.array([text, "a b"]))
    assert [ids[x:y].tolist() for x, y in zip(offsets, offsets[1:])] == library[1].encode([text, "a b"])
