"""What keeps the text operators within their memory and CPU, beside equal results."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from wardline.llm import common, gated_lm, token_alignment, token_store


def test_slices_give_memory_back(monkeypatch):
    """pipeline: workers live on after a stage and shall not keep its heap."""
    calls = []
    monkeypatch.setattr(common, "_TRIM", calls.append)
    batch = pa.RecordBatch.from_pydict({"text": ["ab", None, "c" * 50]})
    assert sum(s.num_rows for s in common.slices(iter([batch, batch]), limit=10)) == 6
    assert len(calls) == 3


def test_words_stay_in_arrow_until_asked_for():
    """op7_gated_lm, op3_line_quality: parts become strings of Python on demand only."""
    split = common.split_words(pa.array(["a\tb  a", "", "\nc\x0bd\x0ce\rb "]))
    assert "parts" not in vars(split)
    assert [split.parts[k] for k in split.index] == ["a", "b", "a", "c", "d", "e", "b"]
    assert split.offsets.tolist() == [0, 3, 3, 7]


def test_training_steps_are_those_of_the_formulas():
    """op7_gated_lm: one window's steps in place give what the plain formulas give."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((7, 5)).astype(np.float32)
    plain = 1 / (1 + np.exp(-x))
    given = x.copy()
    assert gated_lm._sigmoid(given) is given and np.array_equal(given, plain)


def test_word_and_closing_are_units_of_their_own():
    """op2_token_store: a word is encoded once, whatever closes it and however it is written."""
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as file:
        table = token_store.WordTable(file.read())
    library = Tokenizer.from_file(path)
    known = len(table.words)
    chunks = ["Zörble", "zörble,", "ZÖRBLE...", "zörble", "it's", "ªx", "...", "Straße!", "日本", "x y"]
    rows = table.learn(chunks)
    assert len(table.words) == known + 1  # straße is known from the start
    starts = np.cumsum(table.lengths) - table.lengths
    for chunk, row in zip(chunks, rows):
        found = table.flat[starts[row] : starts[row] + table.lengths[row]].tolist()
        assert found == library.encode(chunk, add_special_tokens=False).ids, chunk
    table._forget()  # a full table starts again; what was learned stays
    assert table.learn(chunks + ["zörble;"]).tolist()[:-1] == rows.tolist()
    last = table.flat[int(table.lengths[:-1].sum()) :].tolist()
    assert last == library.encode("zörble;", add_special_tokens=False).ids


def test_chunks_share_calls_of_the_byte_level_library():
    """op13_token_alignment: many new chunks make one text; each gets its own ids."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        table = token_alignment.ByteLevel(file.read())
    library, given = table.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return library.encode_batch_fast(texts, **options)

    table.tokenizer = Counting()
    texts = [" ".join(f"w{k}é," for k in range(200)), "a\nb\n c it's ", "", " x y ", "two  spaces", "日本 <|endoftext|> x"]
    ids, offsets = table.encode(pa.array(texts))
    for text, a, b in zip(texts, offsets, offsets[1:]):
        if text:
            assert ids[a:b].tolist() == library.encode(" " + text, add_special_tokens=False).ids, text
    assert len(given) < 30
