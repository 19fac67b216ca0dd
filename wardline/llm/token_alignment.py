"""Alignment of two tokenizers' tokens by the byte offsets where both end.

**Ends.** A text's tokens under A and under B spell the same bytes, so each tokenizer gives
an ascending list of end offsets. The shorter list drives: each of its ends gallops through
the longer one (steps of 1, 2, 4, ... from a guess, then a binary search between the last
two stops) to its rank there. All ends of a block of texts take their steps side by side.

**Groups and links.** Ends found in both lists cut the tokens into groups. The ranks of two
neighbouring ends differ by the number of the other list's tokens that overlap the token
between them, so every token's partners are one range, without comparing tokens.

**Counts.** Each block keeps its documents' links as numbers into its own dictionary of
pairs. Dictionary entries are added up by pair over all blocks, and each block gets the
totals of its own pairs back: a pair that stands in every text is one row per block, and no
table of the corpus's pairs is ever in one place.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from wardline.llm.common import Shipped, Split, array, slices, spread, text_array
from wardline.llm.sentencepiece_codec import ChunkTable
from wardline.llm.token_store import byte_letters
from wardline.operators.store import materialize

MARK = "▁"
BLOCK_BYTES = 4 << 20
# Texts of a block are aligned so many bytes at a time, and encoded so many chunks at a time.
STEP_BYTES, STEP_CHUNKS = 512 << 10, 1 << 13
JOINED = 50
TABLE_CHUNKS = 100_000
# Pairs are one number: A's id times this plus B's id.
PAIR = 1 << 32
_HASHED_TOKENS = 1 << 17


class ByteTable:
    """Bytes of each id, end to end."""

    def __init__(self, entries: list[bytes]):
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.lengths = np.array([len(e) for e in entries], np.int64)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        positions, _ = spread(self.lengths, ids)
        return self.flat[positions]


class ByteLevel:
    """A byte-level BPE of the tokenizers library, with a bounded table of distinct chunks.

    Its pre-tokenizer starts a token before every space that follows a character other than
    white space, whatever comes before. So a text without two spaces in a row is encoded
    chunk by chunk, a chunk being a space and what follows up to the next one; other texts
    go to the library whole, as do all texts of a tokenizer of another make. New chunks go to
    it many in one text, for a call costs more than a chunk.
    """

    def __init__(self, content: bytes, limit: int = TABLE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.encode_special_tokens = True
        self.limit = limit
        codes = {c: b for b, c in enumerate(byte_letters())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # Ids beyond the vocabulary are special tokens, which no text yields.
        entries = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for token, number in vocabulary.items():
            entries[number] = bytes(codes[c] for c in token) if codes.keys() >= set(token) else token.encode()
        self.bytes = ByteTable(entries)
        self.opens = np.array([e[:1] == b" " for e in entries])
        pieces = str(self.tokenizer.pre_tokenizer)
        self.separable = (
            self.tokenizer.normalizer is None
            and re.fullmatch(r"ByteLevel\(add_prefix_space=False, trim_offsets=\w+, use_regex=True\)", pieces) is not None
        )
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int]] = []
        for at in range(0, len(texts), STEP_CHUNKS):
            found += [e.ids for e in self.tokenizer.encode_batch_fast(texts[at : at + STEP_CHUNKS], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each chunk, where no chunk is empty or has white space: a token
        that begins with a space begins a chunk."""
        flat, lengths = self._library([" " + " ".join(chunks[i : i + JOINED]) for i in range(0, len(chunks), JOINED)])
        starts = np.flatnonzero(self.opens[flat])
        if len(starts) != len(chunks):
            return self._library([" " + c for c in chunks])
        return flat, np.diff(starts, append=len(flat))

    def _learn(self, chunks: list[str]) -> np.ndarray:
        if len(self.rows) > self.limit:
            self.clear()
        missing = [c for c in chunks if c not in self.rows]
        if missing:
            plain = [c for c in missing if c.split() == [c]]
            known = set(plain)
            others = [c for c in missing if c not in known]
            new = plain + others
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            parts = self._joined(plain), self._library([" " + c for c in others])
            flat, lengths = (np.concatenate(both) for both in zip(*parts))
            self.flat, self.lengths = np.concatenate([self.flat, flat]), np.concatenate([self.lengths, lengths])
        return np.fromiter(map(self.rows.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, texts: pa.Array, split: Split | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each text, and each text's offsets. ``split`` is that at spaces
        of texts without runs of them."""
        if not self.separable:
            flat, lengths = self._library([" " + t for t in texts.to_pylist()])
            return flat, np.concatenate([[0], np.cumsum(lengths)])
        if split is None:
            runs = pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, "  "))
            split = Split(pc.if_else(runs, "", texts), " ")
        else:
            runs = pa.array(np.zeros(len(texts), bool))
        index = self._learn(split.parts)[split.index]
        positions, ends = spread(self.lengths, index)
        offsets = np.concatenate([[0], ends])[split.offsets]
        ids = self.flat[positions]
        if not pc.any(runs).as_py():
            return ids, offsets
        flat, lengths = self._library([" " + t for t in texts.filter(runs).to_pylist()])
        whole = runs.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        both = np.concatenate([ids, flat])
        starts, taken = offsets[:-1].copy(), sizes.copy()
        starts[whole], taken[whole] = len(ids) + np.cumsum(lengths) - lengths, lengths
        ends = np.cumsum(taken)
        return both[np.repeat(starts - (ends - taken), taken) + np.arange(int(ends[-1]))], np.concatenate([[0], ends])


class Pieces(ChunkTable):
    """A SentencePiece model with the bytes of its pieces."""

    def __init__(self, model: bytes, limit: int = TABLE_CHUNKS):
        super().__init__(model, limit)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        byte = sentencepiece_model_pb2.ModelProto.SentencePiece.BYTE
        self.bytes = ByteTable([
            bytes([int(p.piece[3:5], 16)]) if p.type == byte else p.piece.replace(MARK, " ").encode() for p in spec.pieces
        ])


def gallop(ends: np.ndarray, among: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Rank of each of ``ends`` in ``among``: where the first value not below it stands.

    The search of each end is within ``low`` to ``high`` of ``among``, ascending there, and
    starts at its guess. Steps double until they pass the end, then the rank is bisected.
    """
    # Invariant of the result: among[left - 1] < end <= among[right], for the bounds' values
    # as if nothing stood below low and everything from high on were greater.
    left, right = low.copy(), high.copy()
    at = np.clip(guess, low, np.maximum(high - 1, low))
    step = np.ones(len(ends), np.int64)
    live = np.flatnonzero(high > low)
    upward = np.zeros(len(ends), bool)
    upward[live] = among[at[live]] < ends[live]
    while len(live):  # exponential search, away from the guess
        here = at[live]
        below = among[here] < ends[live]
        up = upward[live]
        left[live[below]] = here[below] + 1
        right[live[~below]] = here[~below]
        on = below == up
        following = np.where(up, here + step[live], here - step[live])
        on &= (following < right[live]) & (following >= left[live])
        live, following = live[on], following[on]
        at[live] = following
        step[live] *= 2
    live = np.flatnonzero(left < right)
    while len(live):  # binary search between the last two stops
        middle = (left[live] + right[live]) // 2
        below = among[middle] < ends[live]
        left[live[below]] = middle[below] + 1
        right[live[~below]] = middle[~below]
        live = live[left[live] < right[live]]
    return left


def ranks(driver: np.ndarray, driver_offsets: np.ndarray, other: np.ndarray, other_offsets: np.ndarray) -> np.ndarray:
    """Rank of each driver end among its own text's ends in the other list (positions in
    the joined list). Each guess lies in proportion to the end's place in its text."""
    sizes, others = np.diff(driver_offsets), np.diff(other_offsets)
    place = np.arange(len(driver)) - np.repeat(driver_offsets[:-1], sizes)
    share = others / np.maximum(sizes, 1)
    low = np.repeat(other_offsets[:-1], sizes)
    guess = low + (place * np.repeat(share, sizes)).astype(np.int64)
    return gallop(driver, other, low, np.repeat(other_offsets[1:], sizes), guess)


def link(a_ends: np.ndarray, a_offsets: np.ndarray, b_ends: np.ndarray, b_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which A ends and which B ends are common, and all overlaps as positions in A and B.

    The ends of each text ascend to the same last value. A text's shorter list drives.
    """
    a_sizes, b_sizes = np.diff(a_offsets), np.diff(b_offsets)
    a_common, b_common = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    found_a, found_b = [], []
    for by_a in (True, False):
        chosen = (a_sizes <= b_sizes) == by_a
        if not chosen.any():
            continue
        mine, theirs = np.flatnonzero(np.repeat(chosen, a_sizes)), np.flatnonzero(np.repeat(chosen, b_sizes))
        left = np.concatenate([[0], np.cumsum(a_sizes[chosen])]), a_ends[mine], mine
        right = np.concatenate([[0], np.cumsum(b_sizes[chosen])]), b_ends[theirs], theirs
        (offsets, ends, own), (other_offsets, among, partner) = (left, right) if by_a else (right, left)
        rank = ranks(ends, offsets, among, other_offsets)
        common = among[rank] == ends
        # A token overlaps from after the rank of the end before it, or from there where
        # that end is not common, up to its own end's rank.
        first = np.concatenate([[0], rank[:-1] + common[:-1]])[: len(rank)]
        starts = offsets[:-1][np.diff(offsets) > 0]
        first[starts] = other_offsets[:-1][np.diff(offsets) > 0]
        taken = rank - first + 1
        stops = np.cumsum(taken)
        driven = np.repeat(np.arange(len(ends)), taken)
        reached = np.repeat(first - (stops - taken), taken) + np.arange(int(stops[-1]) if len(stops) else 0)
        own_common, partner_common = (a_common, b_common) if by_a else (b_common, a_common)
        own_common[own[common]] = True
        partner_common[partner[rank[common]]] = True
        found_a.append(own[driven] if by_a else partner[reached])
        found_b.append(partner[reached] if by_a else own[driven])
    none = np.zeros(0, np.int64)
    return a_common, b_common, np.concatenate(found_a or [none]), np.concatenate(found_b or [none])


class _Decimals(ByteTable):
    """Decimal digits of numbers, each followed by one byte for a separator."""

    def __init__(self, count: int):
        super().__init__([b"%d," % k for k in range(count)])


def group_digests(a: np.ndarray, a_common: np.ndarray, a_offsets: np.ndarray, b: np.ndarray, b_common: np.ndarray, b_offsets: np.ndarray, decimals: ByteTable) -> list[str]:
    """sha256 of each text's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    # Group of each token: how many common ends stand before it; groups of texts do not mix,
    # for each text's last end is common.
    a_group, b_group = np.cumsum(a_common) - a_common, np.cumsum(b_common) - b_common
    groups = int(a_common.sum())
    a_sizes, b_sizes = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    b_before, a_through = np.cumsum(b_sizes) - b_sizes, np.cumsum(a_sizes)
    ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    a_place = np.arange(len(a)) + (b_before[a_group] if groups else 0)
    b_place = np.arange(len(b)) + (a_through[b_group] if groups else 0)
    ids[a_place], ids[b_place] = a, b
    marks[a_place[a_common]], marks[b_place[b_common]] = ord("|"), ord(";")
    offsets, out, doc = a_offsets + b_offsets, [], 0
    while doc < len(offsets) - 1:
        stop = max(doc + 1, int(np.searchsorted(offsets, offsets[doc] + _HASHED_TOKENS, side="right")) - 1)
        own = ids[offsets[doc] : offsets[stop]]
        content = decimals.spell(own)
        ends = np.cumsum(decimals.lengths[own])
        content[ends - 1] = marks[offsets[doc] : offsets[stop]]
        cuts = np.concatenate([[0], ends])[offsets[doc : stop + 1] - offsets[doc]].tolist()
        raw = content.tobytes()
        out += [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]
        doc = stop
    return out


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32 byte by byte; small ones leave planes of zeros."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(content: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(content, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _spelled(table: ByteTable, ids: np.ndarray, offsets: np.ndarray, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which texts' ids spell their bytes; ``raw`` has the texts' bytes, ``sizes`` each."""
    ends = np.concatenate([[0], np.cumsum(table.lengths[ids])])
    same = np.diff(ends[offsets]) == sizes
    if same.all():
        wrong = table.spell(ids) != raw
        text_of = np.repeat(np.arange(len(sizes)), sizes)
    else:
        own = np.repeat(same, np.diff(offsets))
        wrong = table.spell(ids[own]) != raw[np.repeat(same, sizes)]
        text_of = np.repeat(np.flatnonzero(same), sizes[same])
    same[text_of[wrong]] = False
    return same


def align_batch(texts: pa.Array, a: ByteLevel, b: Pieces, decimals: ByteTable) -> dict:
    """Numbers of each text, and its links as ``pairs`` (distinct), and per text the sorted
    ``index`` of its distinct pairs with their ``times``."""
    split = b.plain_chunks(texts) if a.separable else None
    a_ids, a_offsets = a.encode(texts, split)
    b_ids, b_offsets = b.encode(texts, split)
    spaced = pc.binary_join_element_wise(" ", texts, "").cast(pa.binary())
    sizes = pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(spaced.to_pylist()), np.uint8)
    good = _spelled(a.bytes, a_ids, a_offsets, raw, sizes) & _spelled(b.bytes, b_ids, b_offsets, raw, sizes) & (sizes > 1)
    if not good.all():
        a_ids, b_ids = a_ids[np.repeat(good, np.diff(a_offsets))], b_ids[np.repeat(good, np.diff(b_offsets))]
        a_offsets = np.concatenate([[0], np.cumsum(np.where(good, np.diff(a_offsets), 0))])
        b_offsets = np.concatenate([[0], np.cumsum(np.where(good, np.diff(b_offsets), 0))])
    # Ends on one scale for the block: those of all good texts, one after another.
    a_ends, b_ends = np.cumsum(a.bytes.lengths[a_ids]), np.cumsum(b.bytes.lengths[b_ids])
    a_common, b_common, left, right = link(a_ends, a_offsets, b_ends, b_offsets)
    text_of = np.repeat(np.arange(len(texts)), np.diff(a_offsets))
    pairs, place = np.unique(a_ids[left].astype(np.int64) * PAIR + b_ids[right], return_inverse=True)
    owner = text_of[left]
    keys, times = np.unique(owner * max(len(pairs), 1) + place, return_counts=True)
    key_text, index = np.divmod(keys, max(len(pairs), 1))
    count = len(texts)
    common_before = np.concatenate([[0], np.cumsum(a_common)])
    return {
        "n_a": np.diff(a_offsets), "n_b": np.diff(b_offsets),
        "n_groups": np.diff(common_before[a_offsets]),
        "n_links": np.bincount(owner, minlength=count),
        "groups_sha256": group_digests(a_ids, a_common, a_offsets, b_ids, b_common, b_offsets, decimals),
        "n_pairs": np.bincount(key_text, minlength=count),
        "pairs": pairs, "index": index, "times": times,
    }


_TEXTS = ("n_a", "n_b", "n_groups", "n_links", "n_pairs")


def align_block(batch: pa.RecordBatch, a: ByteLevel, b: Pieces, decimals: ByteTable) -> dict:
    """``align_batch`` of a block's texts, some at a time, with one dictionary of pairs."""
    parts = [align_batch(text_array(step), a, b, decimals) for step in slices(iter([batch]), limit=STEP_BYTES)]
    pairs = np.unique(np.concatenate([p["pairs"] for p in parts]))
    index = np.concatenate([np.searchsorted(pairs, p["pairs"])[p["index"]] for p in parts])
    out = {k: np.concatenate([p[k] for p in parts]) for k in (*_TEXTS, "times")}
    return out | {"pairs": pairs, "index": index, "groups_sha256": list(chain.from_iterable(p["groups_sha256"] for p in parts))}


def blocks(docs: DataFrame, byte_level: Shipped, pieces: Shipped) -> DataFrame:
    """One row per block of texts: its documents' numbers, their links, its dictionary."""
    schema = "doc_ids array<bigint>, groups_sha256 array<string>, index binary, times binary, pairs array<bigint>, totals array<bigint>"
    schema += "".join(f", {c} array<bigint>" for c in _TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level.get(), pieces.get()
        decimals = _Decimals(max(len(a.bytes.lengths), len(b.bytes.lengths)))
        for batch in slices(batches, limit=BLOCK_BYTES):
            found = align_block(batch, a, b, decimals)
            index = found["index"]
            # Ascending within a document: differences are small.
            starts = np.cumsum(found["n_pairs"]) - found["n_pairs"]
            steps = np.diff(index, prepend=0)
            heads = starts[found["n_pairs"] > 0]
            steps[heads] = index[heads]
            totals = np.bincount(index, weights=found["times"], minlength=len(found["pairs"])).astype(np.int64)
            columns = {
                "doc_ids": array([batch.column("doc_id").cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                "groups_sha256": array([found["groups_sha256"]], pa.list_(pa.string())),
                "index": array([_planes(steps)], pa.binary()),
                "times": array([_planes(found["times"])], pa.binary()),
                "pairs": array([found["pairs"]], pa.list_(pa.int64())),
                "totals": array([totals], pa.list_(pa.int64())),
            }
            columns |= {c: array([found[c]], pa.list_(pa.int64())) for c in _TEXTS}
            yield pa.RecordBatch.from_pydict(columns)
        a.clear()  # workers live on; later stages need the memory
        b.clear()

    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
    return found.withColumn("block", F.monotonically_increasing_id())


def pair_counts(entries: DataFrame) -> DataFrame:
    """``pair, c, best``: each pair's links in the corpus, and whether no other A id has
    more with the same B id."""
    totals = materialize(entries.groupBy("pair").agg(F.sum("total").alias("c")), "align-pairs")
    by_b: Column = F.col("pair") % F.lit(PAIR)
    tops = totals.groupBy(by_b.alias("b")).agg(F.max("c").alias("top"))
    return totals.join(tops, by_b == F.col("b")).select("pair", "c", (F.col("c") == F.col("top")).alias("best"))


def align(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row.

    A is a byte-level BPE file of the tokenizers library, read with a space in front of the
    text; B is a SentencePiece model, which adds that space. Null and empty texts, and texts
    whose tokens under A or under B do not spell the space and the text, have no tokens:
    zeros and an empty digest. Repeated rows are repeated, and each counts. Further columns
    are not read. An empty table gives no rows. Memory grows with the longest text.
    """
    spark = docs.sparkSession
    written = materialize(blocks(docs, Shipped(spark, byte_level_path, ByteLevel), Shipped(spark, piece_path, Pieces)), "align-blocks")
    entry = F.posexplode(F.arrays_zip("pairs", "totals")).alias("pos", "entry")
    entries = written.select("block", entry).select("block", "pos", F.col("entry.pairs").alias("pair"), F.col("entry.totals").alias("total"))
    look = entries.select("block", "pos", "pair").join(pair_counts(entries), "pair")
    look = look.select(F.col("block").alias("in_block"), "pos", "c", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(key: tuple, found: pa.Table, known: pa.Table) -> pa.Table:
        counts = np.zeros(known.num_rows, np.int64)
        best = np.zeros(known.num_rows, np.int64)
        at = known["pos"].to_numpy()
        counts[at], best[at] = known["c"].to_numpy(), known["best"].to_numpy()
        out = []
        for row in found.to_pylist():  # one block
            sizes = np.array(row["n_pairs"], np.int64)
            steps, times = _unplanes(row["index"]), _unplanes(row["times"])
            sums, starts = np.cumsum(steps), np.cumsum(sizes) - sizes
            before = np.concatenate([[0], sums])[starts]
            index = sums - np.repeat(before, sizes)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            n_best, count_sum = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(n_best, owner, times * best[index])
            np.add.at(count_sum, owner, times * counts[index])
            out.append({"doc_id": row["doc_ids"], "n_best": n_best, "count_sum": count_sum} | {n: row[n] for n in names if n in row})
        kinds = [pa.int64()] * 7 + [pa.string()]
        columns = [pa.concat_arrays([array(o[n], kind) for o in out] or [array([], kind)]) for n, kind in zip(names, kinds)]
        return pa.table(columns, names)

    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'bigint'}" for n in names)
    return written.drop("pairs", "totals").groupBy("block").cogroup(look.groupBy("in_block")).applyInArrow(run, schema)
