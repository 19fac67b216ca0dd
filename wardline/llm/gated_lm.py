"""Gated recurrent word model: training by truncated backpropagation, and scoring.

**Counts.** The corpus is cut into blocks of text. A block keeps its documents as numbers
into its own dictionary. Dictionary entries are added up by word over all blocks, and each
block gets the totals of its own words back: no dictionary of the corpus is ever in one
place, and what is shuffled grows with the corpus.

**Model.** The ``VOCABULARY`` most frequent words and the end of a text are single words of
the model; all other known words are one class, in which a word has its smoothed share of
the class's counts; all unknown words are one cell, with the share of words seen once. The
output is factored: the class of the next word by a softmax over classes, then the word by
a softmax over its class. Classes hold about equal sums of root frequencies.

**Training.** Lanes of whole documents run side by side through the recurrence; its state
is carried from window to window and emptied where a document starts, gradients stop at
the window's edge. Every training token is used once. A first share of the blocks trains
from the start values, the rest from the mean of what came out; tasks average their
weights, by tokens, in a tree. The model's size is fixed; only it reaches the driver.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import array, slices, split_words, text_array
from wardline.operators.store import materialize

VOCABULARY = 2048
CLASSES = 32
HIDDEN = 16
WINDOW = 64
LANES = 256
RATE = 0.15
FIRST_SHARE = 8  # one block in so many trains first
BLOCK_BYTES = 8 << 20
END = 0
_TREE = 32


# --- counts --------------------------------------------------------------------------


def pack(index: np.ndarray) -> bytes:
    """Numbers below 2^32 byte by byte: frequent words have low numbers, so the planes of
    the higher bytes compress well."""
    return index.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(content: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(content, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def text_blocks(docs: DataFrame, held: Column) -> DataFrame:
    """One row per block: its documents, their words as numbers, and its dictionary."""
    schema = (
        "doc_ids array<bigint>, held array<boolean>, lengths array<bigint>, index binary,"
        " words array<string>, trained array<bigint>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BLOCK_BYTES):
            split = split_words(pc.ascii_lower(text_array(batch)))
            # The most frequent words first; an empty part is not a word and is used nowhere.
            times = np.bincount(split.index, minlength=len(split.dictionary))
            order = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
            ranks = np.zeros(len(split.dictionary), np.int64)
            ranks[order] = np.arange(len(order))
            index, words = ranks[split.index], split.dictionary.take(pa.array(order))
            lengths = np.diff(split.offsets)
            out = batch.column("held").to_numpy(zero_copy_only=False)
            trained = np.bincount(index[np.repeat(~out, lengths)], minlength=len(words))
            yield pa.RecordBatch.from_pydict({
                "doc_ids": array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "held": array([out.tolist()], pa.list_(pa.bool_())),
                "lengths": array([lengths], pa.list_(pa.int64())),
                "index": array([pack(index)], pa.binary()),
                "words": pa.ListArray.from_arrays(array([0, len(words)], pa.int32()), words),
                "trained": array([trained[: len(words)]], pa.list_(pa.int64())),
            })

    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held.alias("held"))
    return found.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


# --- model ---------------------------------------------------------------------------


class Model:
    """Weights by name, and the layout of classes."""

    def __init__(self, words: list[str], counts: np.ndarray, rare: float, unseen: float):
        """``counts`` of the end and of ``words`` in falling order; ``rare`` is the sum of
        the other known words' counts, ``unseen`` the probability of the unknown cell."""
        self.ids = {w: k + 1 for k, w in enumerate(words)}
        self.size, self.unseen = len(counts), min(max(unseen, 1e-12), 0.5)
        mass = np.cumsum(np.sqrt(counts))
        self.word_class = np.minimum((mass - np.sqrt(counts)) / mass[-1] * CLASSES, CLASSES - 1).astype(np.int64)
        self.word_class = np.unique(self.word_class, return_inverse=True)[1]
        self.classes = int(self.word_class.max()) + 1
        self.first = np.searchsorted(self.word_class, np.arange(self.classes + 1))
        sums = np.append(np.bincount(self.word_class, weights=counts), rare) + 0.5
        rng = np.random.default_rng(7)
        self.weights = {
            "inputs": (rng.standard_normal((self.size + 2, 3 * HIDDEN)) * 0.3).astype(np.float32),
            "turn": (rng.standard_normal((HIDDEN, 3 * HIDDEN)) / math.sqrt(HIDDEN)).astype(np.float32),
            "class": np.zeros((HIDDEN, self.classes + 1), np.float32),
            "class_bias": np.log(sums / sums.sum()).astype(np.float32),
            "word": np.zeros((self.size, HIDDEN), np.float32),
            "word_bias": np.log(counts + 0.5).astype(np.float32),
        }
        self.weights["inputs"][:, :HIDDEN] += 1.0  # at first the state is kept for long
        self.rare, self.unknown = self.size, self.size + 1  # numbers of the two other inputs

    def to_bytes(self) -> bytes:
        return b"".join(self.weights[k].tobytes() for k in sorted(self.weights))

    def load(self, content: np.ndarray) -> None:
        at = 0
        for name in sorted(self.weights):
            size = self.weights[name].size
            self.weights[name] = content[at : at + size].reshape(self.weights[name].shape).astype(np.float32)
            at += size


def lanes(tokens: np.ndarray, lengths: np.ndarray, most: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """Documents dealt to lanes of about equal length, longest lane first: tokens and owners
    (lane, time), -1 behind a lane's end. ``tokens`` has the documents one after another."""
    total, longest = int(lengths.sum()), int(lengths.max())
    # The table of lanes stays within a few times the tokens, however long one document is.
    width = max(1, min(most, total // (8 * WINDOW), 8 * total // longest, len(lengths)))
    heap = [(0, lane) for lane in range(width)]
    members: list[list[int]] = [[] for _ in range(width)]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        size, lane = heapq.heappop(heap)
        members[lane].append(doc)
        heapq.heappush(heap, (size + int(lengths[doc]), lane))
    heap.sort(key=lambda entry: (-entry[0], entry[1]))
    starts = np.cumsum(lengths) - lengths
    shape = (width, heap[0][0])
    dealt, owners = np.full(shape, -1, np.int32), np.full(shape, -1, np.int32)
    for row, (_, lane) in enumerate(heap):
        at = 0
        for doc in members[lane]:
            n = int(lengths[doc])
            dealt[row, at : at + n] = tokens[starts[doc] : starts[doc] + n]
            owners[row, at : at + n] = doc
            at += n
    return dealt, owners


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.divide(1, x, out=x)


def _windows(dealt: np.ndarray, owners: np.ndarray) -> Iterator[tuple]:
    """Per window of time: inputs, targets, owners and document starts, each (time, lane),
    of the lanes that have not ended before it."""
    ends = (owners >= 0).sum(axis=1)
    for at in range(0, dealt.shape[1], WINDOW):
        live = int((ends > at).sum())
        before = max(at - 1, 0)
        targets, owner = dealt[:live, at : at + WINDOW].T, owners[:live, at : at + WINDOW].T
        ahead, ahead_owner = dealt[:live, before : at + WINDOW].T, owners[:live, before : at + WINDOW].T
        if not at:
            ahead = np.concatenate([np.full((1, live), -1), ahead])
            ahead_owner = np.concatenate([np.full((1, live), -2), ahead_owner])
        first = owner != ahead_owner[: len(owner)]
        inputs = np.where(first | (ahead[: len(owner)] < 0), END, ahead[: len(owner)])
        yield inputs, targets, owner, first


def _recur(w: dict, inputs: np.ndarray, first: np.ndarray, state: np.ndarray, keep: bool) -> tuple:
    """States (time, lane, hidden) of one window, and what backpropagation needs."""
    given = w["inputs"].take(inputs, axis=0)
    h2 = 2 * HIDDEN
    states, state = np.empty((*inputs.shape, HIDDEN), np.float32), state[: inputs.shape[1]]
    memory = [np.empty_like(states) for _ in range(5)] if keep else None
    for t in range(len(inputs)):
        if first[t].any():
            state = np.where(first[t][:, None], np.float32(0), state)
        turned = state @ w["turn"]
        gates = _sigmoid(given[t, :, :h2] + turned[:, :h2])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = r * turned[:, h2:]
        new += given[t, :, h2:]
        np.tanh(new, out=new)
        if keep:
            for kept, value in zip(memory, (state, z, r, turned[:, h2:], new)):
                kept[t] = value
        state = np.subtract(state, new, out=states[t])
        state *= z
        state += new
    return states, state, memory


def _outputs(model: Model, states: np.ndarray, targets: np.ndarray, grads: dict | None) -> tuple:
    """Log-probabilities of the targets (rows), and gradients where asked for.

    A target is a word's number, ``rare`` or ``unknown``; of rare words the share within
    the class is left to the caller.
    """
    w = model.weights
    logits = states @ w["class"]
    logits += w["class_bias"]
    logits -= logits.max(axis=1, keepdims=True)
    odds = np.exp(logits)
    sums = odds.sum(axis=1)
    single = targets < model.size
    kinds = np.full(len(targets), model.classes)
    kinds[single] = model.word_class[targets[single]]
    rows = np.arange(len(targets))
    found = (logits[rows, kinds] - np.log(sums)).astype(np.float64) + math.log1p(-model.unseen)
    found[targets == model.unknown] = math.log(model.unseen)
    back = None
    if grads is not None:
        odds /= sums[:, None]
        odds[rows, kinds] -= 1
        odds /= len(targets)
        grads["class"], grads["class_bias"] = states.T @ odds, odds.sum(axis=0)
        back = odds @ w["class"].T
        grads["word"], grads["word_bias"] = np.zeros_like(w["word"]), np.zeros_like(w["word_bias"])
    order = np.argsort(kinds.astype(np.uint16), kind="stable")  # by radix
    cuts = [0, *np.cumsum(np.bincount(kinds, minlength=model.classes + 1)).tolist()][: model.classes + 1]
    grouped, wanted = states.take(order[: cuts[-1]], axis=0), targets[order[: cuts[-1]]]
    inside, returned = np.zeros(len(wanted)), np.zeros_like(grouped) if grads is not None else None
    for kind in range(model.classes):
        mine, a, b = slice(cuts[kind], cuts[kind + 1]), model.first[kind], model.first[kind + 1]
        own, table = grouped[mine], w["word"][a:b]
        if not len(own) or b - a == 1:
            continue
        inner = own @ table.T
        inner += w["word_bias"][a:b]
        inner -= inner.max(axis=1, keepdims=True)
        place = np.arange(len(own)), wanted[mine] - a
        picked = inner[place]
        np.exp(inner, out=inner)
        total = inner.sum(axis=1)
        inside[mine] = picked - np.log(total)
        if grads is not None:
            inner *= (1 / (total * len(targets)))[:, None]
            inner[place] -= 1 / len(targets)
            grads["word"][a:b], grads["word_bias"][a:b] = inner.T @ own, inner.sum(axis=0)
            np.matmul(inner, table, out=returned[mine])
    found[order[: cuts[-1]]] += inside
    if grads is not None:
        back[order[: cuts[-1]]] += returned
    return found, back


def train(model: Model, tokens: np.ndarray, lengths: np.ndarray, squares: dict) -> float:
    """One pass over documents, window by window; changes the weights and ``squares``, the
    sums of squared gradients that scale the steps. Returns the mean log-probability."""
    w, total, count = model.weights, 0.0, 0
    dealt, owners = lanes(tokens, lengths)
    state = np.zeros((len(dealt), HIDDEN), np.float32)
    for inputs, targets, owner, first in _windows(dealt, owners):
        live = owner.ravel() >= 0
        states, state, (before, z, r, turned, new) = _recur(w, inputs, first, state, keep=True)
        grads: dict[str, np.ndarray] = {}
        flat = states.reshape(-1, HIDDEN)
        logs, back = _outputs(model, flat[live], targets.ravel()[live], grads)
        total, count = total + logs.sum(), count + len(logs)
        above = np.zeros_like(flat)
        above[live] = back
        above = above.reshape(states.shape)
        # What a gradient of the state passes on to each gate, for all times at once.
        rest = 1 - z
        to_keep = before - new
        to_keep *= z
        to_keep *= rest
        to_new = rest
        to_new *= 1 - new**2
        to_reset = turned * r
        to_reset *= 1 - r
        through, d_new = np.empty((*inputs.shape, 3 * HIDDEN), np.float32), np.empty_like(states)
        back_turn = np.ascontiguousarray(w["turn"].T)
        down = np.zeros((inputs.shape[1], HIDDEN), np.float32)
        for t in range(len(inputs) - 1, -1, -1):
            down = down + above[t]
            fresh = np.multiply(down, to_new[t], out=d_new[t])
            np.multiply(down, to_keep[t], out=through[t, :, :HIDDEN])
            np.multiply(fresh, to_reset[t], out=through[t, :, HIDDEN : 2 * HIDDEN])
            np.multiply(fresh, r[t], out=through[t, :, 2 * HIDDEN :])
            down = down * z[t] + through[t] @ back_turn
            if first[t].any():
                down[first[t]] = 0
        through = through.reshape(-1, 3 * HIDDEN)
        grads["turn"] = before.reshape(-1, HIDDEN).T @ through
        through[:, 2 * HIDDEN :] = d_new.reshape(-1, HIDDEN)
        flat_inputs = inputs.ravel()
        # Numbers of inputs are few enough to be sorted by radix.
        order = np.argsort(flat_inputs.astype(np.uint16) if model.unknown < 1 << 16 else flat_inputs, kind="stable")
        flat_inputs = flat_inputs[order]
        starts = np.flatnonzero(np.concatenate([[True], flat_inputs[1:] != flat_inputs[:-1]]))
        grads["inputs"] = np.zeros_like(w["inputs"])
        grads["inputs"][flat_inputs[starts]] = np.add.reduceat(through.take(order, axis=0), starts)
        for name, grad in grads.items():
            if name not in squares:
                squares[name] = np.full_like(grad, 1e-8)
            squares[name] += grad * grad
            grad *= np.float32(RATE)
            grad /= np.sqrt(squares[name])
            w[name] -= grad
    return total / max(count, 1)


def score(model: Model, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log-probability of each whole document, without rare words' shares."""
    dealt, owners = lanes(tokens, lengths)
    sums, state = np.zeros(len(lengths)), np.zeros((len(dealt), HIDDEN), np.float32)
    for inputs, targets, owner, first in _windows(dealt, owners):
        states, state, _ = _recur(model.weights, inputs, first, state, keep=False)
        live = owner.ravel() >= 0
        logs, _ = _outputs(model, states.reshape(-1, HIDDEN)[live], targets.ravel()[live], None)
        sums += np.bincount(owner.ravel()[live], weights=logs, minlength=len(lengths))
    return sums


def with_ends(index: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents with the end of the text as their last token."""
    return np.insert(index, np.cumsum(lengths), end), lengths + 1


# --- Spark ---------------------------------------------------------------------------


def _fit(blocks: DataFrame, model: Model) -> None:
    """Train on the documents that are not held out."""
    spark = blocks.sparkSession
    columns = blocks.select("block", "held", "lengths", "index", "words")
    turn = F.pmod(F.xxhash64("block"), F.lit(FIRST_SHARE)) == 0
    for part in (turn, ~turn):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            # Workers keep the broadcast object for later tasks: its weights must stay as sent.
            own, squares, seen = copy.copy(shared.value), {}, 0
            own.weights = {k: v.copy() for k, v in own.weights.items()}
            for batch in batches:
                for row in batch.to_pylist():
                    lengths, held = np.array(row["lengths"], np.int64), np.array(row["held"], bool)
                    ids = np.array([own.ids.get(x, own.rare) for x in row["words"]], np.int64)
                    index = unpack(row["index"])[np.repeat(~held, lengths)]
                    if held.all():
                        continue
                    tokens, sizes = with_ends(ids[index] if len(ids) else index, lengths[~held], END)
                    train(own, tokens, sizes, squares)
                    seen += len(tokens)
            if seen:
                total = np.frombuffer(own.to_bytes(), np.float32).astype("<f8") * seen
                yield pa.RecordBatch.from_pydict({"seen": array([seen], pa.int64()), "total": array([total.tobytes()], pa.binary())})

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, "<f8") for x in group["total"].to_pylist())
            seen = sum(group["seen"].to_pylist())
            return pa.table({"part": group["part"].slice(0, 1), "seen": array([seen], pa.int64()), "total": array([total.tobytes()], pa.binary())})

        parts = columns.where(part).mapInArrow(run, "seen bigint, total binary")
        parts = materialize(parts.withColumn("part", F.spark_partition_id()), "lm-weights")
        last = parts.agg(F.max("part")).first()[0] or 0
        while True:
            parts = parts.withColumn("part", (F.col("part") / _TREE).cast("int"))
            parts = parts.groupBy("part").applyInArrow(add, "part int, seen bigint, total binary")
            last //= _TREE
            if not last:
                break
            parts = materialize(parts, "lm-weights")
        mean = parts.first()  # at most one row of the model's size
        if mean is not None:
            model.load(np.frombuffer(mean["total"], "<f8") / mean["seen"])


def score_documents(docs: DataFrame, held: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from the rows where ``held`` is false. Null and empty texts are the end alone.
    ``base_score`` and ``score`` are log10 probabilities of whole texts; without any
    training text both treat every token as the unknown cell, with probability 1. Repeated
    rows are repeated; further columns are not read; an empty table gives no rows.
    """
    blocks = materialize(text_blocks(docs, held), "lm-blocks")
    entry = F.posexplode(F.arrays_zip("words", "trained")).alias("pos", "entry")
    entries = blocks.select("block", entry).select("block", "pos", F.col("entry.words").alias("word"), F.col("entry.trained").alias("n"))
    totals = materialize(entries.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    n, v, once = totals.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum((F.col("c") == 1).cast("int")), F.lit(0))
    ).first()
    ends = blocks.agg(F.sum(F.size(F.filter("held", lambda x: ~x)))).first()[0] or 0
    n, v = n + ends, v + (ends > 0)
    model = None
    shares = 1.0
    if n:
        top = totals.orderBy(F.desc("c"), "word").limit(VOCABULARY).collect()
        counts = np.array([ends, *[r["c"] for r in top]], float)
        others = n - counts.sum()
        shares = others + 0.5 * (v - len(counts))
        model = Model([r["word"] for r in top], counts, others, once / n)
        _fit(blocks, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scale = n + 0.5 * (v + 1)

    def run(key: tuple, found: pa.Table, known: pa.Table) -> pa.Table:
        model, out = shared.value, []
        for row in found.to_pylist():
            c = np.zeros(len(row["words"]) + 1)
            c[known["pos"].to_numpy()] = known["c"].to_numpy()
            c[-1] = ends
            tokens, sizes = with_ends(unpack(row["index"]), np.array(row["lengths"], np.int64), len(c) - 1)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            base = np.bincount(owner, weights=np.log10((c + 0.5) / scale)[tokens], minlength=len(sizes))
            scores = base
            if model is not None:
                ids = np.array([model.ids.get(w, model.rare) for w in row["words"]] + [END], np.int64)
                ids[(ids == model.rare) & (c == 0)] = model.unknown
                share = np.where(ids == model.rare, np.log((c + 0.5) / max(shares, 0.5)), 0.0)
                rest = np.bincount(owner, weights=share[tokens], minlength=len(sizes))
                scores = (score(model, ids[tokens], sizes) + rest) / math.log(10)
            out.append({
                "doc_id": row["doc_ids"], "held_out": row["held"], "n_tokens": sizes,
                "n_known": np.bincount(owner, weights=(c > 0)[tokens], minlength=len(sizes)).astype(np.int64),
                "train_tokens": np.full(len(sizes), n), "base_score": base, "score": scores,
            })
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        columns = [pa.concat_arrays([array(o[name], kind) for o in out] or [array([], kind)]) for name, kind in zip(names, kinds)]
        return pa.table(columns, names)

    look = entries.select("block", "pos", "word").join(totals, "word")
    look = look.select(F.col("block").alias("in_block"), "pos", "c")
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    rows = blocks.select("block", "doc_ids", "held", "lengths", "index", "words")
    return rows.groupBy("block").cogroup(look.groupBy("in_block")).applyInArrow(run, schema)
