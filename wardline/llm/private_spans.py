"""Personal data: base patterns, and spans that a semi-Markov random field adds to them.

**Base.** Four patterns (``email, ip, card, phone``), leftmost and non-overlapping per kind.
They are found by scans that take time in proportion to the text, whatever it holds.

**Candidates.** A segment is a run of at most ``MAX_TOKENS`` tokens and ``MAX_CHARS``
characters on one line that holds a seed (a digit, an at sign or a bracketed "at"), starts
and ends at a word's edge. So every candidate lies near a seed, and texts fall into regions
around seeds that can be decided one by one: the decision about the whole text is exact.

**Model.** A segment of a kind scores the sum of weights of features of the whole span (its
shape, counts of digits, groups and signs, the check digit of all its digits, whether its
numbers are octets, what stands beside it) and of the step from the segment before it;
tokens outside of segments score 0. All features come from prefix sums, so every candidate
of a region is scored without reading its characters again. The best joint choice of
boundaries and kinds is found by dynamic programming. Segments that could not pay even with
the best steps around them are left out before, which does not change the choice.

**Training.** Maximum likelihood by the forward-backward recursion over segments, on a
bounded sample of regions (``TRAIN_DOCS``, ``TRAIN_REGIONS``). Their labels are the base
spans, which are also rewritten into forms that the patterns miss ("name [at] host [dot]
com", numbers with other separators) and into look-alikes that are no personal data.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import array, slices

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MAX_CHARS = 24, 80
TRAIN_DOCS, TRAIN_REGIONS, TRAIN_CHARS = 8000, 800, 300
STEPS, RATE, PENALTY = 40, 0.5, 1e-3
# Candidates scored at once.
SCORED = 1 << 18

Span = tuple[int, int, int]  # kind, start, end

# --- base patterns ---------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign is looked at once: back to the last one or match, ahead for a domain."""
    floor, at = 0, text.find("@")
    while at >= 0:
        before = text[floor:at]
        start = floor + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        floor = found.end() if found else at + 1
        at = text.find("@", floor)


def octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Dotted numbers, four by four."""
    for found in _NUMBERS.finditer(text):
        parts = found.group().split(".")
        at = found.start()
        for k in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[k : k + 4])) + 3
            if all(map(octet, parts[k : k + 4])):
                yield at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() < 16:
            continue
        digits = _NO_DIGITS.sub("", found.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 8 <= len(_NO_DIGITS.sub("", found.group())) <= 15:
            yield found.span()


_FINDERS = (emails, addresses, cards, phones)
# What a text must hold for a kind's scan to be worth while.
_NEEDED = ("@", r"[0-9]\.[0-9]+\.[0-9]", r"[0-9](?:[ -]?[0-9]){15}", r"\+[0-9]")


def base_spans(text: str, kinds: tuple[int, ...] = (0, 1, 2, 3)) -> list[Span]:
    return [(k, a, b) for k in kinds for a, b in _FINDERS[k](text)]


def spans_text(spans: list[Span]) -> str:
    """``kind:start:end`` by kind, then start, comma-joined."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# --- regions and tokens ----------------------------------------------------------------

_SEED = re.compile(r"[0-9]+|@|[(\[{]\x20?[aA][tT]\x20?[)\]}]")
_HAS_SEED = r"[0-9@]|[(\[{]\x20?[aA][tT]\x20?[)\]}]"
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]", re.DOTALL)
_MARGIN = MAX_CHARS + 2
# Classes of tokens; a sign is its own class, other characters share the last two.
_SIGNS = " .-()+@[]{}_%=#$:,;/<>\"'|*&~\\!?\t\n\r"
DIGITS, LETTERS, FOREIGN, OTHER = 0, 1, 2, 3
_CLASS = {c: k + 4 for k, c in enumerate(_SIGNS)}
CLASSES = len(_SIGNS) + 5
EDGE = CLASSES - 1  # beside the first and the last token of a text
_AT, _DOT, _DASH, _SPACE, _PLUS = (_CLASS[c] for c in "@.- +")
_BREAKS = [_CLASS[c] for c in "\n\r"]
_OPENS, _CLOSES = [_CLASS[c] for c in "(+"], [_CLASS[c] for c in ")"]


def regions(text: str) -> list[tuple[int, int]]:
    """Ranges of a text that hold all candidates, apart from each other."""
    out: list[list[int]] = []
    for found in _SEED.finditer(text):
        if found.end() - found.start() > MAX_CHARS:
            continue
        start, end = max(found.start() - _MARGIN, 0), min(found.end() + _MARGIN, len(text))
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


@dataclass
class Tokens:
    """Tokens of many regions, one after another."""

    region: np.ndarray  # number of the region
    start: np.ndarray  # first character, in the region's text
    size: np.ndarray
    kind: np.ndarray  # class
    code: np.ndarray  # what the span's shape is made of
    seed: np.ndarray
    octet: np.ndarray
    cut: np.ndarray  # reaches a region's edge inside the text: in no candidate
    digits: np.ndarray  # all digits of digit tokens, one after another


_WORDS = {"at": 1, "dot": 2, "tel": 3, "phone": 4, "com": 5, "net": 5, "org": 5}


def tokenize(parts: list[tuple[str, bool, bool]]) -> Tokens:
    """``parts``: each region's text, and whether it starts and ends inside its text."""
    region, start, size, kind, code, seed, small, cut, digits = [], [], [], [], [], [], [], [], []
    for number, (text, open_left, open_right) in enumerate(parts):
        first = len(start)
        seeds = {m.start() for m in _SEED.finditer(text) if m.end() - m.start() <= MAX_CHARS}
        for found in _TOKEN.finditer(text):
            token, at = found.group(), found.start()
            char = token[0]
            low = False
            if "0" <= char <= "9":
                k, c, low = DIGITS, 100 + min(len(token), 20), octet(token)
                digits.append(token)
            elif "a" <= char <= "z" or "A" <= char <= "Z":
                k, c = LETTERS, 60 + _WORDS.get(token.lower(), 0)
            else:
                k = _CLASS.get(char)
                if k is None:
                    k = FOREIGN if char.isalnum() else OTHER
                c = k
            region.append(number)
            start.append(at)
            size.append(len(token))
            kind.append(k)
            code.append(c)
            seed.append(at in seeds)
            small.append(low)
            cut.append(False)
        if len(start) > first:
            cut[first], cut[-1] = open_left or cut[first], open_right or cut[-1]
    as_int = [np.array(x, np.int64) for x in (region, start, size, kind, code)]
    as_bool = [np.array(x, bool) for x in (seed, small, cut)]
    flat = np.frombuffer("".join(digits).encode(), np.uint8).astype(np.int64) - ord("0")
    return Tokens(*as_int, *as_bool, flat)


# --- features --------------------------------------------------------------------------

SHAPES = 1 << 13
# Name and number of values of each feature.
FEATURES = {
    "shape": SHAPES, "digits": 24, "ats": 3, "groups": 10, "longest": 12, "words": 8, "dots": 6, "dashes": 6, "spaces": 8,
    "brackets": 4, "plus": 2, "check": 3, "octets": 3, "left": CLASSES, "right": CLASSES, "tail": 5, "tokens": MAX_TOKENS + 1,
}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(count - 1, 0), base)]), dtype=np.uint64)


class Segments:
    """Candidates of tokens: first token and the one behind the last, and their features."""

    def __init__(self, t: Tokens):
        self.t, n = t, len(t.kind)
        self.count = n
        region_end = np.searchsorted(t.region, t.region, side="right")
        word = (t.kind == DIGITS) | (t.kind == LETTERS) | (t.kind == FOREIGN)
        glued = np.zeros(n + 1, bool)  # between token i - 1 and i, inside a word
        if n:
            glued[1:n] = word[1:] & word[:-1] & (t.region[1:] == t.region[:-1])
        plain = (t.kind == DIGITS) | (t.kind == LETTERS)
        begins = (plain & ~glued[:n]) | np.isin(t.kind, _OPENS)
        ends = (plain & ~glued[1 : n + 1]) | np.isin(t.kind, _CLOSES)
        barred = self._sums(t.cut | np.isin(t.kind, _BREAKS))
        seeds = self._sums(t.seed)
        stop = t.start + t.size
        found_a, found_b = [], []
        at = np.flatnonzero(begins & ~t.cut)
        for length in range(1, MAX_TOKENS + 1):
            last = at + length - 1
            keep = last < region_end[at]
            at, last = at[keep], last[keep]
            keep = (stop[last] - t.start[at] <= MAX_CHARS) & (barred[last + 1] == barred[at])
            at, last = at[keep], last[keep]
            fine = ends[last] & (seeds[last + 1] > seeds[at])
            found_a.append(at[fine])
            found_b.append(last[fine] + 1)
        self.a, self.b = np.concatenate(found_a), np.concatenate(found_b)

    @staticmethod
    def _sums(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])

    def prepare(self) -> None:
        """Prefix sums that the features are taken from."""
        t, n = self.t, self.count
        held = np.where(t.kind == DIGITS, t.size, 0)
        self.digit_at = self._sums(held)
        order = np.arange(len(t.digits))
        doubled = np.where(t.digits > 4, 2 * t.digits - 9, 2 * t.digits)
        # Sums with the digits of odd or of even places doubled.
        self.luhn = [self._sums(np.where(order % 2 == k, doubled, t.digits)) for k in (0, 1)]
        self.counts = {
            "groups": self._sums(t.kind == DIGITS), "words": self._sums(t.kind == LETTERS), "dots": self._sums(t.kind == _DOT),
            "dashes": self._sums(t.kind == _DASH), "spaces": self._sums(t.kind == _SPACE),
            "ats": self._sums(t.seed & (t.kind != DIGITS)),
            "brackets": self._sums(np.isin(t.kind, [_CLASS[c] for c in "()[]{}"])), "large": self._sums((t.kind == DIGITS) & ~t.octet),
        }
        self.up, self.down = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        self.hashed = np.concatenate([[np.uint64(0)], np.cumsum((t.code + 7).astype(np.uint64) * self.up[:n], dtype=np.uint64)])
        # A group longer than k, for the longest group.
        self.longer = [self._sums((t.kind == DIGITS) & (t.size > k)) for k in range(11)]

    def features(self, cut: slice) -> dict[str, np.ndarray]:
        t, a, b = self.t, self.a[cut], self.b[cut]
        held = {k: s[b] - s[a] for k, s in self.counts.items()}
        g0, g1 = self.digit_at[a], self.digit_at[b]
        digits = g1 - g0
        # Doubled are the places whose parity is not that of the last digit.
        parity = g1 % 2
        total = np.where(parity == 0, self.luhn[0][g1] - self.luhn[0][g0], self.luhn[1][g1] - self.luhn[1][g0])
        check = np.where((digits < 13) | (digits > 19), 0, np.where(total % 10 == 0, 2, 1))
        four = (held["groups"] == 4) & (held["words"] == 0)
        longest = sum((s[b] > s[a]).astype(np.int64) for s in self.longer)
        with np.errstate(over="ignore"):
            mixed = (self.hashed[b] - self.hashed[a]) * self.down[a]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _BASE
        last = b - 1
        tail = np.where(t.kind[last] == LETTERS, np.clip(t.size[last] - 1, 0, 3), 4)
        before, behind = np.maximum(a - 1, 0), np.minimum(b, self.count - 1)
        left = np.where((a > 0) & (t.region[before] == t.region[a]), t.kind[before], EDGE)
        right = np.where((b < self.count) & (t.region[behind] == t.region[last]), t.kind[behind], EDGE)
        found = {
            "shape": (mixed >> np.uint64(40)).astype(np.int64) % SHAPES, "digits": digits, "longest": longest,
            "plus": (t.kind[a] == _PLUS).astype(np.int64), "check": check,
            "octets": np.where(four, np.where(held["large"] == 0, 2, 1), 0), "left": left, "right": right,
            "tail": tail, "tokens": b - a,
        }
        found |= {k: held[k] for k in ("ats", "groups", "words", "dots", "dashes", "spaces", "brackets")}
        return {k: np.minimum(found[k], size - 1) for k, size in FEATURES.items()}


# --- model -----------------------------------------------------------------------------


class Field:
    """Weights of the features by kind, and of the step from one kind to the next."""

    def __init__(self):
        self.weights = {k: np.zeros((size, len(KINDS))) for k, size in FEATURES.items()}
        self.steps = np.zeros((len(KINDS), len(KINDS)))

    def scores(self, features: dict[str, np.ndarray]) -> np.ndarray:
        return sum(self.weights[k][v] for k, v in features.items())

    def decode(self, segments: Segments) -> list[tuple[int, int, int]]:
        """Best joint choice: (kind, first token, token behind the last) of each segment."""
        segments.prepare()
        # What steps may add to a segment at most, before and behind it.
        gain = np.maximum(self.steps, 0)
        most = gain.max(axis=0) + gain.max(axis=1)
        found = []
        for at in range(0, len(segments.a), SCORED):
            cut = slice(at, at + SCORED)
            scores = self.scores(segments.features(cut))
            row, kind = np.nonzero(scores + most > 0)
            found.append((segments.a[cut][row], segments.b[cut][row], kind, scores[row, kind]))
        if not found:
            return []
        a, b, kind, score = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((kind, a, b))
        a, b, kind, score = (x[order] for x in (a, b, kind, score))
        # One place between regions, so that segments of two regions are not neighbours.
        gap = segments.t.region[a]
        chosen = self._best(*(x.tolist() for x in (a + gap, b + gap, kind, score)))
        return [(int(kind[k]), int(a[k]), int(b[k])) for k in chosen]

    def _best(self, a: list, b: list, kind: list, score: list) -> list[int]:
        """Dynamic programming over the ends of segments, in ascending order: those chosen.

        A state is the best value of a choice that ends at a token, by the kind of the
        segment that ends right there; ``outside`` is the best one with any end up to there.
        """
        steps = self.steps.tolist()
        ends: list[int] = [0]  # places at which the best value outside changes
        outside: list[tuple[float, int]] = [(0.0, -1)]  # value, segment that it ends with
        inside: dict[tuple[int, int], tuple[float, int]] = {}
        parent: list[int] = []
        for k in range(len(a)):
            value, before = outside[bisect_right(ends, a[k] - 1) - 1] if a[k] else outside[0]
            for other_kind in range(len(KINDS)):
                other = inside.get((a[k], other_kind))
                if other is not None and other[0] + steps[other_kind][kind[k]] > value:
                    value, before = other[0] + steps[other_kind][kind[k]], other[1]
            value += score[k]
            parent.append(before)
            key = (b[k], kind[k])
            if key not in inside or value > inside[key][0]:
                inside[key] = (value, k)
            if value > outside[-1][0]:
                if ends[-1] == b[k]:
                    outside[-1] = (value, k)
                else:
                    ends.append(b[k])
                    outside.append((value, k))
        out, at = [], outside[-1][1]
        while at >= 0:
            out.append(at)
            at = parent[at]
        return out[::-1]


def find_spans(text_parts: list[list[tuple[int, str, bool, bool]]], field: Field) -> list[list[Span]]:
    """Spans of each text, given its regions as (offset, text, starts inside, ends inside)."""
    flat = [(n, *part) for n, parts in enumerate(text_parts) for part in parts]
    out: list[list[Span]] = [[] for _ in text_parts]
    t = tokenize([(text, left, right) for _, _, text, left, right in flat])
    for kind, a, b in field.decode(Segments(t)):
        number, offset = flat[t.region[a]][:2]
        out[number].append((kind, offset + int(t.start[a]), offset + int(t.start[b - 1] + t.size[b - 1])))
    return out


def cut_regions(text: str) -> list[tuple[int, str, bool, bool]]:
    return [(a, text[a:b], a > 0, b < len(text)) for a, b in regions(text)]


# --- training --------------------------------------------------------------------------


def _spell(kind: int, value: str, rng: random.Random) -> str:
    """Another form of personal data that the base patterns miss."""
    if kind == 0:
        at, dot = rng.choice([(" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" (at) ", "."), (" @ ", "."), ("{at}", "{dot}")])
        name, _, host = value.partition("@")
        return name + at + host.replace(".", dot)
    if kind == 1:
        return value.replace(".", rng.choice(["[.]", " . ", "(.)"]))
    digits = _NO_DIGITS.sub("", value)
    if kind == 2:
        return rng.choice([".", "  ", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, rest, line = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice(["({}) {}-{}", "({}) {} {}", "{}-{}-{}", "{}.{}.{}", "1-{}-{}-{}"]).format(area, rest, line)


def _lookalike(kind: int, value: str, rng: random.Random) -> str:
    """Something that resembles personal data and is none."""
    if kind == 0:
        return rng.choice([f"@{rng.choice('abcde')}{rng.randint(1, 99)}", value.replace("@", " "), value.partition("@")[0] + " @ " + str(rng.randint(1, 50))])
    if kind == 1:
        numbers = [rng.randint(0, 30) for _ in range(3)]
        return rng.choice([".".join(map(str, numbers)), f"{rng.randint(300, 999)}.{rng.randint(300, 999)}.{numbers[0]}.{numbers[1]}", f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"])
    if kind == 2:
        digits = [int(c) for c in value if c.isdigit()]
        digits[rng.randrange(len(digits))] += 1  # a wrong check digit
        wrong = "".join(str(d % 10) for d in digits)
        return rng.choice([wrong, wrong[: rng.randint(5, 11)], " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), hashlib.md5(wrong.encode()).hexdigest()])
    n = rng.randint(1, 9999)
    return rng.choice([f"+{n}", f"({n})", f"{n}-{rng.randint(1, 99)}", f"{n} {rng.randint(1, 999)} {rng.randint(1, 999)}", f"{n / 100:.2f}", f"{rng.randint(100000, 99999999)}"])


def rewritten(text: str, spans: list[Span], rng: random.Random, how) -> tuple[str, list[Span]]:
    """A region with each span replaced by ``how``, and where the spans then are."""
    out, moved, at = [], [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1:]):
        if a < at:
            continue  # inside another kind's span
        out.append(text[at:a])
        begin = sum(map(len, out))
        out.append(how(kind, text[a:b], rng))
        moved.append((kind, begin, begin + len(out[-1])))
        at = b
    out.append(text[at:])
    return "".join(out), moved


def examples(sample: list[tuple[str, bool, bool]], seed: int = 11) -> list[tuple[str, bool, bool, list[Span]]]:
    """Labelled regions: as they are, rewritten, and with look-alikes."""
    rng, out = random.Random(seed), []
    for text, left, right in sample:
        spans = base_spans(text)
        out.append((text, left, right, spans))
        for how in (_spell, _spell, _lookalike) if spans else ():
            changed, moved = rewritten(text, spans, rng, how)
            kept = moved if how is _spell else base_spans(changed)
            out.append((changed, left, right, kept))
    return out


def train(sample: list[tuple[str, bool, bool]]) -> Field:
    """Fit by gradient steps on the likelihood of the labelled regions."""
    field = Field()
    labelled = examples(sorted(sample))
    t = tokenize([e[:3] for e in labelled])
    segments = Segments(t)
    if not len(segments.a):
        return field
    segments.prepare()
    features = segments.features(slice(None))
    region = t.region[segments.a]
    gold = np.zeros((len(region), len(KINDS)))
    stop = t.start + t.size
    spans = {(n, a, b): k for n, e in enumerate(labelled) for k, a, b in sorted(e[3], reverse=True)}
    places = zip(region.tolist(), t.start[segments.a].tolist(), stop[segments.b - 1].tolist())
    for row, place in enumerate(places):
        if place in spans:
            gold[row, spans[place]] = 1
    # Positions count from a region's first token.
    first = np.searchsorted(t.region, np.arange(len(labelled)))
    a, b = segments.a - first[region], segments.b - first[region]
    sizes = np.bincount(t.region, minlength=len(labelled))
    by_end, by_start = np.argsort(b, kind="stable"), np.argsort(a, kind="stable")
    end_cuts = np.searchsorted(b[by_end], np.arange(sizes.max() + 2))
    start_cuts = np.searchsorted(a[by_start], np.arange(sizes.max() + 2))
    squares = {k: np.full_like(w, 1e-6) for k, w in field.weights.items()}
    step_squares = np.full_like(field.steps, 1e-6)
    # Labelled pairs of neighbouring segments.
    pair_gold = _neighbours(gold, region, a, b)
    for _ in range(STEPS):
        odds = np.exp(np.clip(field.scores(features), -30, 30))
        expected, pairs = _expectations(odds, np.exp(field.steps), region, a, b, sizes, (by_end, end_cuts), (by_start, start_cuts))
        difference = gold - expected
        for name, weight in field.weights.items():
            grad = np.stack([np.bincount(features[name], difference[:, k], minlength=len(weight)) for k in range(len(KINDS))], axis=1)
            grad = grad / len(labelled) - PENALTY * weight
            squares[name] += grad * grad
            weight += RATE * grad / np.sqrt(squares[name])
        grad = (pair_gold - pairs) / len(labelled) - PENALTY * field.steps
        step_squares += grad * grad
        field.steps += RATE * grad / np.sqrt(step_squares)
    return field


def _neighbours(gold: np.ndarray, region: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    rows, kinds = np.nonzero(gold)
    ends = {(int(region[r]), int(b[r])): int(k) for r, k in zip(rows, kinds)}
    out = np.zeros((len(KINDS), len(KINDS)))
    for r, k in zip(rows, kinds):
        before = ends.get((int(region[r]), int(a[r])))
        if before is not None:
            out[before, k] += 1
    return out


def _expectations(odds, steps, region, a, b, sizes, ending, starting):
    """Probability of each segment and kind, and expected neighbouring kinds.

    Forward and backward sums over all choices, side by side for all regions. ``ahead`` at a
    position: sum over choices up to it by the kind of a segment that ends there, the last
    column for those that end in a token outside. Sums of a region are scaled by the largest
    so far, which cancels out.
    """
    (by_end, end_cuts), (by_start, start_cuts) = ending, starting
    kinds, longest = len(KINDS), int(sizes.max())
    full = np.ones((kinds + 1, kinds))
    full[:kinds] = steps
    regions_, scale = len(sizes), np.zeros((longest + 2, len(sizes)))
    ahead = np.zeros((longest + 1, regions_, kinds + 1))
    ahead[0, :, kinds] = 1
    for j in range(1, longest + 1):
        ahead[j, :, kinds] = ahead[j - 1].sum(axis=1)
        rows = by_end[end_cuts[j] : end_cuts[j + 1]]
        if len(rows):
            r = region[rows]
            into = ahead[a[rows], r]
            # Earlier sums were scaled down less often.
            into = into * np.exp(scale[a[rows], r] - scale[j - 1, r])[:, None]
            np.add.at(ahead[j], (r, slice(0, kinds)), (into @ full) * odds[rows])
        top = np.maximum(ahead[j].sum(axis=1), 1e-300)
        factor = np.where(top > 1e100, top, 1.0)
        ahead[j] /= factor[:, None]
        scale[j] = scale[j - 1] + np.log(factor)
    # Behind a position: sum over choices from it on, by the kind that ended there.
    back = np.zeros((longest + 2, regions_, kinds + 1))
    back_scale = np.zeros((longest + 2, regions_))
    back[sizes, np.arange(regions_)] = 1
    expected, pairs = np.zeros_like(odds), np.zeros((kinds, kinds))
    for j in range(longest - 1, -1, -1):
        inner = j < sizes
        on = back[j + 1, :, kinds][:, None]  # the token at j is outside
        value = np.where(inner[:, None], np.broadcast_to(on, (regions_, kinds + 1)), back[j])
        carried = np.where(inner, back_scale[j + 1], 0.0)
        rows = by_start[start_cuts[j] : start_cuts[j + 1]]
        if len(rows):
            r = region[rows]
            rest = back[b[rows], r][:, :kinds] * odds[rows]
            rest = rest * np.exp(back_scale[b[rows], r] - carried[r])[:, None]
            value = value.copy()
            np.add.at(value, r, rest @ full.T)
        top = np.maximum(value.sum(axis=1), 1e-300)
        factor = np.where(inner & (top > 1e100), top, 1.0)
        back[j] = value / factor[:, None]
        back_scale[j] = carried + np.log(factor)
    log_all = np.log(np.maximum(back[0, :, kinds], 1e-300)) + back_scale[0]
    for cut in range(0, len(a), SCORED):
        s = slice(cut, cut + SCORED)
        r, into, onto = region[s], ahead[a[s], region[s]], back[b[s], region[s]][:, :kinds]
        weight = np.exp(scale[a[s], r] + back_scale[b[s], r] - log_all[r])[:, None] * odds[s] * onto
        expected[s] = (into @ full) * weight
        pairs += (into[:, :kinds].T @ weight) * steps
    return expected, pairs


def training_sample(docs: DataFrame) -> list[tuple[str, bool, bool]]:
    """Regions of about ``TRAIN_DOCS`` documents, chosen by a hash of their id: at most
    ``TRAIN_REGIONS`` with a base span and as many without one, first by their own hash."""
    share = TRAIN_DOCS / max(docs.count(), 1)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 32)) / F.lit(1 << 32)
    chosen = docs.where(F.col("doc_id").isNotNull() & (place < share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                for _, part, left, right in cut_regions(text or ""):
                    if len(part) <= TRAIN_CHARS:
                        rows.append((part, left, right, bool(base_spans(part))))
            names = ["region", "starts", "ends", "positive"]
            kinds = [pa.string(), pa.bool_(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    found = chosen.select("text").mapInArrow(run, "region string, starts boolean, ends boolean, positive boolean").distinct()
    key = [F.md5("region"), F.col("region"), F.col("starts"), F.col("ends")]
    parts = [found.where(F.col("positive") == p).orderBy(*key).limit(TRAIN_REGIONS).collect() for p in (True, False)]
    return [(r["region"], r["starts"], r["ends"]) for part in parts for r in part]


# --- Spark -----------------------------------------------------------------------------


def find(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, base, added`` of each row: spans as lists of (kind, start, end).

    ``added`` has the model's spans that overlap no base span.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = "array<struct<kind: int, start: bigint, end: bigint>>"
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in slices(batches):
            texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
            base: list[list[Span]] = [[] for _ in range(batch.num_rows)]
            for k, needed in enumerate(_NEEDED):
                hits = pc.indices_nonzero(pc.match_substring_regex(texts, needed)).to_pylist()
                for row, text in zip(hits, texts.take(pa.array(hits, pa.int64())).to_pylist()):
                    base[row] += base_spans(text, (k,))
            seeded = pc.indices_nonzero(pc.match_substring_regex(texts, _HAS_SEED)).to_pylist()
            found = find_spans([cut_regions(t) for t in texts.take(pa.array(seeded, pa.int64())).to_pylist()], field)
            added: list[list[Span]] = [[] for _ in range(batch.num_rows)]
            for row, spans in zip(seeded, found):
                added[row] = [s for s in spans if all(s[2] <= o[1] or o[2] <= s[1] for o in base[row])]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                **{n: array([[dict(zip(("kind", "start", "end"), s)) for s in sorted(row)] for row in rows], kind) for n, rows in (("base", base), ("added", added))},
            })

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(run, f"doc_id bigint, base {span}, added {span}")


def find_private(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added`` of every row, with a model fitted on a bounded sample of them.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Without a
    base span in the sample the model adds none. Repeated rows are repeated; further columns
    are not read; an empty table gives no rows.
    """
    return find(docs, train(training_sample(docs)))


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``; numbers of base spans."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"))
