"""Personal data: base patterns against plain expressions, the model against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.frames import EDGE_TEXTS, documents, frame, prose, with_clashes
from wardline.llm import private_spans as private

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
PIECES = ["1", "42", "255", "256", "007", ".", ".", "-", " ", "+", "(", ")", "@", "a", "mail", "é", "٣", "\n", "4111111111111111", "5500005555555559", "x.y", "[at]", "(dot)"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=25).map("".join)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_base_equals_plain_patterns(text):
    assert private.base_spans(text) == brute_base(text)


@pytest.mark.parametrize("text", ["a" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "@" * 200_000, "1 " * 200_000, "(at)" * 100_000])
def test_long_runs_take_little_time(text):
    field = private.Field()
    assert private.base_spans(text) == brute_base(text) if len(text) < 10 else True
    private.base_spans(text)
    private.find_spans([private.cut_regions(text)], field)


def random_field(seed):
    rng, field = np.random.default_rng(seed), private.Field()
    for weight in field.weights.values():
        weight[:] = rng.normal(-0.2, 0.6, weight.shape)
    field.steps[:] = rng.normal(0, 1.5, field.steps.shape)
    return field


def all_choices(a, b, kinds):
    """All sets of segments that do not overlap, each with a kind, in order."""
    rows = sorted(range(len(a)), key=lambda k: (a[k], b[k]))

    def go(at, from_):
        yield []
        for i in range(from_, len(rows)):
            k = rows[i]
            if a[k] >= at:
                for kind in range(kinds):
                    for rest in go(b[k], i + 1):
                        yield [(k, kind), *rest]

    return go(0, 0)


def value(choice, a, b, scores, steps):
    total = sum(scores[k, kind] for k, kind in choice)
    return total + sum(steps[x[1], y[1]] for x, y in zip(choice, choice[1:]) if b[x[0]] == a[y[0]])


SMALL = ["a@b.c x", "1.2 3", "+1(2)", "1-2", "é1 2", "1 @"]


@pytest.mark.parametrize("text", SMALL)
@pytest.mark.parametrize("seed", range(4))
def test_decoding_finds_the_best_choice(text, seed):
    field = random_field(seed)
    t = private.tokenize([(text, False, False)])
    segments = private.Segments(t)
    segments.prepare()
    a, b, scores = segments.a, segments.b, field.scores(segments.features(slice(None)))
    best = max(value(c, a, b, scores, field.steps) for c in all_choices(a.tolist(), b.tolist(), 4))
    row = {(int(x), int(y)): k for k, (x, y) in enumerate(zip(a, b))}
    found = [(row[x, y], kind) for kind, x, y in field.decode(private.Segments(t))]
    assert value(found, a, b, scores, field.steps) == pytest.approx(best)


@pytest.mark.parametrize("texts", [["1.2 3", "+1(2)"], ["é1 2", "a@b"]])
def test_expectations_equal_brute_force(texts):
    field = random_field(9)
    t = private.tokenize([(x, False, False) for x in texts])
    segments = private.Segments(t)
    segments.prepare()
    features = segments.features(slice(None))
    scores = field.scores(features)
    region = t.region[segments.a]
    first = np.searchsorted(t.region, np.arange(len(texts)))
    a, b = segments.a - first[region], segments.b - first[region]
    sizes = np.bincount(t.region)
    by_end, by_start = np.argsort(b, kind="stable"), np.argsort(a, kind="stable")
    cuts = np.arange(sizes.max() + 2)
    found, pairs = private._expectations(
        np.exp(scores), np.exp(field.steps), region, a, b, sizes,
        (by_end, np.searchsorted(b[by_end], cuts)), (by_start, np.searchsorted(a[by_start], cuts)),
    )
    expected, expected_pairs = np.zeros_like(scores), np.zeros((4, 4))
    for n in range(len(texts)):
        own = np.flatnonzero(region == n)
        choices = list(all_choices(a[own].tolist(), b[own].tolist(), 4))
        weights = np.exp([value(c, a[own], b[own], scores[own], field.steps) for c in choices])
        weights /= weights.sum()
        for choice, weight in zip(choices, weights):
            for k, kind in choice:
                expected[own[k], kind] += weight
            for x, y in zip(choice, choice[1:]):
                if b[own[x[0]]] == a[own[y[0]]]:
                    expected_pairs[x[1], y[1]] += weight
    assert np.allclose(found, expected) and np.allclose(pairs, expected_pairs)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_candidates_and_features_equal_brute_force(text):
    t = private.tokenize([("zz", False, False), (text, False, False)])
    segments = private.Segments(t)
    segments.prepare()
    held = segments.features(slice(None))
    own = [text[s : s + n] for s, n, r in zip(t.start, t.size, t.region) if r == 1]
    found = {(int(x) - 1, int(y) - 1): k for k, (x, y) in enumerate(zip(segments.a, segments.b))}
    assert "".join(own) == text
    expected = set()
    for x, y in itertools.combinations(range(len(own) + 1), 2):
        span = "".join(own[x:y])
        before, behind = "".join(own[:x])[-1:], "".join(own[y:])[:1]
        seeds = any(s.isascii() and s[0].isdigit() or s == "@" for s in own[x:y]) or re.search(r"[(\[{] ?[aA][tT] ?[)\]}]", text)
        starts = (own[x].isascii() and own[x].isalnum() and not before.isalnum()) or own[x] in "(+"
        ends = (own[y - 1].isascii() and own[y - 1].isalnum() and not behind.isalnum()) or own[y - 1] == ")"
        if y - x <= private.MAX_TOKENS and len(span) <= private.MAX_CHARS and "\n" not in span and starts and ends and seeds:
            expected.add((x, y))
    assert set(found) <= expected
    if "at" not in text:
        assert set(found) == expected
    for (x, y), k in found.items():
        span = "".join(own[x:y])
        digits = re.sub("[^0-9]", "", span)
        check = 0 if not 13 <= len(digits) <= 19 else 2 if luhn(digits) else 1
        groups = re.findall("[0-9]+", span)
        four = len(groups) == 4 and not re.search("[A-Za-z]", span)
        octets = (2 if all(int(g) <= 255 for g in groups) else 1) if four else 0
        longest = min(max(map(len, groups), default=0), 11)
        want = {"digits": min(len(digits), 23), "check": check, "octets": octets, "longest": longest, "dots": min(span.count("."), 5), "tokens": y - x}
        assert {n: int(held[n][k]) for n in want} == want


def personal(rng):
    return rng.choice([
        f"{rng.choice(['ann', 'bob.lee', 'c_d'])}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com",
        ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
        _card(rng),
    ])


def _card(rng):
    digits = "4" + "".join(str(rng.randint(0, 9)) for _ in range(14))
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def texts_with_data(count, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        words = prose(rng, "en", 40).split(" ")
        words.insert(rng.randint(1, len(words) - 1), personal(rng))
        words.insert(0, str(rng.randint(0, 99_999)))
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def field():
    return private.train([part[1:] for t in texts_with_data(400, 1) for part in private.cut_regions(t)])


def test_held_out_forms_are_found(field):
    rng, hit, missed, false = random.Random(5), 0, 0, 0
    for text in texts_with_data(300, 2):
        changed, spans = private.rewritten(text, private.base_spans(text), rng, private._spell)
        (found,) = private.find_spans([private.cut_regions(changed)], field)
        hit, missed, false = hit + len(set(found) & set(spans)), missed + len(set(spans) - set(found)), false + len(set(found) - set(spans))
    assert hit >= 0.95 * (hit + missed) and false <= 0.03 * hit


def test_clean_texts_and_lookalikes_stay_clean(field):
    rng, false = random.Random(6), 0
    for text in texts_with_data(300, 3):
        changed, _ = private.rewritten(text, private.base_spans(text), rng, private._lookalike)
        (found,) = private.find_spans([private.cut_regions(changed)], field)
        false += len(set(found) - set(private.base_spans(changed)))
    assert false <= 6
    clean = [r[1] for r in documents() if r[1]] + ["Chapter 12, page 7 (1999).", "see 3.14 and 10:30 on 2008-01-15"]
    assert not any(private.find_spans([private.cut_regions(t) for t in clean], field))


def test_regions_do_not_change_the_decision(field):
    text = " ".join(texts_with_data(60, 4))
    whole = private.find_spans([[(0, text, False, False)]], field)
    assert private.find_spans([private.cut_regions(text)], field) == whole and len(whole[0]) > 40


def test_query_columns(spark):
    texts = texts_with_data(150, 7)
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    rows += [(1000 + k, t, None, None, 0) for k, t in enumerate(EDGE_TEXTS)]
    rows += [(2000, "é🙂 a.b@c.de,+49 (30) 1234-5678 10.0.0.1", None, None, 0), rows[0], (None, texts[0], None, None, 0)]
    df = with_clashes(frame(spark, rows)).withColumnRenamed("tokens", "base").repartition(3)
    found = private.digest(private.find_private(df)).collect()
    assert len(found) == len(rows)
    by_id = {r[0]: r[1] or "" for r in rows}
    for row in found:
        base = brute_base(by_id[row.doc_id])
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        text = ",".join(f"{private.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        spans = row.spans.split(",") if row.spans else []
        assert set(text.split(",")) - {""} <= set(spans)
        keys = [(private.KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert keys == sorted(keys)


def test_no_documents_and_nothing_to_learn(spark):
    assert private.find_private(frame(spark, [])).count() == 0
    (row,) = private.digest(private.find_private(frame(spark, [(1, "no data 12", None, None, 1)]))).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
