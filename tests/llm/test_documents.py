"""Text operators against brute force."""

import collections
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.frames import DOCS, documents, frame, held, prose, with_clashes
from wardline.llm import common, gated_lm, graph, language_id, line_quality, ngram_join, source_mixing
from wardline.llm.common import WORD_PATTERN, held_out

WORD = re.compile(WORD_PATTERN)
LOWER = {c: chr(c + 32) for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


# --- language ------------------------------------------------------------------------


def grams(text):
    clean = " " + re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text.lower())).strip() + " "
    if not clean.strip():
        return 0
    return sum(1 for n in (1, 2, 3) for i in range(len(clean) - n + 1) if clean[i : i + n].strip())


@pytest.mark.parametrize("texts", [["Ab c1", "", "é--f", "  ", "a", "1a2"], ["x"], ["", ""], ["a b" * 50, "ß1ß"]])
def test_ngrams_are_those_of_each_text(texts):
    buckets, offsets = language_id.features(texts)
    assert np.diff(offsets).tolist() == [grams(t) for t in texts]
    alone = np.concatenate([language_id.features([t])[0] for t in texts])
    assert (buckets == alone).all()


def test_languages_are_found_on_held_out_documents(spark):
    rows = documents(200)
    df = with_clashes(frame(spark, rows)).repartition(3)
    languages, matrix = language_id.fit(df, ~held_out("doc_id", 4, 2))
    assert languages == ["de", "en", "fr"]
    found = {r.doc_id: r for r in language_id.predict(df, languages, matrix).collect()}
    assert len(found) == len(rows)
    for doc_id, text, lang, *_ in rows:
        has_letter = any(c.isalpha() for c in text or "")
        assert (found[doc_id].lang_pred == "und") == (not has_letter)
        assert 0 <= found[doc_id].score <= 1
        if lang and held(doc_id, 4, 2) and len(text) > 40 and "changed" not in text:
            assert found[doc_id].lang_pred == lang


def test_language_does_not_depend_on_windows(monkeypatch):
    matrix = np.random.default_rng(1).standard_normal((language_id.BUCKETS + 1, 2))
    text = "ab cd " * 40
    whole = language_id.score([text], matrix)
    monkeypatch.setattr(language_id, "WINDOW", 6)
    parts = language_id.score([text], matrix)
    assert whole[1][0] - parts[1][0] >= 0 and len(parts[0]) == 1


def test_language_without_labels_or_rows(spark):
    none = frame(spark, [(1, "abc", None, "s", 3)])
    languages, matrix = language_id.fit(none, ~held_out("doc_id", 4, 2))
    (row,) = language_id.predict(none, languages, matrix).collect()
    assert languages == [] and (row.lang_pred, row.score) == ("und", 0.0)
    assert language_id.keep_known(frame(spark, []), ~held_out("doc_id", 4, 2)).count() == 0


# --- quality -------------------------------------------------------------------------


def norm(line):
    return " ".join(words(line.translate(LOWER)))


def brute_frequent(rows, least):
    """Per host the lines above the limits, and the document that keeps each."""
    texts = collections.defaultdict(dict)
    for doc_id, text, _, source, _ in rows:
        known = texts[source or ""]
        known[text or ""] = min(known.get(text or "", doc_id), doc_id)
    frequent = {}
    for host, known in texts.items():
        holders = collections.defaultdict(set)
        for text, doc_id in known.items():
            for line in text.split("\n"):
                if norm(line):
                    holders[norm(line)].add(doc_id)
        frequent[host] = {x: min(ids) for x, ids in holders.items() if len(ids) > (min(4, least) if len(x.split()) >= 50 else least)}
    return frequent


def brute_quality(rows, least):
    frequent, out = brute_frequent(rows, least), {}
    for doc_id, text, _, source, _ in rows:
        text, found = text or "", words(text)
        lines = [line for line in text.split("\n") if norm(line)]
        grams = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
        many = collections.Counter(grams)
        repeated = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + 5)}
        gone = sum(len(words(x)) for x in lines if frequent[source or ""].get(norm(x), doc_id) != doc_id)
        failed = len(found) < 10 or 100 * len(repeated) > 20 * len(found)
        left = len(found) - gone
        out[doc_id] = (
            len(found), sum(map(len, found)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated), left, failed, not failed and left >= 10 and left >= 0.2 * len(found),
        )
    return out


def quality_rows():
    rows = documents(150)
    common = "This Line   is shared by many documents of a source and has many words in it"
    return [(i, f"{t}\n{common}\n## {i} &" if t and i % 3 else t, *rest) for i, t, *rest in rows]


def test_quality_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_quality, "MIN_TEXTS", 6)
    rows = quality_rows()
    found = {r[0]: tuple(r)[1:] for r in line_quality.judge(with_clashes(frame(spark, rows)).repartition(4)).collect()}
    assert found == brute_quality(rows, 6)
    assert any(r[5] < r[0] for r in found.values()) and not all(r[7] for r in found.values())


def test_clean_removes_frequent_lines_and_rejected_documents(spark, monkeypatch):
    monkeypatch.setattr(line_quality, "MIN_TEXTS", 6)
    rows = quality_rows()
    expected = brute_quality(rows, 6)
    df = with_clashes(frame(spark, [*rows, rows[20]]))
    kept = line_quality.clean(df)
    assert kept.columns == df.columns
    got = kept.collect()
    assert {r.doc_id for r in got} == {i for i, v in expected.items() if v[7]}
    assert all(len(words(r.text)) == expected[r.doc_id][5] and r.n_chars == len(r.text) for r in got)
    assert line_quality.judge(frame(spark, [])).count() == line_quality.clean(frame(spark, [])).count() == 0


def test_limits_of_clean_do_not_grow_with_the_host(spark):
    short = "one line that many texts of every host have"
    long = " ".join(f"passage{k}" for k in range(60))
    rows = []
    for host, size in (("small", 30), ("middle", 200), ("hot", 900)):
        for k in range(size):
            own = " ".join(f"{host}{k}x{j}" for j in range(60))
            shared = [short] if k < 70 else []
            text = "\n".join([own, *shared, *([long] if k < 6 else [])])
            rows.append((len(rows), text, "en", host, len(text)))
    kept = line_quality.clean(frame(spark, rows)).collect()
    left = collections.Counter((r.source, line) for r in kept for line in r.text.split("\n") if line in (short, long))
    assert len(kept) == len(rows)
    assert left == {("small", short): 30, ("middle", short): 1, ("hot", short): 1} | {(h, long): 1 for h in ("small", "middle", "hot")}


# --- near duplicates -----------------------------------------------------------------


def shingles(text):
    found = words((text or "").translate(LOWER))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def brute_components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def family_rows(copies=90):
    """A large family whose members differ by one to three words, so some link only by chains."""
    import random

    rng = random.Random(3)
    base = prose(rng, "en", 60).split(" ")
    rows = documents(100)
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = f"w{rng.randrange(400)}"
        rows.append((len(rows), " ".join(text), "en", "src0", None))
    return rows


@pytest.mark.parametrize("limit", [2, 24])
def test_components_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "LONG_LIST", limit)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 32)
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", 2000 * limit)
    rows = family_rows()
    df = with_clashes(frame(spark, [*rows, rows[5]])).repartition(5)
    found = ngram_join.link_components(df).collect()
    sets = {r[0]: shingles(r[1]) for r in rows}
    assert len(found) == len(rows) + 1
    assert {r.doc_id: r.component_id for r in found} == brute_components(sets)
    assert all(r.n_shingles == len(sets[r.doc_id]) for r in found)


def written(monkeypatch, module):
    """Counts the rows of what a module writes to the workspace, by name."""
    rows, write = collections.Counter(), module.materialize

    def counted(df, name):
        stored = write(df, name)
        rows[name] += stored.count()
        return stored

    monkeypatch.setattr(module, "materialize", counted)
    return rows


def test_copies_lengthen_no_list(spark, monkeypatch):
    texts = [r[1] for r in family_rows(5) if shingles(r[1])]
    found = []
    for copies in (1, 40):
        rows = written(monkeypatch, ngram_join)
        docs = [(k * len(texts) + i, text, "en", "src0", None) for k in range(copies) for i, text in enumerate(texts)]
        parts = ngram_join.link_components(frame(spark, docs).repartition(8)).collect()
        found.append((rows["shingle-candidates"], len({r.component_id for r in parts})))
    assert found[0] == found[1]


def test_unlike_sets_of_a_long_list_do_not_travel(spark, monkeypatch):
    """Texts that share four fifths of their shingles: their rare ones do not fill the index."""
    rng = np.random.default_rng(6)
    common_words = [f"c{k}" for k in range(84)]
    rows = [(k, " ".join(common_words + [f"r{x}" for x in rng.integers(0, 1 << 40, 20)]), "en", "src0", None) for k in range(150)]
    sent, take = [], ngram_join._sets_of

    def counted(docs, ids):
        sent.append(ids.distinct().count())
        return take(docs, ids)

    monkeypatch.setattr(ngram_join, "_sets_of", counted)
    monkeypatch.setattr(ngram_join, "LONG_LIST", 5)
    found = ngram_join.link_components(frame(spark, rows)).collect()
    assert all(r.component_id == r.doc_id for r in found)
    assert sent[-1] < len(rows) // 2


def test_open_sets_have_every_link_of_different_components():
    rng = np.random.default_rng(8)
    sets = []
    for k in range(300):
        base = sets[rng.integers(len(sets))] if k % 4 and sets else rng.integers(0, 1 << 62, rng.integers(1, 400)).astype(np.uint64)
        some = base[rng.random(len(base)) > 0.1 * rng.random()]
        sets.append(np.unique(np.concatenate([some, rng.integers(0, 1 << 62, 1 + len(base) // 20).astype(np.uint64)])))
    ids, known, side = np.arange(300), rng.integers(0, 40, 300), rng.integers(0, 2, 300)
    sizes, maps = np.array([len(s) for s in sets]), [ngram_join.parity_map(s) for s in sets]
    for sides in (None, side):
        found = ngram_join._open_sets(ids, known, sides, sizes, maps)
        linked, near = np.zeros(300, bool), np.zeros(300, bool)
        for a, b in itertools.combinations(range(300), 2):
            if known[a] != known[b] and (sides is None or side[a] != side[b]):
                both = len(np.intersect1d(sets[a], sets[b]))
                linked[[a, b]] |= 175 * both >= 75 * (sizes[a] + sizes[b])
                fits = 100 * min(sizes[a], sizes[b]) >= 75 * max(sizes[a], sizes[b])
                near[[a, b]] |= fits and ngram_join.apart(maps[a], maps[b]) <= sizes[a] + sizes[b] - 2 * ngram_join.needed(sizes[a], sizes[b])
        assert linked.sum() > 50 and not (linked & ~found).any()
        assert (found == near).all()


def test_block_links_in_tiles_equal_brute_force():
    rng = np.random.default_rng(9)
    sets = []
    for k in range(700):
        base = sets[-1] if k % 3 else rng.integers(0, 1 << 62, 40).astype(np.uint64)
        sets.append(np.unique(np.concatenate([base[2:], rng.integers(0, 1 << 62, 2).astype(np.uint64)])))
    ids, roots = ngram_join._block_links(np.arange(700), sets)
    assert dict(zip(ids.tolist(), roots.tolist())) == brute_components(dict(enumerate(set(s.tolist()) for s in sets)))


def test_parity_maps_never_overstate_a_difference():
    rng = np.random.default_rng(5)
    for size in (1, 7, 60, 900):
        for other in (0, 1, size // 3, size):
            a = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
            b = np.unique(np.concatenate([a[other:], rng.integers(0, 1 << 62, other // 2 + 1).astype(np.uint64)]))
            far = ngram_join.apart(ngram_join.parity_map(a), ngram_join.parity_map(b))
            assert far == ngram_join.apart(ngram_join.parity_map(b), ngram_join.parity_map(a))
            assert far <= len(set(a.tolist()) ^ set(b.tolist()))
        assert ngram_join.apart(ngram_join.parity_map(a), ngram_join.parity_map(a)) == 0


def test_overlaps_of_pairs_in_split_groups(spark, monkeypatch):
    rows = family_rows(10)
    sets = {r[0]: shingles(r[1]) for r in rows}
    some = [i for i in sorted(sets) if sets[i]]
    pairs = [(some[0], a, b, len(sets[a]), len(sets[b])) for a, b in itertools.combinations(some[:25], 2)]
    df = spark.createDataFrame(pairs, "root bigint, a bigint, b bigint, n bigint, m bigint")
    for limit in (50, 1 << 19):
        monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", limit)
        found = ngram_join._overlaps(frame(spark, [*rows, rows[0]]), df).collect()
        assert {(r.a, r.b): r.both for r in found} == {(a, b): len(sets[a] & sets[b]) for _, a, b, _, _ in pairs}
        assert len(found) == len(pairs)


def test_lists_may_span_batches():
    rng = np.random.default_rng(4)
    lists = [np.sort(rng.integers(20, 60, n)) for n in (1, 2, 40, 3, 25, 90, 1)]
    token = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    rows = [token, np.arange(len(token)), np.concatenate(lists), np.zeros(len(token), np.int64)]

    def pairs(step):
        names = ["shingle", "doc_id", "n", "position"]
        cut = [[r[i : i + step] for r in rows] for i in range(0, len(token), step)]
        found = ngram_join._candidates(pa.RecordBatch.from_arrays([pa.array(x) for x in c], names) for c in cut)
        return sorted(tuple(r.values()) for b in found for r in b.to_pylist() if r["shingle"] is None), {
            (r["shingle"], r["b"]) for b in ngram_join._candidates(
                pa.RecordBatch.from_arrays([pa.array(x) for x in c], names) for c in cut
            ) for r in b.to_pylist() if r["shingle"] is not None
        }

    whole = pairs(10_000)
    assert all(pairs(step)[0] == whole[0] for step in (7, 50))
    assert whole[1] == {(t, i) for t, i in zip(token, range(len(token))) if len(lists[t]) > 24}
    assert all(pairs(step)[1] >= whole[1] for step in (7, 50))


def test_arrow_gives_memory_back_between_batches(monkeypatch):
    """Workers outlive a stage: what one batch needed must not stay with them."""
    given = []

    class Pool:
        def release_unused(self):
            given.append(1)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batches = [pa.RecordBatch.from_pydict({"text": ["x" * 40, None, "y"]}) for _ in range(3)]
    parts = list(common.slices(iter(batches), limit=30))
    assert [p.column("text").to_pylist() for p in parts[:2]] == [["x" * 40], [None, "y"]]
    assert len(given) == 3


def test_keep_one(spark):
    rows = family_rows(10)
    component = brute_components({r[0]: shingles(r[1]) for r in rows})
    df = frame(spark, [*rows, rows[0], (None, "no key", None, None, None)])
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(component.values()))
    assert ngram_join.link_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 1), (5, 9), (9, 2), (7, 8)], [(i, i + 1) for i in range(40)]])
def test_components_of_a_graph(spark, edges):
    found = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    parent = {}
    for a, b in edges:
        if a != b:
            parent.setdefault(a, a), parent.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and parent[a] != parent[b]:
                parent[a] = parent[b] = min(parent[a], parent[b])
                changed = True
    assert found == parent


# --- mixing --------------------------------------------------------------------------


def test_mixing_meets_the_targets_in_expectation(spark):
    rows = [r for r in documents(300) if r[1]]
    found = [r.asDict() for r in source_mixing.mix_documents(with_clashes(frame(spark, rows))).collect()]
    assert len(found) == len(rows)
    for margin in source_mixing.MARGINS:
        held_tokens, wanted = collections.Counter(), collections.Counter()
        for r in found:
            held_tokens[r[margin]] += r["n_tokens"] * r["factor"]
            wanted[r[margin]] += r["n_tokens"]
        powered = {k: v ** source_mixing.POWERS[margin] for k, v in wanted.items() if v}
        for value, power in powered.items():
            share = held_tokens[value] / sum(held_tokens.values())
            assert share == pytest.approx(power / sum(powered.values()), abs=2e-3)
    scale = max(1 / max(r["factor"] for r in found), source_mixing.LEAST_SHARE)
    assert all(r["expected"] == pytest.approx(r["factor"] * scale, abs=2e-6) for r in found)
    assert all(r["kept"] == (r["copies"] > 0) and r["weight"] == 1.0 and abs(r["copies"] - r["expected"]) < 1 for r in found)
    assert abs(sum(r["copies"] for r in found) - sum(r["expected"] for r in found)) < 4 * math.sqrt(len(found))


def test_rounds_bring_the_residual_down(spark):
    rows = source_mixing.described(frame(spark, [r for r in documents(300) if r[1]]))
    worst = [max(c.residual for c in source_mixing.calibrate(rows, rounds=n).collect()) for n in (1, 3, 8)]
    assert worst[2] <= worst[1] <= worst[0] and worst[2] < 2e-3


def test_repeats_are_bounded_and_their_rest_is_a_weight(spark, monkeypatch):
    monkeypatch.setattr(source_mixing, "MOST_COPIES", 2)
    rows = [r for r in documents(300) if r[1]] + [(5000, "four words stand here", "xx", "stray", 21)]
    df = frame(spark, rows)
    found = {r.doc_id: r for r in source_mixing.mix_documents(df).collect()}
    assert found[5000].copies == 2 and found[5000].weight > 1
    assert found[5000].weight == pytest.approx(found[5000].expected / 2, abs=1e-5)
    drawn = collections.Counter(r.doc_id for r in source_mixing.sample_documents(df).collect())
    assert {i: r.copies for i, r in found.items() if r.copies} == dict(drawn)


def test_mixing_takes_given_targets_and_edge_rows(spark):
    rows = documents(60)
    described = source_mixing.described(frame(spark, rows))
    targets = {"source": spark.createDataFrame([("src0", 1.0)], "m_source string, target double")}
    cells = source_mixing.calibrate(described, targets).collect()
    assert all((c.factor > 0) == (c.m_source == "src0") for c in cells if c.tokens)
    assert source_mixing.mix_documents(frame(spark, rows)).count() == len(rows)
    assert source_mixing.mix_documents(frame(spark, [])).count() == 0
    for df in (frame(spark, rows), with_clashes(frame(spark, rows))):
        sample = source_mixing.sample_documents(df)
        assert sample.columns == df.columns and sample.exceptAll(df).groupBy(*df.columns).count().join(df, df.columns, "left_anti").count() == 0


def test_one_stray_cell_does_not_thin_out_the_sample(spark):
    rows = [r for r in documents(300) if r[1]]
    tokens = {r[0]: len(words(r[1])) for r in rows}
    stray = (len(rows) + 1000, "four words stand here", "xx", "stray", 21)
    df = frame(spark, [*rows, stray])
    cells = source_mixing.calibrate(source_mixing.described(df))
    assert max(c.factor for c in cells.collect()) > 4
    found = collections.Counter(r.doc_id for r in source_mixing.sample_documents(df).collect())
    assert found[stray[0]] >= 2 and set(found) - {stray[0]} <= set(tokens)
    assert sum(tokens.get(i, 4) * n for i, n in found.items()) > 0.4 * sum(tokens.values())
    expected = {r.doc_id: r.factor * source_mixing.LEAST_SHARE for r in source_mixing.mix_documents(df).collect() if r.n_tokens}
    assert all(abs(found[i] - e) < 1 for i, e in expected.items())


# --- language model ------------------------------------------------------------------


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(gated_lm, "RATE", 0.0)
    monkeypatch.setattr(gated_lm, "WINDOW", 200)
    rng = np.random.default_rng(0)
    model = gated_lm.Model([f"w{i}" for i in range(50)], np.sort(rng.integers(1, 99, 51))[::-1].astype(float), 40.0, 0.01)
    for name, value in model.weights.items():
        model.weights[name] = value + rng.standard_normal(value.shape) * 0.2
    lengths = rng.integers(1, 9, 12)
    tokens = rng.integers(0, 52, int(lengths.sum()))
    squares = {k: np.full_like(v, 1e-16) for k, v in model.weights.items()}
    gated_lm.train(model, tokens, lengths, squares)
    for name, value in model.weights.items():
        for place in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(5)]:
            kept, sums = value[place], []
            for step in (1e-4, -1e-4):
                value[place] = kept + step
                sums.append(gated_lm.score(model, tokens, lengths).sum() / lengths.sum())
            value[place] = kept
            assert abs(sums[0] - sums[1]) / 2e-4 == pytest.approx(math.sqrt(squares[name][place]), abs=2e-5)


def test_state_is_carried_across_windows_and_emptied_between_documents(monkeypatch):
    rng = np.random.default_rng(1)
    model = gated_lm.Model([f"w{i}" for i in range(9)], np.arange(20, 10, -1).astype(float), 5.0, 0.05)
    for name, value in model.weights.items():
        model.weights[name] = (value + rng.standard_normal(value.shape) * 0.5).astype(np.float32)
    lengths = np.array([3, 50, 1, 20, 7])
    tokens = rng.integers(0, 12, 81)
    alone = [gated_lm.score(model, t, np.array([len(t)]))[0] for t in np.split(tokens, np.cumsum(lengths)[:-1])]
    for window in (4, 32):
        monkeypatch.setattr(gated_lm, "WINDOW", window)
        assert gated_lm.score(model, tokens, lengths) == pytest.approx(alone, rel=1e-4)


def test_model_probabilities_sum_to_one():
    model = gated_lm.Model([f"w{i}" for i in range(30)], np.arange(40, 9, -1).astype(float), 12.0, 0.03)
    logs = [gated_lm.score(model, np.array([k]), np.array([1]))[0] for k in range(model.size + 2)]
    assert sum(map(math.exp, logs)) == pytest.approx(1, abs=1e-5)


def test_scores_and_base(spark):
    rows = documents(400)
    out = held_out("doc_id", 5, 1)
    found = {r.doc_id: r for r in gated_lm.score_documents(with_clashes(frame(spark, rows)).repartition(3), out).collect()}
    counts = collections.Counter()
    tokens = {r[0]: [*words((r[1] or "").translate(LOWER)), None] for r in rows}
    for doc_id, own in tokens.items():
        if not held(doc_id, 5, 1):
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    for doc_id, own in tokens.items():
        row = found[doc_id]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert row.base_score == pytest.approx(base, rel=1e-9) and row.score <= 0
        known = sum(counts[t] > 0 for t in own)
        assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (len(own), known, n, held(doc_id, 5, 1))
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_scores_without_training_rows(spark):
    df = frame(spark, [(2, "a b", None, None, 3)])
    from pyspark.sql import functions as F

    (row,) = gated_lm.score_documents(df, F.lit(True)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)
    assert gated_lm.score_documents(frame(spark, []), F.lit(False)).count() == 0


def test_schema_is_the_documents_one():
    assert DOCS.startswith("doc_id bigint, text string")


def test_training_twice_gives_the_same_scores(spark):
    """Workers of the first run live on in the second one: nothing of it may stay in them."""
    df = frame(spark, documents(60)).coalesce(1)
    one, two = (
        {r.doc_id: r.score for r in gated_lm.score_documents(df, held_out("doc_id", 5, 1)).collect()} for _ in range(2)
    )
    assert one == two and len(set(one.values())) > 20
