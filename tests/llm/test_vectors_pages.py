"""Embedding join and page text against brute force."""

import numpy as np
import pytest

from wardline.llm import embedding_join, html_text

VECTORS = "vec_id bigint, embedding array<float>, label int"


def vectors(seed=0, count=260, size=12):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(count):
        base = np.array(rows[rng.integers(len(rows))][1]) if rows and k % 3 else rng.standard_normal(size)
        noise = rng.standard_normal(size) * (0 if k % 10 == 1 else 0.12)
        rows.append((k, [float(np.float32(x)) for x in base + noise], int(rng.integers(2)) if k % 17 else None))
    dense = rng.standard_normal(size)
    for k in range(count, count + 120):
        rows.append((k, [float(np.float32(x)) for x in dense + rng.standard_normal(size) * 0.05], 0))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * size, [nan] * size, [inf] + [1.0] * (size - 1), [None] + [1.0] * (size - 1), [1.0], [2.0]]
    return rows + [(len(rows) + k, value, 0) for k, value in enumerate(odd)]


def brute(rows, least=0.93):
    good = {}
    for vec_id, value, label in rows:
        fine = value and None not in value and np.isfinite(value).all() and any(value) and label is not None
        good[vec_id] = np.array(value, np.float64) if fine else None
    labels = {r[0]: r[2] for r in rows}
    links, parent = dict.fromkeys(good, 0), {i: i for i in good}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in good if good[i] is not None)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = good[a], good[b]
            if labels[a] == labels[b] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[a] += 1
                links[b] += 1
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (links[i], find(i), find(i) == i) for i in good}


@pytest.mark.parametrize("chunk", [16, 2048])
def test_links_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding_join, "CHUNK_ROWS", chunk)
    from pyspark.sql import functions as F

    rows = vectors()
    df = spark.createDataFrame([*rows, rows[3]], VECTORS).withColumns({"class_id": F.lit(-1), "size": F.lit("x")})
    found = embedding_join.near_duplicates(df.repartition(3)).collect()
    assert len(found) == len(rows) + 1
    assert {r.vec_id: tuple(r)[1:] for r in found} == brute(rows)
    assert sum(r.n_links for r in found) > 10_000


@pytest.mark.parametrize("kind", ["float", "double"])
def test_labels_of_many_chunks_equal_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(embedding_join, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(embedding_join, "CHUNK_ROWS", 16)
    rows = vectors(seed=3)
    df = spark.createDataFrame(rows, VECTORS.replace("float", kind))
    found = embedding_join.near_duplicates(df.repartition(3)).collect()
    assert {r.vec_id: tuple(r)[1:] for r in found} == brute(rows)


def test_vectors_are_not_written_once_per_cell(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(x)) for x in v], k % 2) for k, v in enumerate(rng.standard_normal((1500, 64)))]
    written, write = [], embedding_join.materialize

    def counted(df, name):
        stored = write(df, name)
        written.append(stored.count())
        return stored

    monkeypatch.setattr(embedding_join, "materialize", counted)
    found = embedding_join.near_duplicates(spark.createDataFrame(rows, VECTORS))
    assert {r.vec_id for r in found.collect()} == set(range(1500))
    assert max(written) <= len(rows)


def test_candidates_of_tiles_have_every_pair_within_the_budget():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 24))
    near = base[rng.integers(0, 60, 900)] + rng.standard_normal((900, 24)) * rng.choice([0.02, 0.2, 0.4], (900, 1))
    near = near * np.exp(rng.standard_normal((900, 1)) * 20)
    cosines = embedding_join.unit(near) @ embedding_join.unit(near).T
    for least in (0.8, 0.93):
        cut = embedding_join.tiles(near, np.arange(900), np.ones(900, np.int64), 2 - 2 * least)
        cut += embedding_join.tiles(near[::-1], np.arange(900), np.ones(900, np.int64), 2 - 2 * least)
        found = embedding_join._candidates(cut[0], cut[1], 2 - 2 * least, 24)
        close = cosines[np.ix_(cut[0]["rows"], 899 - cut[1]["rows"])] >= least
        assert close.sum() > 900 and not (close & ~found).any()
        assert not found.all()


def test_no_vectors(spark):
    assert embedding_join.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


PAGE = "<html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav>%s<footer>f</footer></body></html>"


@pytest.mark.parametrize(
    "body, expected",
    [
        ("<article><h1>Title</h1><p>One &amp; <b>two</b>three<br>four\n\t five</article>", "Title One & twothree four five"),
        ("<div class='ad'>buy</div><article>x<script>var a='</p>'</script><form>q</form>y</article>", "x y"),
        ("<main><p>a<div class='reader comments'>no</div><aside>s</aside><p>b</main>tail", "a b"),
        ("<p>plain page<div id=cookie-notice>ok?</div><p>text", "plain page text"),
        ("<article>a<!-- x <p> -->b<p hidden>h</p><div style='display: none'>h</div>c</article>", "ab c"),
        ("<article><p>unclosed <i>tags<p>go on", "unclosed tags go on"),
        ("</article></div><p>stray", "stray"),
        ("<article>&lt;b&gt; &eacute;&#233;&#x1F642; &nbsp; &unknown; a&b</article>", "<b> éé🙂 &unknown; a&b"),
        ("<article><!-- never closed", ""),
        ("", ""),
        ("<article class='post with-sidebar'><p>whole</p></article>", "whole"),
        ("<main class='content has-comments'><p>a</p><div class='comments'>no</div></main>", "a"),
        ("<div class='page-sidebar'><p>side</p><article><p>inside</p></article></div>", "inside"),
        ("<article>a</article><section class='comments'><article class='comment'>c</article></section>", "a"),
        ("<article>a</article><article class='related'>r</article>", "a"),
        ("<article><p title=it's>one</p><p>it's two</p></article>", "one it's two"),
        ("<article><p title='a>b'>one</p><p data-x=\"</p>\">two</p></article>", "one two"),
        ("<article>1 < 2 and 3<4 <5</article>", "1 < 2 and 3<4 <5"),
        ("<article><p a=\"never closed>one</p><p>two</p></article>", "one two"),
        ("<article>a<!DOCTYPE x>b<?php y ?>c</article>", "abc"),
    ],
)
def test_main_text(spark, body, expected):
    df = spark.createDataFrame([(1, "http://h/x", PAGE % body if body else None)], "page_id bigint, url string, html string")
    (row,) = html_text.extract(df).collect()
    assert (row.text, row.n_chars) == (expected, len(expected))


@pytest.mark.parametrize(
    "piece", ["<a ", "<p a=\"b", "<p a='b\"", "<b>", "</i>", "<!", "<?", "<!--", "<a \">\" ", "<p a=\"b>x", "<", "<div class='nav'>", "<p =", "< / ", "<script>", "a='"],
)
def test_broken_markup_takes_little_time(piece):
    import time

    for text in (piece * (400_000 // len(piece)), "<b>" * 60_000 + piece * 60_000, "<a " + piece * 100_000 + ">"):
        started = time.perf_counter()
        html_text.blocks(text)
        assert time.perf_counter() - started < 5


def test_repeated_runs_go_where_markup_does_not_vouch(spark):
    from pyspark.sql import functions as F

    common = "this long line stands on every page of the host and says nothing"
    rows = [(k, f"https://Example.org/{k}", f"<body><div>{common}</div><p>own words number {k}</p></body>") for k in range(6)]
    rows += [(10 + k, "https://other.org", f"<article><p>{common}</p></article>") for k in range(6)]
    rows += [(20, None, f"<p>{common}</p>"), (20, None, f"<p>{common}</p>"), (20, None, f"<p>{common}</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"host": F.lit(1), "text": F.lit(2)})
    found = html_text.extract(df).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.text == (f"own words number {row.page_id}" if row.page_id < 10 else common)


def test_covered_equals_brute_force():
    rng = np.random.default_rng(2)
    tokens, pages = rng.integers(0, 3, 500), np.sort(rng.integers(0, 8, 500))
    tokens[::41] = -1 - np.arange(len(tokens[::41]))
    for run, least in ((1, 2), (3, 2), (4, 3), (8, 2), (600, 2)):
        windows = {}
        for i in range(len(tokens) - run + 1):
            windows.setdefault(tuple(tokens[i : i + run]), set()).add(pages[i])
        expected = np.zeros(500, bool)
        for i in range(len(tokens) - run + 1):
            if len(windows[tuple(tokens[i : i + run])]) >= least and (tokens[i : i + run] >= 0).all():
                expected[i : i + run] = True
        assert (html_text.covered(tokens, pages, run, least) == expected).all()


@pytest.mark.parametrize("size", [4, 1000])
def test_repeats_are_those_of_the_whole_host(spark, monkeypatch, size):
    monkeypatch.setattr(html_text, "BUCKET_PAGES", size)
    notice, rare, copy = ("".join(f"{w}{k} " for k in range(9)) for w in ("notice", "rare", "copy"))
    texts = {k: f"own {k}" for k in range(24)}
    rows = [(k, f"<p>{t}</p>" + (f"<div>{notice}</div>" if k % 8 == 1 else f"<div>{rare}</div>" if k in (2, 13) else "")) for k, t in texts.items()]
    rows += [(100 + k, f"<div>{copy}</div>") for k in range(12)]
    rows += [(200, f"<article><p>all {notice}</p></article>"), (201, "")]
    df = spark.createDataFrame([(k, "http://h/", h) for k, h in rows], "page_id bigint, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in html_text.extract(df).collect()}
    expected = {k: f"{t} {rare}".strip() if k in (2, 13) else t for k, t in texts.items()}
    expected |= {100 + k: copy.strip() for k in range(12)} | {200: f"all {notice}".strip(), 201: ""}
    assert found == expected


def test_no_pages(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
