"""Main text of web pages: markup zones, and a suffix array over each host's pages.

1. A tokenizer of the markup cuts every page into text blocks. Each block has a zone:
   ``DROPPED`` (menus, headers, footers, sidebars, notices, adverts, forms, comments,
   by element, role or class), ``ARTICLE`` (inside ``article`` or ``main``) or ``OPEN``.
2. The pages of a host come together, hosts with many pages in buckets of about
   ``BUCKET_PAGES`` by a hash of the page id, so no host has to fit one task. A bucket's
   token streams are concatenated, with a border of its own after each block, and their
   suffixes sorted by the first ``MIN_RUN`` tokens by prefix doubling. Windows that
   ``MIN_PAGES`` distinct page texts of the host have are repeated; runs of tokens under
   such windows are covered. Exact copies are one text.
   A host of several buckets adds up over them: each bucket gives the 128-bit hashes of its
   windows with up to ``MIN_PAGES`` texts that have them, and the windows with as many
   distinct texts over all buckets go back to the buckets that have them. Hosts whose
   pages all have an article skip this, for no text of theirs depends on it.
3. A page with an article is its article's blocks: markup vouches for these, also where
   pages repeat each other. Any other page is its open blocks without covered runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import array, slices, strings
from wardline.operators.store import materialize

DROPPED, OPEN, ARTICLE = 0, 1, 2
MIN_RUN = 8
MIN_PAGES = 3
BUCKET_PAGES = 1000
_MASK = (1 << 64) - 1

_DROP_TAGS = frozenset(
    "nav header footer aside form menu dialog button select option textarea label fieldset legend"
    " iframe object noscript template head title svg canvas audio video".split()
)
_RAW_TAGS = frozenset("script style textarea title xmp noembed noframes".split())
_VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr img".split()
)
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice popup modal overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs header"
    " masthead footer comment comments disqus respond replies related recommended share sharing social subscribe"
    " subscription newsletter signup login search widget toolbar pagination pager".split()
)
# Of these, the names of parts that hold other people's texts: an article inside one is not
# the page's. An article inside any other part that a class names is.
_FOREIGN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments disqus"
    " respond replies related recommended widget newsletter".split()
)
# A class that begins so says what a part has or lacks, not what it is.
_MODIFIERS = frozenset("with has have no not without show hide is".split())
_COMMENT, _NAME = re.compile(r"<!--.*?(?:-->|\Z)", re.S), re.compile(r"[A-Za-z0-9]+")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
# One attribute: a name and, behind a sign of equality, a quoted or a bare value. A quote
# that is never closed is part of a bare value.
_ATTRIBUTE = re.compile(r"[\s/]*(?:(=?[^\s/>=]+|=)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?)?")
# Inside a part dropped for its class, which an article or the main part may interrupt.
_SOFT = 3


def _attributes(html: str, at: int) -> tuple[int, dict[str, str]]:
    """Attributes of a tag from behind its name, and where it ends; -1 where it never does.

    The first of several values of a name counts.
    """
    found: dict[str, str] = {}
    size = len(html)
    while at < size:
        match = _ATTRIBUTE.match(html, at)
        if match[1]:
            found.setdefault(match[1].lower(), unescape(match[2] or match[3] or match[4] or ""))
        at = match.end()
        if html.startswith(">", at):
            return at + 1, found
    return -1, found


def _names(value: str, whole: bool) -> set[str]:
    """Names in a class or an id; parts of hyphened names count unless ``whole``."""
    out = set()
    for name in value.lower().split():
        parts = _NAME.findall(name)
        if len(parts) == 1:
            out.add(parts[0])
        elif parts and not whole and parts[0] not in _MODIFIERS:
            out.update(parts)
    return out


def _zone(tag: str, found: dict[str, str], outer: int) -> int | None:
    """Zone that an element opens inside ``outer``, None where it keeps that one."""
    role = found.get("role", "").lower()
    main = tag == "main" or role == "main"
    hidden = "hidden" in found or found.get("aria-hidden") == "true"
    hidden = hidden or "display:none" in found.get("style", "").replace(" ", "").lower()
    if tag in _DROP_TAGS or tag not in ("html", "body") and (hidden or role in _DROP_ROLES):
        return DROPPED
    if tag in ("html", "body"):
        return None
    if main or tag == "article":
        names = _names(f"{found.get('class', '')} {found.get('id', '')}", True)
        if not main and names & _FOREIGN_NAMES:
            return DROPPED
        return ARTICLE
    names = _names(f"{found.get('class', '')} {found.get('id', '')}", False) & _DROP_NAMES
    if not names:
        return None
    return DROPPED if names & _FOREIGN_NAMES or outer == DROPPED else _SOFT


def blocks(html: str) -> list[tuple[str, int]]:
    """Text blocks of a page, white space runs as one space, with their zones.

    Takes time in proportion to the page, whatever its markup. Never fails: unclosed elements
    end with their parent, stray end tags are ignored, an unclosed comment or script reaches
    to the end of the page, what looks like a tag but has no end is text. Once a tag runs to
    the end of the page, quotes in later tags no longer hide a ``>``.
    """
    found: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}  # how many elements of a name are open
    zone, at, size, quotes = OPEN, 0, len(html), True
    last_end = html.rfind(">")

    def close() -> None:
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((text, DROPPED if zone == _SOFT else zone))

    def leave() -> int:
        name, outer = stack.pop()
        opened[name] -= 1
        return outer

    while at < size:
        start = html.find("<", at)
        if start < 0 or start > last_end and not html.startswith("<!--", start):
            # No tag can end any more, but a comment may still begin.
            start = html.find("<!--", at)
            if start < 0:
                parts.append(html[at:])
                break
        parts.append(html[at:start])
        if html.startswith("<!--", start):
            at = _COMMENT.match(html, start).end()
            continue
        if html.startswith(("<!", "<?"), start):
            at = html.find(">", start) + 1
            continue
        match = _TAG.match(html, start)
        if match is None:
            parts.append("<")
            at = start + 1
            continue
        at, attributes = _attributes(html, match.end()) if quotes else (-1, {})
        if at < 0:
            quotes = False
            at = html.find(">", match.end()) + 1
            if not at:  # no tag ends behind this one's name
                parts.append("<")
                at = start + 1
                continue
            attributes = _attributes(html[match.end() : at - 1] + ">", 0)[1]
        tag = match[2].lower()
        if match[1]:
            if opened.get(tag):
                if tag not in _INLINE_TAGS:
                    close()
                while True:
                    name = stack[-1][0]
                    outer = leave()
                    if outer != zone:
                        close()
                        zone = outer
                    if name == tag:
                        break
            elif tag not in _INLINE_TAGS:
                close()
            continue
        # A paragraph cannot hold another block, an item not the next item.
        if tag not in _INLINE_TAGS:
            close()
            if stack and stack[-1][0] in ("p", "li") and (stack[-1][0] == "p" or tag == "li"):
                zone = leave()
        if tag in _RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag in _VOID_TAGS or html.startswith("/>", at - 2) and tag not in ("p", "div", "article", "main"):
            continue
        inner = _zone(tag, attributes, zone) if zone != DROPPED else None
        if inner is None or zone == ARTICLE and inner == OPEN:
            inner = zone
        if inner != zone:
            close()
        stack.append((tag, zone))
        opened[tag] = opened.get(tag, 0) + 1
        zone = inner
    close()
    return found


def _windows(tokens: np.ndarray, run: int) -> np.ndarray:
    """Ranks of the suffixes by their first ``run`` tokens."""
    n = len(tokens)
    rank, length = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while length < run:
        step = min(length, run - length)
        pairs = rank[: n - length - step + 1] * (int(rank.max()) + 1) + rank[step : n - length + 1]
        rank, length = np.unique(pairs, return_inverse=True)[1].astype(np.int64), length + step
    return rank


def _owners(rank: np.ndarray, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes in order, one for each window and page that has it, and their number by window."""
    order = np.lexsort((pages[: len(rank)], rank))
    ranks, owners = rank[order], pages[: len(rank)][order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (ranks[1:] != ranks[:-1]) | (owners[1:] != owners[:-1])
    return order[fresh], np.bincount(ranks[fresh])


def _spread(starts: np.ndarray, tokens: np.ndarray, run: int) -> np.ndarray:
    marks = np.zeros(len(tokens) + 1, np.int64)
    marks[starts] += 1
    marks[starts + run] -= 1
    return (np.cumsum(marks[:-1]) > 0) & (tokens >= 0)


def _inside(tokens: np.ndarray, run: int) -> np.ndarray:
    """Whether the windows lie within one block each."""
    borders = np.concatenate([[0], np.cumsum(tokens < 0)])
    return borders[run:] == borders[:-run]


def covered(tokens: np.ndarray, pages: np.ndarray, run: int = MIN_RUN, least: int = MIN_PAGES) -> np.ndarray:
    """Which tokens lie in runs of ``run`` tokens or more that ``least`` pages share.

    ``tokens`` are whole numbers; a border is a negative number that occurs once.
    """
    if len(tokens) < run:
        return np.zeros(len(tokens), bool)
    rank = _windows(tokens, run)
    distinct = _owners(rank, pages)[1]
    return _spread(np.flatnonzero((distinct[rank] >= least) & (tokens[: len(rank)] >= 0)), tokens, run)


class _Stream:
    """The token stream of a bucket, with a border after each block."""

    def __init__(self, texts: list[list[str]], copies: list):
        self.words = [[t.split(" ") for t in page] for page in texts]
        self.codes, self.names = pd.factorize(pd.Series([w for page in self.words for block in page for w in block], dtype=object))
        sizes = [[len(block) for block in page] for page in self.words]
        lengths = np.array([n for page in sizes for n in page], np.int64)
        self.pages = np.repeat(pd.factorize(pd.Series(copies, dtype=object))[0], [sum(page) + len(page) for page in sizes])
        # Block k's words begin at its offset plus k borders.
        self.ends = np.cumsum(lengths) if len(lengths) else np.zeros(0, np.int64)
        self.tokens = np.insert(self.codes.astype(np.int64), self.ends, -1 - np.arange(len(self.ends)))

    def hashes(self, starts: np.ndarray) -> np.ndarray:
        """128 bits, as two numbers, of the windows at ``starts``: the same in every bucket."""
        digests = [xxhash.xxh3_128_intdigest(w) for w in self.names]
        halves = [np.array([(d >> shift) & _MASK for d in digests], np.uint64) for shift in (0, 64)]
        out = np.zeros((2, len(starts)), np.uint64)
        for k in range(MIN_RUN):
            codes = self.tokens[starts + k]
            for half in (0, 1):
                out[half] = (out[half] ^ halves[half][codes]) * np.uint64(0x9E3779B97F4A7C15)
                out[half] ^= out[half] >> np.uint64(29)
        return out.view(np.int64)


def _main_texts(stream: _Stream, zones: list[list[int]], hit: np.ndarray) -> list[str]:
    out, block = [], 0
    for page, kinds in zip(stream.words, zones):
        wanted = ARTICLE if ARTICLE in kinds else OPEN
        kept = []
        for tokens, kind in zip(page, kinds):
            start = int(stream.ends[block]) - len(tokens) + block
            block += 1
            if kind == wanted == ARTICLE:
                kept.extend(tokens)
            elif kind == wanted:
                kept.extend(t for t, gone in zip(tokens, hit[start : start + len(tokens)]) if not gone)
        out.append(" ".join(kept))
    return out


def _result(group: pa.Table, texts: list[str]) -> pa.Table:
    return pa.table({
        "page_id": group.column("page_id"), "url": group.column("url"),
        "text": array(texts, pa.string()), "n_chars": array([len(t) for t in texts], pa.int64()),
    })


def _decide(group: pa.Table) -> pa.Table:
    """Main texts of the pages of a bucket that is all of its host, or of one without need of the others."""
    group = group.sort_by([("page_id", "ascending")])
    stream = _Stream(group.column("texts").to_pylist(), group.column("copy").to_pylist())
    return _result(group, _main_texts(stream, group.column("zones").to_pylist(), covered(stream.tokens, stream.pages)))


def _offer(group: pa.Table) -> pa.Table:
    """Hashes of a bucket's windows, with the first ``MIN_PAGES`` distinct texts that have each."""
    copies = group.column("copy").to_pylist()
    stream = _Stream(group.column("texts").to_pylist(), copies)
    places = np.zeros(0, np.int64)
    if len(stream.tokens) >= MIN_RUN:
        rank = _windows(stream.tokens, MIN_RUN)
        places, distinct = _owners(rank, stream.pages)
        number = np.arange(len(places)) - np.repeat(np.cumsum(distinct) - distinct, distinct)
        places = places[(number < MIN_PAGES) & _inside(stream.tokens, MIN_RUN)[places]]
    high, low = stream.hashes(places)
    known = np.array(pd.unique(pd.Series(copies, dtype=object)), dtype=np.int64)
    bucket = group.column("bucket")[0].as_py()
    return pa.table({
        "host": array([bucket["host"]] * len(places), pa.string()),
        "bucket": array(np.full(len(places), bucket["bucket"]), pa.int64()),
        "high": high, "low": low, "copy": known[stream.pages[places]],
    })


def _decide_with(group: pa.Table, repeated: pa.Table) -> pa.Table:
    """Main texts of the pages of a bucket, given its windows that are repeated in the host."""
    group = group.sort_by([("page_id", "ascending")])
    stream = _Stream(group.column("texts").to_pylist(), group.column("copy").to_pylist())
    hit = np.zeros(len(stream.tokens), bool)
    if len(stream.tokens) >= MIN_RUN and repeated.num_rows:
        rank = _windows(stream.tokens, MIN_RUN)
        inside = _inside(stream.tokens, MIN_RUN)
        first = np.unique(rank, return_index=True)[1]
        first = first[inside[first]]
        wanted = np.rec.fromarrays([repeated.column(c).to_numpy() for c in ("high", "low")])
        found = np.zeros(int(rank.max()) + 1, bool)
        found[rank[first]] = np.isin(np.rec.fromarrays(list(stream.hashes(first))), wanted)
        hit = _spread(np.flatnonzero(found[rank] & inside), stream.tokens, MIN_RUN)
    return _result(group, _main_texts(stream, group.column("zones").to_pylist(), hit))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        found = [blocks(h) for h in strings(batch, "html")]
        texts = [[t for t, _ in page] for page in found]
        copies = [int.from_bytes(xxhash.xxh3_64_digest("\n".join(page)), "big", signed=True) for page in texts]
        columns = [*[batch.column(c) for c in ("page_id", "url", "host", "buckets")], array(copies, pa.int64())]
        columns.append(array(texts, pa.list_(pa.string())))
        columns.append(array([[z for _, z in page] for page in found], pa.list_(pa.int8())))
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "buckets", "copy", "texts", "zones"])


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hosts of pages that have open blocks and no article."""
    for batch in slices(batches, "html"):
        hosts = set()
        for host, html in zip(batch.column("host").to_pylist(), strings(batch, "html")):
            if host not in hosts:
                kinds = {zone for _, zone in blocks(html)}
                if OPEN in kinds and ARTICLE not in kinds:
                    hosts.add(host)
        yield pa.RecordBatch.from_arrays([array(sorted(hosts), pa.string())], ["host"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Null and empty pages, and pages without main text, have the empty text. A null or
    unusual address belongs to a host of its own kind. Repeated rows are repeated; they and
    other exact copies are not distinct pages to each other. Other columns are not read.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    counts = pages.groupBy(host.alias("host")).agg(F.count("*").alias("pages")).where(F.col("pages") > BUCKET_PAGES)
    large = materialize(counts.select("host", F.ceil(F.col("pages") / BUCKET_PAGES).cast("int").alias("buckets")), "page-hosts")
    narrow = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host.alias("host"), "html")
    asking = None
    if large.take(1):
        found = narrow.join(large, "host").select("host", "html").mapInArrow(_asking, "host string").distinct()
        asking = materialize(large.join(found, "host", "left_semi"), "page-asking")
    schema = "page_id bigint, url string, host string, buckets int, copy bigint, texts array<string>, zones array<tinyint>"
    result = "page_id bigint, url string, text string, n_chars bigint"

    def dealt(rows: DataFrame) -> DataFrame:
        parsed = rows.select("page_id", "url", "host", F.coalesce("buckets", F.lit(1)).alias("buckets"), "html").mapInArrow(_parse, schema)
        bucket = F.pmod(F.xxhash64("page_id"), F.col("buckets")).cast("bigint")
        # One key of both: a partitioning by host would make hot tasks.
        return parsed.select("page_id", "url", "copy", "texts", "zones", F.struct("host", bucket.alias("bucket")).alias("bucket"))

    if asking is None or not asking.take(1):
        return dealt(narrow.join(large, "host", "left")).groupBy("bucket").applyInArrow(_decide, result)
    others = narrow.join(large, "host", "left").join(asking.select("host"), "host", "left_anti")
    alone = dealt(others).groupBy("bucket").applyInArrow(_decide, result)
    shared = dealt(narrow.join(asking, "host"))
    offers = "host string, bucket bigint, high bigint, low bigint, copy bigint"
    offered = materialize(shared.groupBy("bucket").applyInArrow(_offer, offers), "page-windows")
    keys = ["host", "high", "low"]
    repeated = offered.select(*keys, "copy").distinct().groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    back = offered.select(*keys, "bucket").distinct().join(repeated.select(*keys), keys)
    back = back.select("high", "low", F.struct("host", "bucket").alias("bucket"))
    together = shared.groupBy("bucket").cogroup(back.groupBy("bucket")).applyInArrow(_decide_with, result)
    return alone.unionByName(together)
