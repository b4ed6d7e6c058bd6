"""Main text of web pages by consensus host paths (operator 6).

1. Each page is read into containers and text blocks. A block's characters outside links count for
   the container that holds it, and in part for that container's parent; menus, headers, footers,
   sidebars, notices, adverts, forms, scripts, styles and comments count for none. A container is
   known by its generalised path: the tags and classes from the root down, digits as 0.
2. Spark adds up the pages' shares per host and path; paths with enough of a host's votes win. Votes
   by text of a path's own, without what its children count for it, are added up beside them.
3. Each page is read again with its host's winning paths. Returned are the blocks under the best one
   that holds a fair part of the page's text and under every path that wins by text of its own; all
   of the nearest ``<article>`` around these; what lies loose in the containers around them, up
   to the body (titles, introductions; no blocks of links only); and, where there is no article,
   what else the ``<main>`` or outermost container around them holds, however small, but for links and for paths
   that the host repeats: those on a tenth of its pages that have one text for many
   pages, or are mostly links. A page unlike its host's other pages falls back on its own paths.

A class, id or role of a known word marks what is not main text; inside ``<article>`` and ``<main>`` only
if the rest of the name says nothing else (``share-box``, not ``share-price``), and a heading in an article's header stays.

Votes are summed before they are shuffled, so a large host is no burden. Winning paths (at most
``1.6 / MIN_VOTES`` per host, and ``1 / MIN_VOTES`` by own text) and repeated ones (a tenth of the pages each) are written to the shared folder and joined to the pages by host; Spark
broadcasts them if they are small enough and else splits a large host's rows.

Inside a block white space (Unicode) becomes one space and ``<br>`` counts as such; character
references are decoded; blocks are joined in page order by one line feed; nothing is cut off.

Defined results: NULL or empty html and pages without text give an empty text; a NULL url is a host
of its own; repeated rows give repeated results; other columns pass through, and new columns
replace old ones of the same name; an empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_prefix, slices, written

PARENT_SHARE = 0.6  # of a block's characters that also count for the container's parent
MIN_SHARE = 0.2     # least share of a page's text for a path to get its vote, or to be used on it
MIN_VOTES = 0.1     # least votes per page of the host for a path to win

_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title select svg math object".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var br img wbr".split())
_TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr tbody thead table ul ol dl figcaption".split())
_NOT_MAIN = frozenset("nav header footer aside form button menu dialog head".split()) | _RAW
#: a start tag closes the nearest open one of these, up to one of the limits
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LIMITS = frozenset("ul ol dl table div article section main body td th".split())
#: words of class names, ids and roles that mark what is not main text
_NOT_MAIN_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets related recommended share "
    "sharing social comment comments reply replies disqus respond footer header masthead subscribe newsletter signup login search "
    "pagination pager copyright toolbar contentinfo complementary dialog alert".split())
_COMMENT_WORDS = frozenset("comment comments reply replies disqus respond".split())
#: words beside them that say no more than what part of a page it is
_PART_WORDS = frozenset("area bar block bottom box btn button buttons container content full group icons inner item items left links list "
                        "main mobile outer page panel post posts row section site slot small text title top wide wrap wrapper".split())
_NEGATED = frozenset("has with without no not is".split())
_PAGE = frozenset(("", "html", "body"))  # hold all of a page, so what lies loose in them needs votes of its own
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_LETTERS = re.compile(r"[^a-z]+")


class _Node:
    __slots__ = ("tag", "parent", "label", "path", "main", "block", "container", "article", "in_main")

    def __init__(self, tag: str, parent: _Node | None, label: str, path: int, main: bool):
        self.tag, self.parent, self.label, self.path, self.main = tag, parent, label, path, main
        self.block = parent.block if parent and tag in _INLINE else self  # the element whose block its text is in
        self.container = parent.container if parent and (tag in _INLINE or tag in _TEXT_BLOCK) else self
        self.article = self if tag == "article" else parent.article if parent else None  # the nearest
        self.in_main = tag == "main" or parent is not None and parent.in_main


def _open(tag: str, attrs: str, parent: _Node) -> _Node:
    inside = parent.article is not None or parent.in_main  # of <article> or <main>
    main, label = parent.main and tag not in _NOT_MAIN, tag
    if tag in _HEADING and parent.tag == "header" and parent.article is not None and parent.parent.main:
        main = True
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                main = False
                continue
            if name == "class":
                label = tag + "." + ".".join(sorted(set(re.sub(r"\d+", "0", value).split())))
            if main and tag not in ("html", "body", "main"):
                marks = _COMMENT_WORDS if tag == "article" else _NOT_MAIN_WORDS
                for one in value.lower().split():
                    words = [w for w in _LETTERS.split(one) if w]
                    if words and words[0] not in _NEGATED and not marks.isdisjoint(words) and (
                            not inside or all(w in marks or w in _PART_WORDS for w in words)):
                        main = False
    return _Node(tag, parent, label, xxhash.xxh64_intdigest(label, parent.path), main)


def _blocks(page: str) -> list[tuple[_Node, str, int]]:
    """``(node, text, characters in links)`` of a page's main-text blocks, in order. Linear in the page."""
    stack, out, buffer, linked = [_Node("", None, "", 0, True)], [], [], 0
    opened: dict[str, int] = defaultdict(int)  # how many of a tag are open
    at = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = "".join(buffer)
            text = " ".join((_html.unescape(text) if "&" in text else text).split())
            if text:
                out.append((stack[-1].block, text, min(linked, len(text))))
            buffer.clear()
        linked = 0

    def close(tag: str) -> None:
        last = ""
        while last != tag:
            last = stack.pop().tag
            opened[last] -= 1

    while True:
        m = _TAG.search(page, at)
        end = m.start() if m else len(page)
        if end > at and stack[-1].main:
            buffer.append(page[at:end])
            if opened["a"]:
                linked += end - at
        if not m:
            break
        at, tag = m.end(), m[2]
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in _INLINE
        if not inline:
            flush()
        elif tag == "br":
            buffer.append(" ")
        if m[1]:
            if opened[tag] > 0:
                close(tag)
        elif tag in _RAW and not m[3].endswith("/"):
            shut = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = shut.end() if shut else len(page)
        elif tag not in _VOID and not m[3].endswith("/"):
            if not inline and opened["p"]:  # a block ends an open paragraph
                close("p")
            if tag in _CLOSES:
                near = next((n.tag for n in reversed(stack) if n.tag in _CLOSES[tag] or n.tag in _LIMITS or not n.parent), "")
                if near in _CLOSES[tag]:
                    close(near)
            stack.append(_open(tag, m[3], stack[-1]))
            opened[tag] += 1
    flush()
    return out


def _shares(blocks: list[tuple[_Node, str, int]]) -> dict[int, tuple[float, float, _Node]]:
    """Path -> its share of the page's text outside links, that by text of its own (0 if small), and one of its containers."""
    score: dict[int, float] = defaultdict(float)
    own: dict[int, float] = defaultdict(float)
    one: dict[int, _Node] = {}
    for node, text, links in blocks:
        c = node.container
        own[c.path] += len(text) - links
        for n, part in ((c, 1.0), (c.parent, PARENT_SHARE)):
            if n is not None:
                score[n.path] += part * (len(text) - links)
                one.setdefault(n.path, n)
    total = sum(len(text) - links for _, text, links in blocks)
    return {p: (s / total, own[p] / total if own[p] >= MIN_SHARE * total else 0.0, one[p])
            for p, s in score.items() if s >= MIN_SHARE * total} if total else {}


def _name(node: _Node) -> str:
    labels = []
    while node.parent is not None:
        labels.append(node.label)
        node = node.parent
    return ">".join(reversed(labels))


def page_text(page: str, winning: list[int], holding: list[int] | None = None, barred: list[int] | None = None) -> str:
    """Main text of a page; ``winning``: its host's paths, best first; ``holding``: those that win by text of their own;
    ``barred``: those that the host repeats (None: not known, so only what lies loose around the main text is taken)."""
    blocks = _blocks(page)
    shares = _shares(blocks)
    path = next((p for p in winning if p in shares), None)
    if path is None and shares:
        path = max(shares, key=lambda p: (shares[p][0], -p))
        holding, barred = [p for p, s in shares.items() if s[1]], None
    if path is None:
        return "\n".join(text for _, text, _ in blocks)
    paths = {path, *(holding or ())}
    tops: list[_Node] = []  # the outermost chosen containers

    def under(chosen) -> set[int]:
        """Blocks (by number) under a node that is ``chosen``; each node is looked at once."""
        inside: dict[int, bool] = {}
        out = set()
        for i, (node, _, _) in enumerate(blocks):
            chain = []
            while node is not None and id(node) not in inside:
                chain.append(node)
                node = node.parent
            found = inside[id(node)] if node is not None else False
            for n in reversed(chain):
                if not found and chosen(n):
                    found = True
                    tops.append(n)
                inside[id(n)] = found
            if found:
                out.add(i)
        return out

    kept = under(lambda n: n.path in paths)
    articles = {id(n.article) for n in tops if n.article is not None}
    if articles:
        kept |= under(lambda n: id(n) in articles)
    around: set[int] = set()
    for n in tops:
        while (n := n.parent) is not None and id(n) not in around:
            around.add(id(n))
    kept |= {i for i, (node, text, links) in enumerate(blocks) if id(node.container) in around
             and node.container.tag not in _PAGE and (links < len(text) or node.tag in _HEADING)}
    if barred is not None:
        kept |= _beside(blocks, [n for n in tops if n.article is None], paths, frozenset(barred))
    return "\n".join(text for i, (_, text, _) in enumerate(blocks) if i in kept)


def _beside(blocks: list[tuple[_Node, str, int]], tops: list[_Node], paths: set[int], barred: frozenset[int]) -> set[int]:
    """Blocks (by number) of the ``<main>`` or outermost container around each of ``tops`` that are not under a barred path and not mostly links."""
    regions = set()
    for n in tops:
        region = n
        while n.tag != "main" and n.parent is not None and n.parent.tag not in _PAGE:
            n = n.parent
            region = n
        regions.add(id(region))
    state: dict[int, int] = {}  # node -> 0 outside, 1 inside, 2 under a barred path
    chars: dict[int, int] = defaultdict(int)
    linked: dict[int, int] = defaultdict(int)
    out = []
    for i, (node, text, links) in enumerate(blocks):
        c = node.container
        chars[id(c)] += len(text)
        linked[id(c)] += links
        chain, n = [], c
        while n is not None and id(n) not in state:
            chain.append(n)
            n = n.parent
        now = state[id(n)] if n is not None else 0
        for n in reversed(chain):
            if now == 1 and n.path in barred and n.path not in paths:
                now = 2
            elif now == 0 and id(n) in regions:
                now = 1
            state[id(n)] = now
        if now == 1:
            out.append((i, c))
    return {i for i, c in out if 2 * linked[id(c)] < chars[id(c)]}


def _path_texts(blocks: list[tuple[_Node, str, int]]) -> dict[int, tuple[int, int, int]]:
    """Path -> hash of the texts that its containers hold themselves, their characters, and those in links."""
    held: dict[int, list[str]] = defaultdict(list)
    chars: dict[int, int] = defaultdict(int)
    linked: dict[int, int] = defaultdict(int)
    for node, text, links in blocks:
        path = node.container.path
        held[path].append(text)
        chars[path] += len(text)
        linked[path] += links
    return {p: (xxhash.xxh64_intdigest("\n".join(texts)), chars[p], linked[p]) for p, texts in held.items()}


def host_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, paths, holding, barred``: each host's winning paths, best first, those that win by text of their own, and those it repeats."""
    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "page"):
            rows = []
            for host, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not x:
                    continue
                blocks = _blocks(x)
                shares, texts = _shares(blocks), _path_texts(blocks)
                for p in {**shares, **texts}:
                    share, own, node = shares.get(p, (0.0, 0.0, None))
                    h, chars, linked = texts.get(p, (None, 0, 0))
                    rows.append((host, signed(p), share, own, _name(node) if node else None, None if h is None else signed(h), chars, linked))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    names = ["host", "path", "share", "own", "name", "held", "chars", "linked"]
    kinds = (pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    own = pages.select(host_of(url).alias("host"), F.col(page).alias("page"))
    n = own.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("page").alias("texts"))
    votes = (own.mapInArrow(run, "host string, path long, share double, own double, name string, held long, chars long, linked long")
             .groupBy("host", "path").agg(F.round(F.sum("share"), 6).alias("votes"), F.round(F.sum("own"), 6).alias("own"), F.min("name").alias("name"),
                                          F.count("held").alias("pages"), F.approx_count_distinct("held").alias("texts"),
                                          F.sum("chars").alias("chars"), F.sum("linked").alias("linked")))
    both = votes.alias("v").join(n.alias("n"), F.col("v.host").eqNullSafe(F.col("n.host")))
    wins = F.col("votes") >= MIN_VOTES * F.col("n.n")
    # on a tenth of the host's pages, and one text for two of them or more, or mostly links
    repeats = ((F.col("pages") >= F.greatest(F.lit(2.0), MIN_VOTES * F.col("n.n")))
               & ((2 * F.col("v.texts") <= F.least(F.col("pages"), F.col("n.texts"))) | (2 * F.col("linked") > F.col("chars"))))
    marked = F.collect_list(F.struct((-F.col("votes")).alias("rank"), "name", "path", (F.col("own") >= MIN_VOTES * F.col("n.n")).alias("holds"),
                                     wins.alias("wins"), repeats.alias("repeats")))
    best = both.filter(wins | repeats).groupBy(F.col("v.host").alias("host")).agg(F.sort_array(marked).alias("best"))

    def paths(which) -> Column:
        return F.transform(F.filter("best", which), lambda x: x["path"])

    return best.select("host", paths(lambda x: x["wins"]).alias("paths"), paths(lambda x: x["wins"] & x["holds"]).alias("holding"),
                       paths(lambda x: x["repeats"] & ~x["wins"]).alias("barred"))


def host_of(url: str):
    """Host of a url, in lower case, without a leading ``www.`` or ``m.``."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), r"^(?:www|m)\.", "")


def main_text(pages: DataFrame, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with ``text``, the main text of each."""
    keep = pages.select(*[c for c in pages.columns if c != text])
    own, host, *lists = (free_prefix(pages) + c for c in ("own", "host", "paths", "holding", "barred"))
    paths = written(host_paths(pages, url, page)).toDF(host, *lists)
    joined = keep.withColumn(own, host_of(url)).join(paths, F.col(own).eqNullSafe(F.col(host)), "left").drop(own, host)
    names = keep.columns
    schema = T.StructType([*keep.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, page):
            html, *known = (b.column(b.schema.get_field_index(c)).to_pylist() for c in (page, *lists))
            out = [page_text(x, *([p & (1 << 64) - 1 for p in w or ()] for w in ws)) if x else "" for x, *ws in zip(html, *known)]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in names], pa.array(out, pa.string())],
                                             names=[*names, text])

    return joined.mapInArrow(run, schema)
