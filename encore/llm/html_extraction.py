"""HTML extraction by wrapper induction.

Each page is read once into a DOM tree of its blocks that may be content; what it declares itself to be none (navigation,
footers, forms, adverts, comments) is left out. A few pages of every host are its wrapper: those of least digest, and as many more as it takes
to show every text that could be template at its place, by counts over all pages. Every page is aligned with each of them by simple tree matching: nodes of one label match, their children by the
heaviest ordered matching, however many and deep they are, in which equal texts weigh most, so that siblings of one label are told apart. What pages say of
the wrapper's blocks merges in any order, as counts. A block that nearly all pages of a wrapper page show with the same text is template; slots whose
texts vary are content.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from html.parser import HTMLParser
from math import isqrt
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import checkpointed, small_batches
from .url_filters import host_of

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = HEADINGS | set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead "
    "tr ul title head caption".split())
#: Elements whose end a start tag of the key implies.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
#: An implied end does not reach beyond these.
SCOPES = set("html body table ul ol dl select article section div main aside nav form blockquote header footer figure details".split())

#: Fixed lists of what pages declare as no content: elements, roles, and words of classes and ids.
NO_CONTENT = set(
    "head title nav footer aside form script style noscript template iframe object svg canvas button select textarea dialog "
    "menu audio video math map".split())
NO_CONTENT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NO_CONTENT_WORDS = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer sidebar aside widget widgets ad ads advert adverts "
    "advertisement advertising adsense banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice "
    "notices notification popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments disqus respond replies reply pagination pager toolbar skip paywall masthead "
    "alert announcement rail sidenav discussion responses advertorial outbrain taboola".split())
#: Those that also an article or main element may carry to say so.
NO_ARTICLE_WORDS = {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "related", "sponsored", "promo"}
#: Those whose elements hold texts of others, also as articles; an article in an element with another of the words may be the page's own.
OTHERS_WORDS = NO_ARTICLE_WORDS | set("adverts advertisement sponsor sponsors recommended recommendations disqus respond discussion responses outbrain taboola".split())
HEADER_WORDS = {"header", "topbar"}
#: Parts of a class or id that make it a state of the element and not its kind: has-sidebar, ad-free, comments-open.
STATES_BEFORE = set("has have no not with without is hide show enable disable".split())
STATES_AFTER = set("free open closed enabled disabled active visible on off".split())
WORDS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

#: Pages of a host that must show a block with one text before it is template, and their least share of all its pages.
TEMPLATE_PAGES, TEMPLATE_SHARE = 3, 0.8
#: A page with more than so many times the text of its articles has its body beside them.
TEASER = 3
#: The first wrapper pages of a host, and the most blocks of one of these. More are added, of any length, until every frequent text is shown.
REFERENCES, REFERENCE_BLOCKS = 2, 500
#: What two blocks of one text weigh in a matching; any other pair of nodes weighs one.
EQUAL = 64
#: Pairs of siblings up to which the whole table of their heaviest matching is kept; of larger ones some rows are, and the others made again.
SIBLING_PAIRS = 2_500
#: Weights of pairs that a matching keeps, at most; it forgets them and weighs again.
WEIGHTS_AT_ONCE = 1_000_000
#: Frames of nested matchings; each level of a page takes four.
FRAMES = 1_000_000
#: Blocks whose statistics a task holds before it gives them on, and hosts whose trees it holds.
BLOCKS_AT_ONCE, HOSTS_AT_ONCE = 50_000, 100

#: The label of a block's text in a tree, and a node or text of it: (label, digest, weight of itself, its number or its children).
TEXT = -1
Node = tuple


@lru_cache(4096)
def declared(names: str) -> frozenset[str]:
    """The words of classes and ids that say what an element is, without those that tell a state of it."""
    words: set[str] = set()
    for name in names.lower().split():
        parts = WORDS.findall(name)
        if len(parts) > 1 and (parts[0] in STATES_BEFORE or parts[-1] in STATES_AFTER):
            continue
        words.update(parts)
    return frozenset(words)


@lru_cache(4096)
def label_of(tag: str, classes: str, id: str) -> int:
    """Number of an element's tag, classes and id without digits; nodes of other labels never match."""
    return xxhash.xxh64_intdigest(f"{tag}.{'.'.join(sorted(classes.split()))}#{re.sub('[0-9]+', '', id)}") >> 1


class Blocks(HTMLParser):
    """Blocks (node, text, in an article, in main, a list item of links, restored) of a page, without what is declared as no content.

    Levels: 0 content, 1 a header inside an article, of which headings count, 2 no content, 3 no content by a word or a form, in
    which an article or main element counts again. Blocks of such are restored.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str, bool, bool, bool, bool]] = []
        self.open: list[tuple[str, int, int, bool, bool, bool]] = [("", 0, 0, False, False, False)]
        self.text: list[str] = []
        self.only_links = True
        #: The parent and label of every node, in the order of start tags.
        self.nodes: list[tuple[int, int]] = [(-1, 0)]

    def end_block(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                at = next(o for o in reversed(self.open) if o[0] in BLOCKS or not o[0])
                in_list = self.only_links and any(o[0] == "li" for o in self.open)
                self.blocks.append((at[1], text, *self.open[-1][3:5], in_list, self.open[-1][5]))
            self.text, self.only_links = [], True

    def close(self) -> None:
        if self.rawdata.startswith("<!--"):
            self.rawdata = ""  # a comment without an end lasts to the end of the page
        super().close()
        self.end_block()

    def level_of(self, tag: str, attrs: dict[str, str], inside: tuple[str, int, int, bool, bool, bool]) -> int:
        own = tag in ("article", "main") or attrs.get("role") == "main"
        if inside[2] == 2 or tag in NO_CONTENT and tag != "form" or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return 2
        if tag in ("html", "body"):
            return 0
        roles = set(attrs.get("role", "").lower().split())
        if roles & NO_CONTENT_ROLES - {"form"} or HIDDEN.search(attrs.get("style", "").lower()):
            return 2
        words = declared(f"{attrs.get('class', '')} {attrs.get('id', '')}")
        if words & (NO_ARTICLE_WORDS if own else OTHERS_WORDS):
            return 2
        if tag == "form" or "form" in roles or not own and words & NO_CONTENT_WORDS:
            return 3
        if tag == "header" or (words & HEADER_WORDS and tag not in HEADINGS and not own):
            return 1 if inside[3] or inside[4] else 2
        return 0 if own and inside[2] == 3 else inside[2]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "hr":
                self.end_block()
            elif tag in ("br", "wbr", "img") and self.text:
                self.text.append("" if tag == "wbr" else " ")
            return
        if tag in BLOCKS:
            self.end_block()
            self.close_implied({"p"} | HEADINGS & {tag} if tag != "p" else {"p"})
        if tag in IMPLIED:
            self.close_implied(IMPLIED[tag])
        inside = self.open[-1]
        values = {k: v or "" for k, v in attrs}
        level = self.level_of(tag, values, inside)
        node = inside[1]
        if tag in BLOCKS:
            self.nodes.append((node, label_of(tag, values.get("class", ""), values.get("id", ""))))
            node = len(self.nodes) - 1
        self.open.append((tag, node, level, inside[3] or tag == "article", inside[4] or tag == "main" or values.get("role") == "main",
                          inside[5] or inside[2] == 3 and level == 0))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # a slash in a start tag means nothing in HTML, but closes foreign elements
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path", "iframe", "script"):
            self.handle_endtag(tag)

    def close_implied(self, tags: set[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                del self.open[i:]
                return
            if self.open[i][0] in SCOPES:
                return

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                if any(o[0] in BLOCKS for o in self.open[i:]):
                    self.end_block()
                del self.open[i:]
                return
            if tag not in SCOPES and self.open[i][0] in SCOPES:
                return  # the end of an element outside this one is not here

    def handle_data(self, data: str) -> None:
        level = self.open[-1][2]
        if level == 0 or level == 1 and any(o[0] in HEADINGS for o in self.open):
            self.text.append(data)
            if self.only_links and data.strip() and not any(o[0] == "a" for o in self.open):
                self.only_links = False


def _characters(blocks: Sequence[tuple]) -> int:
    return sum(len(b[1]) for b in blocks)


def _main_part(blocks: list[tuple]) -> list[tuple]:
    """The main element if the articles lie in it or are shorter; else the articles; else the whole page. List items that are links only count
    in articles alone: elsewhere they are menus."""
    articles, main = [b for b in blocks if b[2]], [b for b in blocks if b[3] and (b[2] or not b[4])]
    outside = [b for b in articles if not b[3]]
    whole = [b for b in blocks if b[2] or not b[4]]
    if main and _characters(main) >= _characters(outside):
        return main
    if articles and _characters(whole) <= TEASER * _characters(articles):
        return articles
    return whole


def page_of(html: str | None) -> tuple[list[int], list[int], list[int], list[str]]:
    """The tree of a page's blocks that may be content: labels and parents of nodes, the root first, and nodes and texts of blocks, all in page order.

    Articles and main elements in an element that a word or a form declares as no content count where
    nothing outside of it is an article or main element and they hold more text than what is outside.
    """
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    plain, restored = [b for b in parser.blocks if not b[5]], [b for b in parser.blocks if b[5]]
    if restored and not any(b[2] or b[3] for b in plain) and _characters(restored) > _characters(plain):
        plain = restored
    blocks, used = _main_part(plain), {0}
    for b in blocks:
        node = b[0]
        while node not in used:
            used.add(node)
            node = parser.nodes[node][0]
    kept = sorted(used)
    number = {n: i for i, n in enumerate(kept)}
    labels, parents = [parser.nodes[n][1] for n in kept], [number.get(parser.nodes[n][0], -1) for n in kept]
    return labels, parents, [number[b[0]] for b in blocks], [b[1] for b in blocks]


def blocks_of(html: str | None) -> list[tuple[int, str]]:
    """(node, text) of the blocks that may be content, in page order."""
    return list(zip(*page_of(html)[2:]))


def tree(labels: Sequence[int], parents: Sequence[int], at: Sequence[int], digests: Sequence[int]) -> list[Node]:
    """The children of a page's root, from its nodes and the nodes and digests of its blocks."""
    children: list[list[tuple[int, Node]]] = [[] for _ in labels]
    for block, (node, digest) in enumerate(zip(at, digests)):
        children[node].append((block, (TEXT, digest, EQUAL, block)))
    for node in range(len(labels) - 1, 0, -1):
        inside = sorted(children[node], key=itemgetter(0))
        items = [c for _, c in inside]
        digest = hash((labels[node], *[c[1] for c in items]))
        children[parents[node]].append((inside[0][0], (labels[node], digest, 1 + sum(c[2] for c in items), items)))
    return [c for _, c in sorted(children[0], key=itemgetter(0))]


def slots(labels: Sequence[int], parents: Sequence[int], at: Sequence[int], digests: Sequence[int]) -> list[int]:
    """Digests of the blocks of a page with the labels on the way to them. Only blocks of one such way are ever matched."""
    ways = [0]
    for label, parent in zip(labels[1:], parents[1:]):
        ways.append(hash((ways[parent], label)))
    return [hash((ways[node], digest)) for node, digest in zip(at, digests)]


def _is_plain(node: Node) -> bool:
    return node[0] == TEXT or len(node[3]) == 1 and node[3][0][0] == TEXT


def _leaves(nodes: list[Node]) -> set[int]:
    """Digests of all texts below some nodes."""
    found, left = set(), list(nodes)
    while left:
        node = left.pop()
        if node[0] == TEXT:
            found.add(node[1])
        else:
            left.extend(node[3])
    return found


def _kinds(nodes: list[Node], shared: set[int]) -> tuple[list[int], list[Node]]:
    """A number for each node and the first node of each number: equal for nodes that differ only in texts which the other side lacks.

    Such texts equal none there, so nodes of one kind weigh the same with any node of the other side.
    """
    numbers: dict[tuple, int] = {}

    def kind(node: Node) -> int:
        inside = (node[1] if node[1] in shared else None,) if node[0] == TEXT else tuple([kind(c) for c in node[3]])
        return numbers.setdefault((node[0], inside), len(numbers))

    first: dict[int, Node] = {}
    each = [kind(x) for x in nodes]
    for k, x in zip(each, nodes):
        first.setdefault(k, x)
    place = {k: i for i, k in enumerate(first)}
    return [place[k] for k in each], list(first.values())


class Matching:
    """Simple tree matching of two pages."""

    def __init__(self):
        self.known: dict[tuple[int, int], int] = {}

    def weight(self, a: Node, b: Node) -> int:
        above = 0
        while a[0] == b[0]:
            if a[1] == b[1]:
                return above + a[2]
            above += 1
            if a[0] == TEXT:
                return above
            if not len(a[3]) == 1 == len(b[3]):
                key = id(a), id(b)
                if key not in self.known:
                    inside = self.siblings(a[3], b[3])[0]
                    if len(self.known) >= WEIGHTS_AT_ONCE:
                        self.known.clear()
                    self.known[key] = inside
                return above + self.known[key]
            a, b = a[3][0], b[3][0]
        return above

    def siblings(self, a: list[Node], b: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
        """Weight and pairs of the heaviest ordered matching of two lists of siblings. Equal ends always match."""
        least, start, end = min(len(a), len(b)), 0, 0
        while start < least and a[start][1] == b[start][1]:
            start += 1
        while end < least - start and a[-1 - end][1] == b[-1 - end][1]:
            end += 1
        pairs = list(zip(a[:start], b[:start])) + list(zip(a[len(a) - end:], b[len(b) - end:]))
        total = sum(x[2] for x, _ in pairs)
        a, b = a[start:len(a) - end], b[start:len(b) - end]
        if a and b:
            inner, between = self._between(a, b)
            total, pairs = total + inner, pairs[:start] + between + pairs[start:]
        return total, pairs

    def _between(self, a: list[Node], b: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
        if len({x[0] for x in a} | {x[0] for x in b}) == 1 and all(map(_is_plain, a)) and all(map(_is_plain, b)) and not (
                {x[1] for x in a} & {x[1] for x in b}):
            pairs = list(zip(a, b))  # all pairs weigh the same
            return len(pairs) * self.weight(*pairs[0]), pairs
        if len(a) * len(b) > SIBLING_PAIRS:
            if len(a) <= len(b):
                return self._long(a, b)
            total, pairs = self._long(b, a)
            return total, [(x, y) for y, x in pairs]
        table = [[0] * (len(b) + 1)]
        for x in a:
            above, row = table[-1], [0]
            for j, y in enumerate(b):
                best = max(above[j + 1], row[j])
                if x[0] == y[0]:
                    best = max(best, above[j] + self.weight(x, y))
                row.append(best)
            table.append(row)
        i, j, pairs = len(a), len(b), []
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((a[i], b[j]))
        return table[-1][-1], pairs[::-1]

    def _weights(self, a: list[Node], b: list[Node]) -> Callable[[int], np.ndarray]:
        """The weights of a sibling of the one list with all of the other. Pairs of two kinds are weighed once, those of single texts all at once."""
        shared = _leaves(a) & _leaves(b)
        (mine, first), (others, kinds) = _kinds(a, shared), _kinds(b, shared)
        labels, digests, plain = (np.array([f(y) for y in kinds]) for f in (itemgetter(0), itemgetter(1), _is_plain))
        rows: dict[int, np.ndarray] = {}

        def weights(i: int) -> np.ndarray:
            x = first[mine[i]]
            if mine[i] not in rows:
                same, equal = labels == x[0], digests == x[1]
                row = np.where(equal, x[2], 1 if x[0] == TEXT else 2) * same
                for k in np.flatnonzero(same & ~equal & ~(plain & _is_plain(x))):
                    row[k] = self.weight(x, kinds[k])
                if (len(rows) + 1) * len(kinds) > WEIGHTS_AT_ONCE:
                    rows.clear()
                rows[mine[i]] = row
            return rows[mine[i]][others]

        return weights

    def _long(self, a: list[Node], b: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
        """The matching of many siblings: of the table one row in about the root of all is kept, those between are made again on the way back."""
        weights, step = self._weights(a, b), isqrt(len(a)) + 1

        def below(above: np.ndarray, i: int) -> np.ndarray:
            row = np.zeros_like(above)
            np.maximum.accumulate(np.maximum(above[1:], above[:-1] + weights(i)), out=row[1:])
            return row

        row, kept = np.zeros(len(b) + 1, dtype=np.int64), []
        for i in range(len(a)):
            if i % step == 0:
                kept.append(row)
            row = below(row, i)
        j, pairs, total = len(b), [], int(row[-1])
        for n in range(len(kept) - 1, -1, -1):
            table = [kept[n]]
            for i in range(n * step, min(len(a), (n + 1) * step)):
                table.append(below(table[-1], i))
            i = len(table) - 1
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((a[n * step + i], b[j]))
        return total, pairs[::-1]

    def _pairs(self, a: list[Node], b: list[Node]) -> Iterator[tuple[Node, Node]]:
        if len(a) == 1 == len(b):
            return iter([(a[0], b[0])] if a[0][0] == b[0][0] else [])
        return iter(self.siblings(a, b)[1])

    def blocks(self, a: list[Node], b: list[Node]) -> Iterator[tuple[int, int, bool]]:
        """Matched blocks of two pages, and whether their texts are equal."""
        left = [self._pairs(a, b)]
        while left:
            x, y = next(left[-1], (None, None))
            if x is None:
                left.pop()
            elif x[0] == TEXT:
                yield x[3], y[3], x[1] == y[1]
            else:
                left.append(self._pairs(x[3], y[3]))


TREE = "labels array<long>, parents array<int>, at array<int>, digests array<long>"


def _read(kept: int):
    """Pages as trees: kept columns, host, tree, slots, texts, digest and characters of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [page_of(html.as_py()) for html in batch.column(kept + 1)]
            digests = [[xxhash.xxh64_intdigest(t) >> 1 for t in p[3]] for p in pages]
            whole = [xxhash.xxh64_intdigest(repr((p[:3], d))) >> 1 for p, d in zip(pages, digests)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept + 1], pa.array([p[0] for p in pages], pa.list_(pa.int64())),
                 *[pa.array([p[i] for p in pages], pa.list_(pa.int32())) for i in (1, 2)], pa.array(digests, pa.list_(pa.int64())),
                 pa.array([slots(*p[:3], d) for p, d in zip(pages, digests)], pa.list_(pa.int64())),
                 pa.array([p[3] for p in pages], pa.list_(pa.string())), pa.array(whole, pa.int64()),
                 pa.array([sum(map(len, p[3])) for p in pages], pa.int64())],
                names=[*[f"k{i}" for i in range(kept)], "host", "labels", "parents", "at", "digests", "slots", "texts", "digest", "chars"])

    return run


def read_pages(pages: DataFrame, url: str, html: str, keep: Sequence[str]) -> DataFrame:
    """(k0.., host, labels, parents, at, digests, slots, texts, digest, chars) of every page."""
    source = pages.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                          host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))
    types = [f"k{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    return source.mapInArrow(_read(len(keep)), ", ".join([*types, "host string", TREE, "slots array<long>, texts array<string>, digest long, chars long"]))


def _trees(rows: dict, host: str, wrapper: pa.Scalar) -> list[tuple[list[Node], set[int]]]:
    """The wrapper pages of a host with the blocks that are sought, template ones if those are known; built once for many pages."""
    if host not in rows:
        if len(rows) >= HOSTS_AT_ONCE:
            rows.clear()
        rows[host] = [(tree(w["labels"], w["parents"], w["at"], w["digests"]), set(w["template"] if "template" in w else range(len(w["at"]))))
                      for w in wrapper.as_py()]
    return rows[host]


def _shown(known: list[tuple[list[Node], set[int]]], *page: list[int]) -> Iterator[list[tuple[int, int]]]:
    """For each wrapper page the sought blocks of it that a page shows with the same text, and the page's own blocks."""
    sys.setrecursionlimit(max(FRAMES, sys.getrecursionlimit()))
    own = tree(*page)
    for reference, sought in known:
        yield [(a, b) for a, b, same in Matching().blocks(reference, own) if same and a in sought]


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pages of a task say of the blocks of their host's wrapper pages; block -1 counts pages and their characters."""
    found: dict[tuple[str, int, int], list[int]] = {}
    hosts: dict = {}

    def rows() -> pa.RecordBatch:
        keys, values = list(found), list(found.values())
        columns = [pa.array([k[0] for k in keys], pa.string()), *[pa.array([k[i] for k in keys], pa.int32()) for i in (1, 2)],
                   *[pa.array([v[i] for v in values], pa.int64()) for i in range(2)]]
        return pa.RecordBatch.from_arrays(columns, names=["host", "reference", "block", "same", "chars"])

    def count(key: tuple[str, int, int], chars: int) -> None:
        s = found.setdefault(key, [0, 0])
        s[0], s[1] = s[0] + 1, s[1] + chars

    for batch in batches:
        names = batch.schema.names
        trees = [c.to_pylist() for c in batch.columns[:names.index("wrapper")]]
        for (host, labels, parents, at, digests, lengths, chars), wrapper in zip(zip(*trees), batch.column("wrapper")):
            for n, shown in enumerate(_shown(_trees(hosts, host, wrapper), labels, parents, at, digests)):
                count((host, n, -1), chars)
                for block, own in shown:
                    count((host, n, block), lengths[own])
            if len(found) > BLOCKS_AT_ONCE:
                yield rows()
                found.clear()
    yield rows()


def frequent_slots(pages: DataFrame) -> DataFrame:
    """(host, open): the slots that enough of all different pages of a host have to be template; a block of no other can be."""
    whole = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    shown = pages.select("host", F.explode(F.array_distinct("slots")).alias("slot")).groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n"))
    often = shown.where(F.col("n") >= TEMPLATE_PAGES).join(whole, "host").where(F.col("n") >= TEMPLATE_SHARE * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("slot").alias("open"))


def wrapper_pages(pages: DataFrame) -> DataFrame:
    """(host, wrapper): pages of each host that have every frequent slot of it.

    The first are short ones of least digest. While a host has frequent slots that none of its wrapper pages has, the page with most of them is added,
    the shortest of those. A frequent slot is on 0.8 of the pages, so one of them has 0.8 of the open slots: few rounds are needed, and seldom any.
    """
    order = Window.partitionBy("host").orderBy("digest")
    first = pages.where(F.size("at") <= REFERENCE_BLOCKS).withColumn("n", F.row_number().over(order)).where(F.col("n") <= REFERENCES)
    tree_columns = ["labels", "parents", "at", "digests"]
    chosen = added = checkpointed(first.select("host", "n", *tree_columns, "slots"))
    open, last = frequent_slots(pages), REFERENCES
    while True:
        shown = added.groupBy("host").agg(F.flatten(F.collect_list("slots")).alias("shown"))
        left = open.join(shown, "host", "left").select("host", F.array_except("open", F.coalesce("shown", F.array().cast("array<long>"))).alias("open"))
        open = checkpointed(left.where(F.size("open") > 0))
        if open.isEmpty():
            break
        gain = F.size(F.array_intersect("slots", "open"))
        best = pages.join(open, "host").groupBy("host").agg(F.max(F.struct(gain, -F.size("at"), "digest")).alias("best"))
        last += 1
        added = checkpointed(pages.join(best.select("host", F.col("best.digest").alias("digest")), ["host", "digest"]).select(
            "host", F.lit(last).alias("n"), *tree_columns, "slots"))
        chosen = chosen.unionByName(added)
    return chosen.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("n", *tree_columns))).alias("wrapper"))


def wrappers(read: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper pages, with their template blocks, of each host that has any.

    Counted over all different pages of a host; copies tell nothing about a template. A block of a wrapper page is template if at least three
    pages and 0.8 of all show the same text at it; every text that so many pages show at one way of labels is there on a wrapper page. Where the template would hold more text than
    the rest, most pages are near copies of the wrapper page and it has none.
    """
    lengths = F.transform("texts", lambda t: F.char_length(t)).alias("lengths")
    pages = checkpointed(read.select("host", "labels", "parents", "at", "digests", "slots", lengths, "chars", "digest").where(
        F.size("at") > 0).dropDuplicates(["host", "digest"]))
    chosen = checkpointed(wrapper_pages(pages))
    asked = pages.drop("digest", "slots").join(chosen, "host").select("host", "labels", "parents", "at", "digests", "lengths", "chars", "wrapper")
    told = asked.mapInArrow(_told, "host string, reference int, block int, same long, chars long")
    counts = told.groupBy("host", "reference", "block").agg(*[F.sum(c).alias(c) for c in ("same", "chars")])
    whole, block = F.col("block") < 0, F.struct("block", "same", "chars")
    constant = ~whole & (F.col("same") >= TEMPLATE_PAGES)
    groups = counts.groupBy("host", "reference").agg(
        F.sum(F.when(whole, F.col("same"))).alias("pages"), F.sum(F.when(whole, F.col("chars"))).alias("chars"),
        F.collect_list(F.when(constant, block)).alias("blocks"))
    groups = groups.withColumn("blocks", F.filter("blocks", lambda b: b["same"] >= TEMPLATE_SHARE * F.col("pages")))
    shown = F.aggregate("blocks", F.lit(0).cast("long"), lambda s, b: s + b["chars"])
    good = groups.where((F.size("blocks") > 0) & (2 * shown <= F.col("chars"))).groupBy("host").agg(
        F.map_from_entries(F.collect_list(F.struct("reference", F.transform("blocks", lambda b: b["block"]).alias("b")))).alias("template"))
    template = lambda w, i: w.withField("template", F.coalesce(F.col("template")[i], F.array().cast("array<int>")))
    return chosen.join(good, "host").select("host", F.transform("wrapper", template).alias("wrapper"))


def templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper) of the hosts of pages whose wrapper has template blocks, see ``wrappers``."""
    small_batches(pages.sparkSession)
    return wrappers(checkpointed(read_pages(pages, url, html, [])))


def _texts(kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict = {}
        for batch in batches:
            texts = []
            rest = [c.to_pylist() for c in batch.columns[kept:-1]]
            for (host, labels, parents, at, digests, own), wrapper in zip(zip(*rest), batch.column(batch.num_columns - 1)):
                gone: set[int] = set()
                if wrapper.is_valid and own:
                    for shown in _shown(_trees(hosts, host, wrapper), labels, parents, at, digests):
                        gone.update(b for _, b in shown)
                texts.append("\n\n".join([t for i, t in enumerate(own) if i not in gone]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[f"k{i}" for i in range(kept)] + ["text", "n_chars"])

    return run


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` of every page with its main ``text`` and ``n_chars``.

    Character references are decoded, white space inside a block is one blank, blocks are joined
    in page order by two line breaks. Null and empty pages have an empty text; pages with a null url
    share one host; broken markup is read as far as it goes. Repeated pages stay
    repeated, no pages give none; columns outside ``keep`` are left aside, a kept one named like a result gives way.
    Very long and deep pages are aligned like others: the time of two lists of siblings grows with the product of their lengths, the memory with
    the longer one and the root of the shorter.
    """
    small_batches(pages.sparkSession)
    keep = [c for c in keep if c not in ("text", "n_chars")]
    names = [f"k{i}" for i in range(len(keep))]
    read = checkpointed(read_pages(pages, url, html, keep))  # read twice
    known = checkpointed(wrappers(read))  # its size decides how it is joined
    joined = read.join(known, "host", "left").select(*names, "host", "labels", "parents", "at", "digests", "texts", "wrapper")
    types = [f"{k} {pages.schema[c].dataType.simpleString()}" for c, k in zip(keep, names)]
    done = joined.mapInArrow(_texts(len(keep)), ", ".join([*types, "text string, n_chars long"]))
    return done.select(*[F.col(k).alias(c) for c, k in zip(keep, names)], "text", "n_chars")
