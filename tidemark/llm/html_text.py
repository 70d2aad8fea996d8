"""Main text of web pages by tag-path ratios.

Each text node belongs to the path of open block elements from the root to it. Per page and path,
text length and punctuation are summed and divided by the number of nodes; the two ratios are
smoothed over the nodes in page order (three-node triangular kernel, so a short paragraph between
long ones counts with them) and fused by their product, times the share of text outside links and
times a prior: 0 inside elements that by their tag are menus, headers, footers, sidebars or forms or
by their name are comments or lists of other articles, 0.005 inside elements that by their class or
id words may be notices, adverts and the like (a wrapper around everything may be called so; an
article or main element inside is free of it), else 1. Paths whose fused ratio reaches ``THRESHOLD``
times the page's mean, weighted by text, are content; nothing else starts a text. Blocks of doubtful elements on such paths
count only where plain blocks hold less than half of the content.

The content node is the article (or else main) element that holds at least ``STATED_SHARE`` of the
text on content paths, as the page itself states where its article ends; all its blocks outside
marked elements are kept. Without one it is the smallest container that holds all blocks on content
paths; these are kept, and headings, cells, list items and the like that are not mostly links and stand in a container of
one of them, at any depth, or in one of the same path beside it (so a short last section stays). A header element
is left out with all that it holds, a heading in the article's own header too.

Inside a block white space is one space, ``br`` included; blocks are joined by one newline.
Character references are decoded as HTML does, also unfinished ones that HTML accepts.

Defined cases: null or empty html gives an empty text; unclosed elements, comments and tags run to
the page's end; a page without tags is one block; repeated rows are treated alike; extra columns
pass through, ``text`` and ``n_chars`` are replaced; names that begin with ``_tm_`` are reserved;
empty table: empty result. Time is linear in the page, whatever its nesting; memory: one Arrow batch.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernels as K

TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)""", re.DOTALL)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")

# HTML element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object canvas xmp noembed noframes title".split())
ZERO_TAGS = frozenset("head nav header footer aside form button select option menu dialog label fieldset".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre section select summary table tbody td tfoot th thead tr ul button".split())
CONTAINER = frozenset("html body div section article main table tbody tr td center".split())
LISTS = frozenset("ul ol dl blockquote nav header footer aside form figure".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDED = frozenset("p h li dt dd tr td th option".split())
HEADING = re.compile("h[1-6]")
BESIDE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption td th summary b strong i em span a code small sub sup u".split())
# Words of class, id and role attributes that mark what is not article text.
ZERO_WORDS = frozenset("ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promotion banner sidebar side menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar masthead header footer foot copyright cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login search share sharing social widget pagination pager skip contentinfo complementary".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Words for lists of other articles and for comments: an article element inside is not the page's article.
OTHERS = COMMENT_WORDS | frozenset("related recommended recommendations".split())
STATED = re.compile(r"\b(?:has|no|with|without|is|not)-[a-z0-9]+")
#: Content paths reach this share of the page's mean of the fused ratio.
THRESHOLD = 0.5
#: Share of the content paths' text that an article or main element must hold to be the content node.
STATED_SHARE = 0.9
#: What the fused ratio of a block is multiplied by: plain, in an element of a doubtful name, in one that is outside the article for certain.
PRIOR = (1.0, 0.005, 0.0)


class Page:
    """The elements of a page in order of their start, as parallel lists, and its blocks of text."""

    def __init__(self) -> None:
        self.tag, self.up, self.mark, self.path, self.depth = [""], [-1], [0], [0], [0]
        self.paths: dict[tuple[int, str], int] = {}
        #: Per element, the outermost open element of each kind that a new block can end, within the nearest container.
        self.ends: list[dict[str, int]] = [{}]
        #: (element, raw pieces of text, characters inside links)
        self.blocks: list[tuple[int, list[str], int]] = []

    def add(self, tag: str, up: int, mark: int) -> int:
        i = len(self.tag)
        self.tag.append(tag)
        self.up.append(up)
        self.mark.append(mark)
        self.depth.append(self.depth[up] + 1)
        own = self.path[up]
        self.path.append(self.paths.setdefault((own, tag), len(self.paths) + 1) if tag in BLOCK else own)
        kind = "h" if HEADING.fullmatch(tag) else tag
        if tag in CONTAINER or tag in LISTS:
            self.ends.append({tag: i} if kind in ENDED else {})
        elif kind in ENDED and kind not in self.ends[up]:
            self.ends.append(self.ends[up] | {kind: i})
        else:
            self.ends.append(self.ends[up])
        return i


def _mark(tag: str, attributes: str) -> int:
    """2: outside the article for certain; 1: by its name only, as a wrapper around everything may be called; 0: not."""
    if tag in ZERO_TAGS:
        return 2
    if not attributes or tag in ("html", "body", "main"):
        return 0
    names = [STATED.sub("", (m[1] or m[2] or m[3] or "").lower()) for m in NAMED.finditer(attributes)]
    if tag == "article":
        return 2 * any(w in COMMENT_WORDS or w == "comment-body" for n in names for w in n.split())
    words = {w for n in names for w in WORD.findall(n)}
    return 2 if words & OTHERS else int(bool(words & ZERO_WORDS))


def parse(html: str) -> Page:
    """One pass over the tags; every element is opened and closed once, however deep they nest."""
    page = Page()
    at, home, text, blank, linked = 0, 0, [], True, 0
    opened: dict[str, int] = {}
    pos, end = 0, len(html)

    def close() -> None:
        nonlocal text, blank, linked
        if not blank:
            page.blocks.append((home, text, linked))
        text, blank, linked = [], True, 0

    def put(raw: str) -> None:
        nonlocal home, blank, linked
        if raw:
            if not raw.isspace():
                if blank:
                    home, blank = at, False
                linked += len(raw) * bool(opened.get("a"))
            text.append(raw)

    def leave(upto: int) -> None:
        """Closes all open elements down to and with upto."""
        nonlocal at
        while True:
            own, at = at, page.up[at]
            opened[page.tag[own]] -= 1
            if own == upto:
                return

    while pos < end:
        m = TOKEN.search(html, pos)
        if m is None:
            put(html[pos:])
            break
        put(html[pos : m.start()])
        pos = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "br":
            put(" ")
            continue
        if tag in RAW and not closing:
            if not attributes.endswith("/") or tag not in ("svg", "math"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|$)", re.IGNORECASE).search(html, pos)
                pos = stop.end() if stop else end
            continue
        if tag in BLOCK:
            close()
        if closing:
            if opened.get(tag):
                x = at
                while page.tag[x] != tag:
                    x = page.up[x]
                leave(x)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:  # a paragraph ends where any block begins; headings, list and table parts end at their like
            kinds = ("p", "h") if HEADING.fullmatch(tag) else ("p", *CLOSED_BY.get(tag, ()))
            cut = min((x for k in kinds if (x := page.ends[at].get(k)) is not None), default=None)
            if cut is not None:
                leave(cut)
        outer = 0 if page.mark[at] == 1 and tag in ("article", "main") else page.mark[at]
        at = page.add(tag, at, max(outer, _mark(tag, attributes)))
        opened[tag] = opened.get(tag, 0) + 1
    close()
    return page


def _smooth(v: list[float]) -> list[float]:
    return [(a + 2 * b + c) / 4 for a, b, c in zip([v[0], *v], v, [*v[1:], v[-1]])]


def content_paths(page: Page, blocks: list[tuple[int, str, float]], threshold: float) -> set[int]:
    """Paths whose fused ratio reaches threshold times the page's mean; blocks: element, text, share outside links."""
    length: dict[int, float] = {}
    points: dict[int, float] = {}
    nodes: dict[int, int] = {}
    for x, s, _ in blocks:
        p = page.path[x]
        length[p] = length.get(p, 0.0) + len(s)
        points[p] = points.get(p, 0.0) + sum(map(s.count, ".,;:!?"))
        nodes[p] = nodes.get(p, 0) + 1
    own = [page.path[x] for x, _, _ in blocks]
    lengths, marks = (_smooth([t[p] / nodes[p] for p in own]) for t in (length, points))
    weight = [PRIOR[page.mark[x]] * free for x, _, free in blocks]
    ratio = [a * (1 + b) * w for a, b, w in zip(lengths, marks, weight)]
    mass = [len(s) * w for (_, s, _), w in zip(blocks, weight)]
    mean = sum(r * m for r, m in zip(ratio, mass)) / (sum(mass) or 1.0)
    total: dict[int, float] = {}
    for r, p in zip(ratio, own):
        total[p] = total.get(p, 0.0) + r
    return {p for p, r in total.items() if r / nodes[p] >= threshold * mean and (mean or not threshold)}


def main_text(html: str | None, threshold: float = THRESHOLD) -> str:
    if not html:
        return ""
    page = parse(html)
    blocks = []
    for x, raw, linked in page.blocks:
        own = "".join(raw)
        if s := SPACE.sub(" ", entities.unescape(own)).strip():
            blocks.append((x, s, 1 - min(1.0, linked / max(len(own.strip()), 1))))
    content = content_paths(page, blocks, threshold) if blocks else set()
    chosen = [page.path[x] in content and (PRIOR[page.mark[x]] > 0 or not threshold) for x, _, _ in blocks]
    if not any(chosen):
        return ""
    # a doubtful name is believed where plain blocks hold most of the content: a sidebar's paragraphs may share the article's path
    sizes = [len(s) * c for (_, s, _), c in zip(blocks, chosen)]
    if threshold and 2 * sum(n for (x, _, _), n in zip(blocks, sizes) if page.mark[x] == 0) >= sum(sizes):
        chosen = [c and page.mark[x] == 0 for (x, _, _), c in zip(blocks, chosen)]
    held = [0] * len(page.tag)
    near = list(range(len(page.tag)))  # the nearest container of each element
    for x in range(1, len(near)):
        if page.tag[x] not in CONTAINER:
            near[x] = near[page.up[x]]
    homes = set()
    for (x, s, _), c in zip(blocks, chosen):
        if c:
            held[x] += len(s)
            homes.add(near[x])
    total = sum(held)
    for x in range(len(held) - 1, 0, -1):
        held[page.up[x]] += held[x]
    root, stated = _content_node(page, held, total)
    inside = [False] * len(held)
    inside[root] = True
    for x in range(root + 1, len(inside)):
        inside[x] = inside[page.up[x]]

    # containers of content, whatever lies in them, and containers of the same path beside them
    parents, paths = {near[page.up[x]] for x in homes if x}, {page.path[x] for x in homes}
    with_content = [False] * len(near)
    for x in range(root, len(near)):
        alike = page.tag[x] in CONTAINER and page.path[x] in paths and near[page.up[x]] in parents
        with_content[x] = x in homes or inside[x] and (x != root and with_content[page.up[x]] or alike)

    def kept(x: int, free: float, c: bool) -> bool:
        """On a content path; or unmarked, and part of the stated article or a heading, cell, list or the like beside content."""
        return c or page.mark[x] == 0 and (stated or free > 0.5 and page.tag[x] in BESIDE and with_content[near[x]])

    return "\n".join(s for (x, s, free), c in zip(blocks, chosen) if inside[x] and kept(x, free, c))


def _content_node(page: Page, held: list[int], total: int) -> tuple[int, bool]:
    """The outermost article (or else the innermost main) with STATED_SHARE of the content; without one the innermost container with all of it."""
    whole = max((x for x in range(len(held)) if held[x] >= total and (x == 0 or page.tag[x] in CONTAINER)), key=page.depth.__getitem__)
    large = [x for x in range(len(held)) if held[x] >= STATED_SHARE * total]
    articles = [x for x in large if page.tag[x] == "article"]
    if articles:
        return min(articles, key=page.depth.__getitem__), True
    mains = [x for x in large if page.tag[x] == "main"]
    return (max(mains, key=page.depth.__getitem__), True) if mains else (whole, False)


def extract(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """pages without html, with ``text`` and ``n_chars`` (its code points)."""
    out = pages.drop("text", "n_chars").withColumn("_tm_html", F.col(html).cast("string")) if html != "text" else pages.drop("n_chars").withColumnRenamed("text", "_tm_html")
    out = out.drop(html)
    schema = T.StructType([*(f for f in out.schema.fields if f.name != "_tm_html"), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in K.column(batch, "_tm_html").to_pylist()]
            arrays = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "_tm_html"}
            arrays |= {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return out.transform(K.mapped, run, schema)


def digest(pages: DataFrame) -> DataFrame:
    """The columns of query op10."""
    return extract(pages.select("page_id", "url", "html"))
