"""Main text of HTML pages by minimum-cut labelling (operator 2).

A page becomes a list of text blocks with features of their place in the DOM. A linear classifier turns
features into the costs of calling a block boilerplate or content: terminal capacities. Blocks next
to each other, and blocks of one parent, are joined by smoothness edges that weaken with their distance in
the DOM. The minimum cut between the terminals, found as a maximum flow, labels all blocks at once.

Pages are rows that never meet, so nothing shuffles; a page costs time about linear in its length.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from prefspark.llm.bpe import slices
from prefspark.llm.common import map_batches

# Fixed values of HTML: elements that start a block, that have no content, and whose content is not markup.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Start tags that end an open element of the listed names (the optional end tags of HTML).
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tr", "tbody", "thead", "tfoot"), "thead": ("tr", "tbody", "thead", "tfoot"), "tfoot": ("tr", "tbody", "thead", "tfoot"),
    "option": ("option",), "optgroup": ("option", "optgroup"),
}
#: Elements whose content does not close what is open outside of them.
SCOPE = frozenset("table td th caption button object template html ul ol dl select article section div aside nav".split())

# The classifier: words in class, id and role, and elements, that speak for boilerplate or content.
BAD_TAGS = frozenset("nav footer aside form menu dialog button select option datalist noscript template svg math canvas object audio video map search".split())
BAD_WORDS = frozenset(
    "ad ads adbox adslot adunit advert advertisement adverts advertising banner sponsor sponsored promo promos promotion promoted sidebar sidebars "
    "sidenav menu menus nav navbar navigation navigate breadcrumb breadcrumbs footer footers foot bottombar cookie cookies consent gdpr notice notices notification "
    "notifications disclaimer popup modal overlay newsletter subscribe subscription signup login signin share sharing sharebar "
    "recommended recommendations widget widgets copyright toolbar pagination pager "
    "skip searchbox contentinfo complementary alertdialog teaser teasers".split()
)
#: What readers write; an article element inside is one of their comments.
TALK_WORDS = frozenset("comment comments commentlist commenter reply replies respond disqus responses readers reader thread threads discussion".split())
#: Words that may as well name what a text is about: they lower a block's score only a little.
WEAK_WORDS = frozenset("legal social related search form alert trending popular".split())
#: Words that say nothing of their own in a compound such as ``ad-box`` or ``site_footer``.
PLAIN_WORDS = frozenset(
    "area bar block bottom box button buttons center col column container content fixed group header inline inner item items js large left link links list main mobile "
    "module new outer page panel post primary right row secondary section site small sticky text title top ui unit widget wrap wrapper".split()
)
HEAD_WORDS = frozenset("header masthead topbar banner".split())
#: Elements whose class, id and role say what a page has or is about, not that their content is boilerplate.
FRAMES = frozenset("html body main article".split())
GOOD_WORDS = frozenset("article articlebody articletext entry post story content maincontent main body".split())
WEIGHT = {"good": 6.0, "bad": -14.0, "weak": -4.0, "head": -2.0, "outside": -9.0, "links": -5.0, "bare": -1.5, "word": 0.6, "words_most": 3.0, "stop": 1.0}
SMOOTH, SIBLING = 2.0, 0.5

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
STOP = re.compile("""["'>]""")
COMMENT_END = re.compile("--!?>")
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
TOKEN = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Element:
    """An open element; the flags hold if it or an element around it has them. block: the block it stands in.

    hard: bad by its element or because it is hidden. A class, id or role that is only a word's guess ends at a
    nearer article or main, which is judged anew, but readers' comments stay comments.
    """

    name: str
    number: int
    depth: int
    good: bool
    bad: bool
    head: bool
    link: bool
    hard: bool = False
    weak: bool = False
    block: Element | None = None
    texts: int = 0  # an article's own blocks of several words


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    good: bool
    bad: bool
    head: bool
    depth: int
    parent: int
    near: int
    weak: bool = False


def _named(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names in ``value`` consists of ``words`` and plain words: ``ad-box`` does, ``form-of-government`` does not."""
    for name in value.split():
        parts = set(TOKEN.findall(name))
        if parts & words and parts <= words | PLAIN_WORDS:
            return True
    return False


def _judge(name: str, attributes: str) -> tuple[bool, bool, bool, bool, bool]:
    """Whether an element's name and attributes speak for content, for boilerplate, for a page header; whether it is surely
    not shown as the page's text; whether they speak against it a little."""
    good, bad, head, weak = name in ("article", "main"), name in BAD_TAGS, name == "header", False
    hard = bad
    if attributes:
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "").lower()
            if key in ("class", "id", "role", "itemprop"):
                words = set(TOKEN.findall(value))
                if name not in FRAMES:
                    talk = _named(value, TALK_WORDS)
                    hard = hard or talk
                    bad = bad or talk or _named(value, BAD_WORDS)
                    weak = weak or _named(value, WEAK_WORDS)
                head = head or (bool(words & HEAD_WORDS) and name not in FRAMES)
                good = good or (bool(words & GOOD_WORDS) and name != "body")
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                bad = hard = True
    return good, bad, head, hard, weak


class PageReader:
    """Blocks of one page, read tag by tag with a stack of open elements."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack = [Element("", 0, 1, False, False, False, False)]
        self.stack[0].block = self.stack[0]
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.low = 0  # least depth since the last block
        self.made = 0
        self.articles: list[Element] = []

    def read(self, html: str) -> list[Block]:
        at, end = 0, len(html)
        self.html, self.dead, self.empty_from = html, set(), end + 1
        self.last = {c: html.rfind(c) for c in "\"'>"}
        while at < end:
            start = html.find("<", at)
            if start < 0:
                self.text(html[at:])
                break
            if html.startswith("<!--", start):
                self.text(html[at:start])
                m = COMMENT_END.search(html, start + 4)
                at = m.end() if m else end
                continue
            m = NAME.match(html, start + 1)
            stop = self.tag_end(m.end()) if m else html.find(">", start) if start < self.last[">"] and html[start + 1] in "!?/" else -1
            if stop < 0:  # no tag after all
                self.text(html[at : start + 1])
                at = start + 1
                continue
            if start > at:
                self.text(html[at:start])
            at = stop + 1
            if not m:
                continue
            name = m[2].lower()
            if m[1]:
                self.end_tag(name)
                continue
            self.start_tag(name, html[m.end() : stop])
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else end
        self.flush()
        return self.blocks

    def tag_end(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``: at the first ``>`` outside of quotes, or if quotes do not close, at the
        first one; -1 if there is none.

        Nothing is read twice for long: an opening quote from which no end was found is remembered, so a
        later tag that comes to it gives up at once, and so is the place after which neither quotes nor ends follow.
        """
        html, first, tried = self.html, at, []
        while at < self.empty_from:
            m = STOP.search(html, at)
            if m is None:
                self.empty_from = at
                break
            mark = m.start()
            if html[mark] == ">":
                return mark
            if mark in self.dead:
                break
            tried.append(mark)
            if mark >= self.last[html[mark]]:
                break
            at = html.find(html[mark], mark + 1) + 1
        self.dead.update(tried)
        return html.find(">", first) if first <= self.last[">"] else -1

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if top.name in RAW or (top.bad and not top.block.bad):  # code, or an advert, button and the like inside a line
            return
        text = unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if top.link:
            self.linked += len("".join(text.split()))

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                top = self.stack[-1].block
                depth = top.depth
                self.low = min(self.low, depth)
                distance = 0 if not self.blocks else depth + self.blocks[-1].depth - 2 * self.low
                self.blocks.append(Block(text, self.linked, top.good, top.bad, top.head, depth, top.number, distance, top.weak))
                if self.articles and not top.bad and text.count(" ") >= 4:
                    self.articles[-1].texts += 1
                self.low = depth
        self.linked = 0

    def pop(self) -> None:
        gone = self.stack.pop()
        if self.articles and self.articles[-1] is gone:
            self.articles.pop()
        self.open[gone.name] -= 1
        self.low = min(self.low, len(self.stack))

    def close(self, names: tuple[str, ...], scope: frozenset[str]) -> None:
        """Close the innermost open element of these names, and all inside it, if it is in scope."""
        if not any(self.open.get(n) for n in names):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            name = self.stack[at].name
            if name in names:
                while len(self.stack) > at:
                    self.pop()
                return
            if name in scope:
                return

    def start_tag(self, name: str, attributes: str) -> None:
        if name in ("br", "td", "th", "img"):
            self.parts.append(" ")
        if name in BLOCK:
            self.flush()
            if name not in ("li", "option", "optgroup", "tr", "tbody", "thead", "tfoot", "body", "html", "head"):
                self.close(("p",), SCOPE)
        if name in ENDS:
            self.close(ENDS[name], SCOPE - frozenset(ENDS[name]) - (frozenset(("td", "th")) if name in ("tr", "tbody", "thead", "tfoot") else frozenset()))
        if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
            return
        top = self.stack[-1]
        good, bad, head, hard, weak = _judge(name, attributes)
        # an article inside an article that has text of its own is a comment on it
        hard = top.hard or hard or name in RAW or name == "head" or (name == "article" and bool(self.articles) and self.articles[-1].texts > 0)
        anew = name in ("article", "main")
        self.made += 1
        new = Element(name, self.made, len(self.stack) + 1, top.good or good, hard or bad or (top.bad and not anew), head or (top.head and not anew),
                      top.link or name == "a", hard, weak or (top.weak and not anew))
        new.block = new if name in BLOCK else top.block
        if name == "article":
            self.articles.append(new)
        self.stack.append(new)
        self.open[name] = self.open.get(name, 0) + 1

    def end_tag(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        if name in ("td", "th"):
            self.parts.append(" ")
        # an inline end tag closes nothing beyond the block it stands in
        self.close((name,), frozenset() if name in BLOCK or name in RAW else BLOCK)


def costs(blocks: list[Block]) -> list[float]:
    """Log-odds of content for each block: the difference of its two terminal capacities."""
    framed = any(b.good and not b.bad for b in blocks)
    out = []
    for b in blocks:
        words = b.text.count(" ") + 1
        score = WEIGHT["bare"] + min(WEIGHT["words_most"], WEIGHT["word"] * words.bit_length())
        if b.text[-1] in ".!?\"'”»…":
            score += WEIGHT["stop"]
        score += WEIGHT["links"] * min(1.0, b.linked / max(1, len(b.text) - words + 1))
        if b.good:
            score += WEIGHT["good"]
        elif framed:
            score += WEIGHT["outside"]
        if b.head:
            score += WEIGHT["head"] if b.good else WEIGHT["bad"]
        if b.bad:
            score += WEIGHT["bad"]
        elif b.weak:
            score += WEIGHT["weak"]
        out.append(score)
    return out


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order, and between successive blocks of one parent."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, SMOOTH / (1 + b.near)))
        if last.get(b.parent, i - 1) < i - 1:
            edges.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    return edges


def minimum_cut(net: list[float], edges: list[tuple[int, int, float]], scale: int = 1000) -> list[bool]:
    """Labels (True: source side) of a minimum cut: net[i] is node i's source less its sink capacity.

    A node whose net capacity is at least that of its edges lies on that side in some minimum cut; it is
    settled at once and its edges become terminal capacity of its neighbours. The rest, if any, is
    solved by augmenting along shortest paths, level by level. Capacities are scaled to integers.
    """
    n = len(net)
    left = [round(x * scale) for x in net]
    around: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in edges:
        c = round(c * scale)
        around[a][b] = around[a].get(b, 0) + c
        around[b][a] = around[b].get(a, 0) + c
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(left[i]) < sum(around[i].values()):
            continue
        label[i] = left[i] > 0
        for j, c in around[i].items():
            left[j] += c if label[i] else -c
            del around[j][i]
            queue.append(j)
        around[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _max_flow(rest, left, around), strict=True):
            label[i] = side
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], net: list[int], around: list[dict[int, int]]) -> list[bool]:
    """Source side of a minimum cut among ``nodes``, by blocking flows on level graphs."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {source: {}, sink: {}}
    for i in nodes:
        room[i] = dict(around[i])
        if net[i] > 0:
            room[source][i], room[i][source] = net[i], 0
        elif net[i] < 0:
            room[i][sink], room[sink][i] = -net[i], 0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, c in room[u].items():
                if c and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return [i in level for i in nodes]
        ahead = {u: iter(list(room[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                amount = min(room[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    room[a][b] -= amount
                    room[b][a] = room[b].get(a, 0) + amount
                full = next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if not room[a][b])
                path = path[: full + 1]
                continue
            for v in ahead[u]:
                if room[u][v] and level.get(v, -1) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()
                level[u] = -1


def main_text(html: str | None) -> str:
    """The content blocks of a page joined by blank lines; empty if there are none or html is null."""
    if not html:
        return ""
    blocks = PageReader().read(html)
    keep = minimum_cut(costs(blocks), smoothness(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Add ``text_col``: the main text of the whole page. Every row stays; null html gives an empty text.

    White space in a block becomes single spaces, blocks are joined by two line ends. An existing column of
    that name is replaced. Repeated rows have equal texts, an empty table stays empty, pages of any length are read whole.
    """
    kept = [c for c in pages.columns if c != text_col]
    source = pages.select(*kept)
    schema = StructType([*source.schema.fields, StructField(text_col, StringType(), False)])
    at = kept.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                texts = [main_text(page) for page in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*kept, text_col])

    return map_batches(source, run, schema)
