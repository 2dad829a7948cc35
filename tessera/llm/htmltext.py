"""Main text of web pages by tree scoring.

A page becomes a small tree of containers and text blocks. Each block passes
points for its length and its commas, discounted by its share of link text,
in full to its container and in halves further up. The container with most
points leads to the article: the nearest article or main element around it,
kept whole with the title and blocks beside it in main; without one, parents
are climbed as long as they add text that isn't links. An element whose name marks it as furniture is left out unless
it holds nearly all of the page's text. Parsing one page is a per-row helper; Spark spreads the pages.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import by_text_size, map_batches

# Element names of HTML and words that name page furniture in class, id and role.
SKIPPED = frozenset("script style noscript template nav header footer aside button select textarea iframe svg object "
                    "title dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset("p li pre blockquote dt dd td th figcaption caption summary address".split())
CONTAINERS = frozenset("html body div section article main ul ol dl table tbody thead tfoot tr figure details center "
                       "fieldset hgroup form".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub "
                   "sup time tt u var".split())
_BREAKS = CONTAINERS | BLOCKS | (SKIPPED - {"script", "style", "button", "select", "textarea", "svg", "object"})
_CELLS = frozenset("td th caption table".split())
_TABLE_PARTS = frozenset("tbody thead tfoot tr td th caption".split())
#: Start tags that end an element without its end tag: what they end, and where the search for it stops.
ENDS = {"li": (frozenset(["li"]), _CELLS | frozenset("ul ol menu article section".split())),
        "dt": (frozenset(["dt", "dd"]), _CELLS | {"dl"}), "dd": (frozenset(["dt", "dd"]), _CELLS | {"dl"}),
        "td": (frozenset(["td", "th", "caption"]), frozenset(["tr", "table"])),
        "th": (frozenset(["td", "th", "caption"]), frozenset(["tr", "table"])),
        "tr": (frozenset(["tr", "caption"]), frozenset(["table"])),
        **{t: (frozenset("tbody thead tfoot caption".split()), frozenset(["table"])) for t in ("tbody", "thead", "tfoot")},
        **{t: (HEADINGS, _BREAKS - HEADINGS) for t in HEADINGS}, "a": (frozenset(["a"]), _BREAKS)}

_FURNITURE = (r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|alert|popup|modal|"
              r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|widget|related|share|"
              r"social|comments?|replies|disqus|newsletter|subscribe|login|pagination|pager)")
FURNITURE = re.compile(rf"{_FURNITURE}(?:s|list|box|bar|wrap|wrapper|area|section|form|posts?|links?|items?|block|container|content|"
                       rf"banner|notice|body|thread|count|buttons?|icons?|unit|slot|sense|panel|menu)?|"
                       r"(?:site|main|top|page|side|sub|bottom|global|left|right)(?:nav|menu|footer|header|banner|ads?)")
#: Names of a state or of a topic, not of furniture: has-sidebar, comments-open, header-fixed, category-promo.
STATES = frozenset("no not has have with without is hide hidden show open closed enabled disabled fixed sticky".split())
TOPICS = frozenset("category tag type status format topic".split())
#: Names of reader comments everywhere but on the sections of an article, which may have a discussion of their own.
DISCUSSION = re.compile(r"discussions?(?:list|box|wrap|wrapper|area|section|thread|container|content)?")
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
SENTENCE_ENDS = frozenset(".!?…。！？\"”»")
TITLED = frozenset("entry article post story content section".split())
#: Furniture by name is the page itself if it holds this many times the text outside furniture (with and without prose there).
WRAPPER, WRAPPER_OF_PROSE = 4, 50

BASE_POINTS, CHARS_PER_POINT, SIBLING_SHARE, PROSE_CHARS, PROSE_LINKS = 1.0, 100.0, 0.2, 80, 0.25
#: Points of a container named as the article, if it holds all text of the page; else in proportion.
NAMED_ARTICLE = {"article": 25.0, "main": 15.0}


@lru_cache(20_000)
def _names_furniture(value: str, pattern: re.Pattern = FURNITURE) -> bool:
    """Whether a word of a class, id or role names furniture; words are cut at punctuation and at capitals (cookieBanner)."""
    for token in value.split():
        parts = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", token)]
        if not parts or parts[0] in TOPICS or not STATES.isdisjoint(parts) or "header" in parts and not TITLED.isdisjoint(parts):
            continue
        if any(map(pattern.fullmatch, parts)):
            return True
    return False


class _Node:
    """A container, or an element marked as furniture by its name. A form is marked too, until it proves to be the page."""

    __slots__ = ("tag", "parent", "children", "points", "order", "marked", "named", "own", "chars", "prose", "prose_inside")

    def __init__(self, tag: str, parent: "_Node | None", order: int, marked: bool = False) -> None:
        self.tag, self.parent, self.order, self.named, self.marked = tag, parent, order, marked, marked or tag == "form"
        self.points, self.own, self.chars, self.prose, self.prose_inside, self.children = 0.0, 0, 0, False, False, []
        if parent is not None:
            parent.children.append(self)


class _Tree(HTMLParser):
    """Blocks ``(node, tag, text, link characters)`` in page order, outside skipped elements.

    The stack holds every open element; an end tag, and a start tag by
    ``ENDS``, closes what is open inside the element it ends.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("html", None, 0)
        self.nodes, self.blocks = [self.root], []
        self.text: list[str] = []
        self.link_chars, self.block_tag, self.skipping = 0, "", 0
        self.stack: list[tuple[str, _Node, str, int]] = []  # tag; node, block and skipped elements from there on
        self.open: Counter[str] = Counter()

    def flush(self) -> None:
        words = " ".join("".join(self.text).split())
        if words:
            self.blocks.append((self.at, self.block_tag, words, self.link_chars))
        self.text, self.link_chars = [], 0

    def cut(self, depth: int) -> None:
        """Close all elements from this place of the stack on."""
        if any(tag in _BREAKS or node.tag == tag and node is not self.root for tag, node, _, _ in self.stack[depth:]):
            self.flush()
        for tag, *_ in self.stack[depth:]:
            self.open[tag] -= 1
        del self.stack[depth:]
        self.at, self.block_tag, self.skipping = self.stack[-1][1:] if self.stack else (self.root, "", 0)

    def end(self, tags: frozenset[str], stop: frozenset[str]) -> None:
        if any(self.open[t] for t in tags):
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in tags:
                    return self.cut(k)
                if self.stack[k][0] in stop:
                    return None
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "head", "body"):
            if tag == "body":
                self.cut(0)
            return
        if tag in _BREAKS or tag == "hr":
            self.end(frozenset(["p"]), _CELLS)
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br" and not self.skipping:
                self.text.append("\n")
            return
        if tag in ENDS:
            self.end(*ENDS[tag])
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        furniture = bool(named) and tag != "main" and (_names_furniture(named) or not (
            tag == "section" and self.open["article"]) and _names_furniture(named, DISCUSSION))
        # the header of an article or of the main part holds its title
        skipped = (tag in SKIPPED and not (tag == "header" and (self.open["article"] or self.open["main"]))
                   or any(k == "hidden" or k == "style" and v and HIDDEN.search(v) for k, v in attrs)
                   or tag == "label" and self.open["form"] or furniture and tag in INLINE)
        node, block, marked = self.at, self.block_tag, furniture and not skipped
        if tag in _BREAKS or marked:
            self.flush()
        if not (skipped or self.skipping):
            if tag in CONTAINERS or marked:
                node = _Node(tag, self.at, len(self.nodes), marked)
                self.nodes.append(node)
            if tag in BLOCKS or tag in CONTAINERS:
                block = tag if tag in BLOCKS else ""
        self.stack.append((tag, node, block, self.skipping + skipped))
        self.open[tag] += 1
        self.at, self.block_tag, self.skipping = node, block, self.skipping + skipped

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not self.open["p"]:
            self.flush()
        elif tag in _TABLE_PARTS:
            self.end(frozenset([tag]), frozenset(["table"]))
        elif tag == "table":
            self.end(frozenset([tag]), frozenset())
        elif tag in ("li", "a") or tag in HEADINGS:
            self.end(*ENDS[tag])
        elif tag not in ("html", "head", "body"):
            self.end(frozenset([tag]), _CELLS if tag in _BREAKS or tag not in INLINE else _BREAKS)

    def handle_data(self, data: str) -> None:
        if not self.skipping:
            self.text.append(data)
            if self.open["a"]:
                self.link_chars += len(data.strip())


def _weigh_furniture(tree: _Tree) -> None:
    """Takes the mark from elements that hold the page's text, and drops the blocks inside the others."""
    for node, _, text, linked in tree.blocks:
        node.own += max(0, len(text) - linked)
        node.prose |= len(text) >= PROSE_CHARS and linked <= PROSE_LINKS * len(text)
    for node in reversed(tree.nodes):
        node.chars += node.own
        node.prose_inside |= node.prose
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.prose_inside |= node.prose_inside
    chars, prose, marked = 0, False, []

    def count(node: _Node) -> None:
        nonlocal chars, prose
        todo = [node]
        while todo:
            n = todo.pop()
            chars, prose = chars + n.own, prose or n.prose
            for c in n.children:
                if c.marked:
                    heapq.heappush(marked, (-c.chars, c.order, c))
                else:
                    todo.append(c)

    count(tree.root)
    outside = chars
    for node in tree.nodes:
        # a form around the page's text is the page, as servers generate it
        if node.tag == "form" and not node.named and node.prose_inside and node.chars > WRAPPER * outside:
            node.marked = False
        # no furniture holds the main part, or an article longer than all that is outside
        if not node.marked and (node.tag == "main" or node.tag == "article" and node.chars > outside):
            up = node.parent
            while up is not None:
                up.marked, up = False, up.parent
    chars, prose, marked = 0, False, []
    count(tree.root)
    while marked and -marked[0][0] > (WRAPPER_OF_PROSE if prose else WRAPPER) * chars:
        node = heapq.heappop(marked)[2]
        node.marked = False
        count(node)
    dropped: set[int] = set()
    for node in tree.nodes:
        if node.marked or node.parent is not None and id(node.parent) in dropped:
            dropped.add(id(node))
    found = []
    for node, tag, text, linked in tree.blocks:
        if id(node) not in dropped:
            while node.tag not in CONTAINERS:
                node = node.parent
            found.append((node, tag, text, linked))
    tree.blocks = found
    tree.nodes = [n for n in tree.nodes if id(n) not in dropped and n.tag in CONTAINERS]


def _score(tree: _Tree) -> None:
    for node, _, text, linked in tree.blocks:
        density = min(1.0, linked / len(text))
        points = (BASE_POINTS + len(text) / CHARS_PER_POINT + len(re.findall("[,،、，;；]", text))) * (1.0 - density)
        share = 1.0
        while node is not None:
            node.points += points * share
            node, share = node.parent, share / 2


def main_blocks(html: str) -> list[str]:
    """Text blocks of the article of one page, in page order; none if the page has no text."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    tree.flush()
    _weigh_furniture(tree)
    if not tree.blocks:
        return []
    kept, around = _chosen(tree)
    return [text for node, _, text, linked in tree.blocks
            if id(node) in kept or id(node) in around and linked <= PROSE_LINKS * len(text)]


def _chosen(tree: _Tree) -> tuple[set[int], set[int]]:
    """Containers kept whole, and those of which only the blocks between their children are kept."""
    _score(tree)
    own = {id(n): [0, 0, False, False, False] for n in tree.nodes}  # text outside links, links, a title, prose, a sentence
    for node, tag, text, linked in tree.blocks:
        o, few = own[id(node)], linked <= PROSE_LINKS * len(text)
        o[0], o[1] = o[0] + max(0, len(text) - linked), o[1] + linked
        o[2], o[3] = o[2] or tag in ("h1", "h2") and few, o[3] or len(text) >= PROSE_CHARS and few
        o[4] = o[4] or tag in ("p", "blockquote") and not linked and text[-1] in SENTENCE_ENDS
    held = {k: list(o) for k, o in own.items()}
    children: dict[int, list[_Node]] = {k: [] for k in own}
    up: dict[int, _Node | None] = {}
    for node in reversed(tree.nodes):
        above = node.parent
        while above is not None and id(above) not in own:  # an element that is no container
            above = above.parent
        up[id(node)] = above
        if above is not None:
            children[id(above)].append(node)
            h, k = held[id(above)], held[id(node)]
            h[:] = h[0] + k[0], h[1] + k[1], h[2] or k[2], h[3] or k[3], h[4] or k[4]
    whole = max(1, held[id(tree.root)][0])
    for node in tree.nodes:
        node.points += NAMED_ARTICLE.get(node.tag, 0.0) * held[id(node)][0] / whole
    best = max(tree.nodes, key=lambda n: (n.points, -n.order))
    named = best
    while named is not None and named.tag not in NAMED_ARTICLE:
        named = up[id(named)]
    kept: set[int] = set()
    around: set[int] = set()

    def keep(node: _Node) -> None:
        todo = [node]
        while todo:
            n = todo.pop()
            kept.add(id(n))
            todo.extend(children[id(n)])

    def belongs(node: _Node) -> bool:
        chars, links, title, prose, sentence = held[id(node)]
        if named is not None:  # an article beside it in main is the page's too if it has a title of its own and prose
            return title and (prose or not holds_article(node))
        if own[id(node)][3] or node.points >= max(2.0, SIBLING_SHARE * best.points):
            return True
        # a few words beside the article in body itself are more often a notice than its text, if they aren't a paragraph
        return links <= PROSE_LINKS * (chars + links) and (
            title or sentence or chars >= PROSE_CHARS or up[id(node)] is not tree.root)

    def holds_article(node: _Node) -> bool:
        todo = [node]
        while todo:
            n = todo.pop()
            if n.tag == "article":
                return True
            todo.extend(children[id(n)])
        return False

    at = named or best
    keep(at)
    last = None  # an article takes in the title and the blocks beside it, up to the main part
    if named is not None:
        last = named
        while last is not None and last.tag != "main":
            last = up[id(last)]
    while at is not (last if named is not None else tree.root) and (named is None or last is not None):
        above = up[id(at)]
        others = [n for n in children[id(above)] if n is not at and any(held[id(n)][:2])]
        found = [n for n in others if belongs(n)]
        if named is None and (others or any(own[id(above)][:2])) and not found and not own[id(above)][0]:
            break  # only lists of links stand beside the article
        around.add(id(above))
        for n in found:
            keep(n)
        at = above
    return kept, around


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in by_text_size(batches, "html"):
        text = ["\n\n".join(main_blocks(h)) for h in b["html"]]
        yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": text,
                            "n_chars": [len(t) for t in text]})


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``: main text of every row of ``pages(page_id, url, html)``.

    Other columns are ignored; null page_id and url stay null, a null or
    empty html gives an empty text. Repeated rows are treated one by one. Of
    containers with equal points the first in the page wins. The whole html
    is read whatever its length; an empty table gives no rows.
    """
    source = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_batches(source, _extract, "page_id long, url string, text string, n_chars long")
