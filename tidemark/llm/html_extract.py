"""HTML extraction by consensus host paths.

1. Each page's containers are scored by the text that they hold outside menus, adverts and the like,
   less the text of links; article-like tags count for more, the whole body for less. A container's
   generalised path is that of the tags and classes that lead to it, with digits blanked.
2. Pages vote, in Spark, on the path of their best container: votes are summed by host and path, with
   partial aggregation, so a host that holds a third of all pages is no hot group. The path with most
   votes wins its host.
3. Every page is extracted anew from the containers on its host's winning path; a page without any
   text there falls back to its own best container.

Tags and roles that are not the article (nav, footer and the like) are left out, and so are containers
whose class or id is a word for such, as sidebar. Where it is only a part of a longer name, as in
site-footer or post-related, the container is left out if it holds less than half of the page's text;
if the part may as well be a topic, as in text-search-engines, only if most of its text is links or
it is short. A form around the article, of three quarters of the page's text with a paragraph or an article
in it, counts as any container; other forms are left out. Of an article's own header its headings stay.
Names as has-sidebar, no-header or post-header (the head of the article itself) tell
nothing. If nothing is left, names of classes don't count.

A block's white space becomes one space; blocks are joined by a newline in page order. A null or empty
page has an empty text; a cut-off page is read as far as it goes. A null or odd url belongs to the host
''. Repeated rows are extracted alike. Columns other than id, url and html don't matter.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Hosts up to which the winning paths are broadcast (about 100 bytes each).
BROADCAST_HOSTS = 100_000

# Kinds of HTML elements, and words of classes and roles that mark what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
DROPPED = frozenset("head nav header footer aside button select menu dialog object canvas".split()) | RAW
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_SELF = frozenset("li dt dd tr td th option".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar header footer masthead "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe comment comments respond disqus share sharing social related recommended "
    "widget pagination pager toolbar login signup search".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu".split())
#: First parts of names that tell of a state, not of what the container is.
STATE_WORDS = frozenset("has have no not with without is hide hidden show shows".split())
CONTENT_WORDS = frozenset("article content post entry story main body text".split())
#: Words that name the head of an article where a content word stands by them, and words
#: that may be a topic, with the characters below which a container of such a name is left out.
HEAD_WORDS = frozenset("header masthead".split())
TOPIC_WORDS = frozenset("search menu login signup social share sharing promo widget ad ads banner modal".split())
SHORT = 120

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")
#: How far a class or id tells that a container is not the article: not at all, in part of a name that
#: may be a topic, in part of a name, in a whole one.
PLAIN, MAYBE, PARTLY, WHOLLY = range(4)


@dataclass
class Node:
    tag: str
    path: str
    parent: Node | None
    aside: bool
    mark: int = PLAIN
    weight: float = 1.0
    held: int = 0
    held_links: int = 0
    chars: int = 0
    link_chars: int = 0
    longest: int = 0
    out: bool = False
    head: bool = False


def _weight(tag: str, names: set[str]) -> float:
    if tag in ("article", "main"):
        return 1.5
    if tag in ("body", "html"):
        return 0.8
    return 1.2 if names & CONTENT_WORDS else 1.0


def _mark(tokens: list[str]) -> int:
    """What the class names and the id tell."""
    mark = PLAIN
    for t in tokens:
        parts = re.split(r"[^a-z#]+", t)
        if t in ASIDE_WORDS:
            return WHOLLY
        told = ASIDE_WORDS.intersection(parts)
        if not CONTENT_WORDS.isdisjoint(parts):
            told -= HEAD_WORDS
        if told and parts[0] not in STATE_WORDS:
            mark = max(mark, MAYBE if told <= TOPIC_WORDS else PARTLY)
    return mark


class Page:
    """The containers of a page, in page order, each with the blocks of text below it."""

    def __init__(self, source: str) -> None:
        self.root = Node("", "", None, False)
        self.nodes: list[Node] = []
        self.every = [self.root]
        self.stack = [self.root]
        self.pending: list[tuple[str, bool]] = []
        self.found: list[tuple[Node, str, int]] = []
        self._read(source)
        self._credit()

    def _flush(self) -> None:
        """End the current block."""
        if not self.pending:
            return
        text = " ".join(htmllib.unescape("".join(t for t, _ in self.pending)).split())
        linked = sum(len(t) for t, in_link in self.pending if in_link)
        self.pending = []
        if text and not self.stack[-1].aside:
            self.found.append((self.stack[-1], text, min(linked, len(text))))

    def _mark_below(self, told: Callable[[Node], bool]) -> None:
        """Mark the containers that aren't the article, with all below them; parents come first."""
        for n in self.every:
            n.out = (n.parent is not None and n.parent.out) or told(n)

    def _hold(self, blocks: list[tuple[Node, str, int]]) -> None:
        """How much text, and of links, each container holds; children are added to their parents."""
        for n in self.every:
            n.held = n.held_links = n.longest = 0
        for at, text, linked in blocks:
            at.held, at.held_links, at.longest = at.held + len(text), at.held_links + linked, max(at.longest, len(text) - linked)
        for n in reversed(self.every[1:]):
            n.parent.held, n.parent.held_links = n.parent.held + n.held, n.parent.held_links + n.held_links
            n.parent.longest = max(n.parent.longest, n.longest if n.tag not in ("article", "main") or not n.held else SHORT)

    def _credit(self) -> None:
        """Credit each block to all containers that it lies in, unless one of them isn't the article."""
        if any(n.tag == "form" for n in self.every):
            self._hold(self.found)
            self._mark_below(lambda n: n.tag == "form" and (4 * n.held < 3 * self.root.held or n.longest < SHORT))
            self.found = [x for x in self.found if not x[0].out]
        self._mark_below(lambda n: n.mark == WHOLLY)
        self._hold([x for x in self.found if not x[0].out])
        least = self.root.held / 2
        thin = lambda n: n.held < SHORT or n.held_links > n.held / 2
        self._mark_below(lambda n: n.mark == WHOLLY or bool(n.mark and n.held < least and (n.mark == PARTLY or thin(n))))
        # where that leaves nothing the names of classes don't count
        self.kept = [x for x in self.found if not x[0].out] or self.found
        self._hold(self.kept)
        for n in self.every:
            n.chars, n.link_chars = n.held, n.held_links

    def blocks(self, chosen: list[Node]) -> list[str]:
        """The blocks in these containers, in page order."""
        top = {id(n) for n in chosen}
        for n in self.every:
            n.out = id(n) in top or (n.parent is not None and n.parent.out)
        return [text for at, text, _ in self.kept if at.out]

    def _open(self, tag: str, attrs: str) -> None:
        if tag in CLOSED_BY_SELF:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == tag:
                    del self.stack[k:]
                    break
                if self.stack[k].tag in ("ul", "ol", "dl", "table", "div", "article"):
                    break
        parent = self.stack[-1]
        found: dict[str, str] = {}
        for k, a, b, c in _ATTR.findall(attrs):
            found.setdefault(k.lower(), a or b or c)  # of repeated attributes the first counts
        classes = re.sub(r"\d+", "#", found.get("class", "")).lower().split()
        tokens = [*classes, *re.sub(r"\d+", "#", found.get("id", "")).lower().split()]
        names = set(re.split(r"[^a-z#]+", " ".join(tokens)))
        told = tag in DROPPED or found.get("role", "").lower() in ASIDE_ROLES
        # within the header of an article: its headings are text, the rest isn't
        head = parent.head and not told
        if tag == "header" and not parent.aside and "role" not in found:
            head = any(n.tag == "article" for n in self.stack)
        aside = (parent.aside or told) and not (parent.head and tag in HEADINGS and not told)
        mark = PLAIN if tag in ("body", "html", "article", "main") else _mark(tokens)
        node = Node(tag, f"{parent.path}/{'.'.join([tag, *sorted(classes)])}", parent, aside, mark, _weight(tag, names), head=head)
        self.stack.append(node)
        self.every.append(node)
        if not aside and tag not in ("p", "li"):
            self.nodes.append(node)

    def _read(self, source: str) -> None:
        at, links, end = 0, 0, len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            text = source[at : m.start() if m else end]
            if text:
                self.pending.append((text, links > 0))
            if m is None:
                break
            at = m.end()
            if m[2] is None:
                continue
            closing, tag = m[1] == "/", m[2].lower()
            if tag == "br":
                self.pending.append((" ", False))
            elif tag in INLINE:
                links = max(0, links + (-1 if closing else 1)) if tag == "a" else links
            elif closing:
                self._flush()
                for k in range(len(self.stack) - 1, 0, -1):
                    if self.stack[k].tag == tag:
                        del self.stack[k:]
                        links = 0
                        break
            else:
                self._flush()
                if self.stack[-1].tag == "p":
                    self.stack.pop()
                if tag == "svg" and m[3].endswith("/"):
                    continue  # of foreign elements the closing slash holds
                if tag in RAW:
                    stop = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                    at = stop.end() if stop else end
                elif tag not in VOID:
                    self._open(tag, m[3])
        self._flush()

    def best(self) -> Node | None:
        """The container with most text of its own; of equals the innermost."""
        top, out = 0.0, None
        for n in self.nodes:
            score = (n.chars - n.link_chars) * n.weight
            if score >= top and n.chars:
                top, out = score, n
        return out

    def text(self, path: str | None) -> str:
        chosen = [n for n in self.nodes if n.path == path]
        blocks = self.blocks(chosen)
        if not blocks:
            blocks = self.blocks([self.best() or self.root])
        return "\n".join(blocks)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, path (its host's winning path)."""
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    base = base.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, paths = [], []
            for host, source in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                node = Page(source).best()
                if node is not None:
                    hosts.append(host)
                    paths.append(node.path)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], ["host", "path"])

    counted = base.select("host", "html").mapInArrow(votes, "host string, path string").groupBy("host", "path").count()
    winners = materialize(counted.groupBy("host").agg(F.max_by("path", F.struct("count", "path")).alias("path")), "paths")
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [Page(source).text(path) for path, source in zip(b.column("path").to_pylist(), b.column("html").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64()), b.column("path")], ["page_id", "url", "text", "n_chars", "path"])

    joined = base.join(winners, "host", "left").select("page_id", "url", "html", "path")
    kind = joined.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long, path string")
