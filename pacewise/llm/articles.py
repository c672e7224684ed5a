"""Main text of web pages by consensus on where a host keeps it.

Each page's containers are scored by the text that they hold outside of links and page
furniture. A page gives its vote to the best container's path of tags and classes,
numbers left out. Spark adds up the votes of a host, and all its pages are read again
under the winning path; a page that has nothing there is read under its own.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.llm.store import ship_package, stored
from pacewise.llm.urls import host_of

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style title textarea noscript template iframe xmp noembed".split())
FURNITURE = frozenset(
    "nav footer aside form button select option head svg canvas object audio video dialog menu "
    "fieldset label".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key ends an open element of the value.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
BOUNDS = frozenset("article aside blockquote body div dl main nav ol section table td ul".split())

#: Words of a container's class or id that mark page furniture, whole or as a word's begin.
WORDS = frozenset(
    "ad ads adv nav menu side footer header masthead banner notice notices alert social share "
    "sharing related reply replies respond popup modal overlay widget toolbar topbar login signup "
    "search pager pagination consent gdpr disqus skip hidden tags meta byline copyright legal "
    "disclaimer trending popular ticker drawer dropdown".split()
)
BEGINS = ("advert", "cookie", "comment", "sidebar", "breadcrumb", "navbar", "navig", "newsletter",
          "sponsor", "promo", "subscri", "recommend")
ENDINGS = ("nav", "menu", "menubar")
#: With these, and words of place, a name of more words still says no more than furniture.
PARTS = frozenset(
    "slot box container wrapper wrap block list bar button buttons link links posts icons unit "
    "area form thread section".split()
)
PLACES = frozenset(
    "post entry article inline top bottom left right page site user google reader readers".split()
)
#: Words that begin like BEGINS and are furniture by themselves.
NAMED = frozenset(
    "advert adverts advertisement advertisements advertising cookie cookies comment comments "
    "commentlist sidebar sidebars breadcrumb breadcrumbs navbar navigation newsletter newsletters "
    "sponsor sponsors sponsored promo promos subscribe subscription recommended "
    "recommendations".split()
)
#: What holds text of its own, whatever its class or id: these carry topics and slugs.
CONTENT = frozenset("html body main article h1 h2 h3 h4 h5 h6 p".split())
#: In an article these words mark its own parts.
OWN_WORDS = frozenset(("header", "meta", "byline", "tags", "banner", "hidden"))
#: Ids in an article are slugs of its headings, unless they name these.
OTHERS = frozenset(
    "ad ads advert adverts advertisement advertisements comment comments commentlist respond reply "
    "replies disqus sidebar sidebars sponsor sponsors sponsored".split()
)
#: Elements of an article whose ids are looked at, and all whose class may name several words.
HOLDERS = frozenset("div section aside ol ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
#: A sibling counts from this share of the best container's text on.
SIBLING = 0.2

#: Quotes count only behind an equals sign; a tag may end with the page.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Classes by which a site states a text's topic or state.
_STATE = re.compile(r"(?:category|tag)-.*|.*-(?:open|closed)", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

#: How sure it is that an element is furniture: by its whole name or tag, or by one word.
SURE, WEAK, NOT = 2, 1, 0


def _words(name: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(name)]


def _says_furniture(
    name: str, but: frozenset[str] = frozenset(), only: frozenset[str] | None = None
) -> bool:
    """Whether all words of a class name or id are furniture, its parts or its place."""
    words = _words(name)
    if only is None:
        marks = [w in NAMED or w.endswith(ENDINGS) or w in WORDS and w not in but for w in words]
    else:
        marks = [w in only for w in words]
    return any(marks) and all(m or w in PARTS or w in PLACES for m, w in zip(marks, words))


def _furniture(
    tag: str, attributes: dict[str, str], inside: bool, article: bool, by_class: bool
) -> int:
    """SURE, WEAK or NOT; `inside` an article or main, `article` is whether it is an article."""
    if tag in FURNITURE or attributes.get("role", "").lower() in ROLES:
        return SURE
    if "hidden" in attributes or _UNSEEN.search(attributes.get("style", "")):
        return SURE
    if tag == "header" and not inside:
        return SURE
    if not by_class:
        return NOT
    classes = [c for c in attributes.get("class", "").split() if not _STATE.fullmatch(c)]
    name = attributes.get("id", "")
    if tag == "article":
        return SURE if any(_says_furniture(c, only=OTHERS) for c in classes) else NOT
    if tag in CONTENT:
        return NOT
    but = OWN_WORDS if inside else frozenset()
    if any(_says_furniture(c, but) for c in classes):
        return SURE
    if tag in HOLDERS and _says_furniture(name, only=OTHERS):
        return SURE
    if article or tag not in BLOCK:
        return NOT
    # Outside of an article ids name containers, too, and one word makes a container suspect.
    if _says_furniture(name, but):
        return SURE
    for word in (w for n in (classes if tag == "section" else [*classes, name]) for w in _words(n)):
        if word.startswith(BEGINS) or word.endswith(ENDINGS):
            return WEAK
        if word in WORDS and word not in but:
            return WEAK
    return NOT


def _label(tag: str, attributes: dict[str, str]) -> str:
    """Tag and classes, or else the id; digits go, so that numbered ones are one."""
    classes = sorted(set(re.sub(r"[\d/]+", "", attributes.get("class", "")).split()))
    name = re.sub(r"[\d\s/]+", "", attributes.get("id", ""))
    return ".".join([tag, *classes]) if classes or not name else f"{tag}#{name}"


def _tag(label: str) -> str:
    return re.split(r"[.#]", label, maxsplit=1)[0]


class Block(NamedTuple):
    """A block's path and suspect container, by number, its text, and how much is linked."""

    path: int
    suspect: int
    text: str
    linked: int


class Page:
    """A page's text blocks, and its containers' paths as a tree in which siblings are one.

    Path 0 is the page. Broken pages are read as browsers do: unclosed elements end with
    what holds them, an unfinished tag at the end is no text. Each element is pushed and
    popped once, and open elements are found by their tag, so time grows with the page.
    """

    def __init__(self, page: str, by_class: bool = True) -> None:
        self.labels, self.parents, self.depths = [""], [-1], [0]
        self.articles, self.mains = [-1], [-1]
        self.children: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []
        #: Containers that one word makes suspect: the suspect that holds them.
        self.suspects = [-1]
        #: Whether any text was left out as furniture.
        self.dropped = False
        self._read(page, by_class)
        self._judge()

    def _path(self, parent: int, label: str) -> int:
        known = self.children.get((parent, label))
        if known is not None:
            return known
        number = len(self.labels)
        self.children[parent, label] = number
        self.labels.append(label)
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1)
        tag = _tag(label)
        for outermost, name in ((self.articles, "article"), (self.mains, "main")):
            held = outermost[parent]
            outermost.append(held if held >= 0 else number if tag == name else -1)
        return number

    def _read(self, page: str, by_class: bool) -> None:
        # Of each open element: tag, path, whether it is furniture, and its suspect.
        stack: list[tuple[str, int, bool, int]] = []
        places: dict[str, list[int]] = defaultdict(list)
        bounds: list[int] = []
        in_block: list[int] = []
        held: list[str] = []
        linked = at = 0

        def finish() -> None:
            nonlocal linked
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                _, path, _, suspect = stack[-1] if stack else ("", 0, False, 0)
                self.blocks.append(Block(path, suspect, text, linked))
            held.clear()
            linked = 0

        def pop(down_to: int) -> None:
            while len(stack) > down_to:
                tag = stack[-1][0]
                if tag in BLOCK:
                    finish()
                    in_block.pop()
                stack.pop()
                places[tag].pop()
                if tag in BOUNDS:
                    bounds.pop()

        def close(tags: set[str]) -> None:
            """End the innermost open element of `tags`, unless a container lies between."""
            last = max((places[t][-1] for t in tags if places[t]), default=-1)
            # A container that is itself among the tags is its own bound.
            if last >= 0 and (not bounds or last >= bounds[-1]):
                pop(last)

        while True:
            token = _TOKEN.search(page, at)
            piece = page[at : token.start() if token else len(page)]
            if piece:
                if stack and stack[-1][2]:
                    self.dropped |= not piece.isspace()
                else:
                    held.append(piece)
                    linked += len(piece) if places["a"] else 0
            if token is None:
                break
            at = token.end()
            ending, name, rest = token[1], token[2], token[3]
            if name is None or not token[4]:
                continue
            tag = name.lower()
            if ending:
                if tag == "p" and not places["p"]:
                    finish()
                if places[tag]:
                    last = places[tag][-1]
                    if tag in BLOCK or not in_block or last > in_block[-1]:
                        pop(last)
                continue
            if tag == "br":
                if not (stack and stack[-1][2]):
                    held.append(" ")
                continue
            if tag in BLOCK:
                finish()
                close({"p"})
            if tag in ENDS:
                close(ENDS[tag])
            if tag in VOID:
                continue
            if tag in RAW:
                end = _CLOSE[tag].search(page, at)
                at = page.find(">", end.end()) + 1 if end else 0
                at = at or len(page)
                continue
            attributes = {
                m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "")
                for m in _ATTRIBUTE.finditer(rest)
            }
            _, path, furniture, suspect = stack[-1] if stack else ("", 0, False, 0)
            if not furniture:
                article = bool(places["article"])
                found = _furniture(tag, attributes, article or bool(places["main"]), article, by_class)
                furniture = found == SURE
                if found == WEAK:
                    self.suspects.append(suspect)
                    suspect = len(self.suspects) - 1
            if tag in BLOCK:
                path = self._path(path, _label(tag, attributes))
                in_block.append(len(stack))
            if tag in BOUNDS:
                bounds.append(len(stack))
            places[tag].append(len(stack))
            stack.append((tag, path, furniture, suspect))
        pop(0)
        finish()

    def _judge(self) -> None:
        """Leave out suspect containers, but none that holds most of the page's unlinked text."""
        sizes = [0] * len(self.suspects)
        for b in self.blocks:
            sizes[b.suspect] += max(len(b.text) - b.linked, 0)
        total = sum(sizes)
        for s in range(len(sizes) - 1, 0, -1):
            sizes[self.suspects[s]] += sizes[s]
        out = [False] * len(sizes)
        for s in range(1, len(sizes)):
            out[s] = out[self.suspects[s]] or 2 * sizes[s] <= total
        kept = [b for b in self.blocks if not out[b.suspect]]
        self.dropped |= len(kept) < len(self.blocks)
        self.blocks = kept

    def names(self, path: int) -> tuple[str, ...]:
        found = []
        while path:
            found.append(self.labels[path])
            path = self.parents[path]
        return tuple(reversed(found))

    def under(self, names: tuple[str, ...]) -> list[str]:
        """The texts of all blocks under a path; a bare last `article` or `main` is any one."""
        path = 0
        for name in names[:-1]:
            path = self.children.get((path, name), -1)
        ends = {self.children.get((path, names[-1]), -1)} if names else {0}
        if names and names[-1] in ("article", "main"):
            ends |= {n for n in range(len(self.labels)) if self.parents[n] == path and _tag(self.labels[n]) == names[-1]}
        inside = [False] * len(self.labels)
        for n in range(len(self.labels)):
            inside[n] = n in ends or n > 0 and inside[self.parents[n]]
        return [b.text for b in self.blocks if inside[b.path]]


def best_path(page: Page) -> tuple[tuple[str, ...], float] | None:
    """The container with the most text outside of links, and its share of the page's.

    A block counts for the outermost article around it, else the outermost main, else for
    what holds it. From there the container grows: to what holds it, where that adds
    little, such as the heading, or more that is no list of links; to the whole body where
    the siblings below it hold a good part of the text; and to all articles side by side.
    """
    if not page.blocks:
        return None
    count = len(page.labels)
    scores, sizes, linked = [0] * count, [0] * count, [0] * count
    for b in page.blocks:
        own = page.articles[b.path]
        if own < 0:
            own = page.mains[b.path]
        if own < 0:
            holds = page.depths[b.path] < 2 or _tag(page.labels[b.path]) in BOUNDS
            own = b.path if holds else page.parents[b.path]
        scores[own] += max(len(b.text) - 2 * b.linked, 0)
        sizes[b.path] += len(b.text)
        linked[b.path] += min(b.linked, len(b.text))
    for n in range(count - 1, 0, -1):
        sizes[page.parents[n]] += sizes[n]
        linked[page.parents[n]] += linked[n]
    best = max(range(count), key=lambda n: (scores[n], sizes[n] > 0, -page.depths[n], -n))
    share = (scores[best] + 1) / (sizes[0] + 1)
    if _tag(page.labels[best]) in ("article", "main"):
        return _with_siblings(page, best, sizes, linked), share
    while best and _tag(page.labels[best]) not in ("html", "body"):
        parent = page.parents[best]
        more, more_linked = sizes[parent] - sizes[best], linked[parent] - linked[best]
        text = 2 * more_linked <= more
        if _tag(page.labels[parent]) in ("html", "body", ""):
            if not text or more - more_linked < max(SIBLING * (sizes[best] - linked[best]), 1):
                break
        elif more > 0.25 * sizes[best] and not text:
            break
        best = parent
    return page.names(best), share


def _with_siblings(page: Page, best: int, sizes: list[int], linked: list[int]) -> tuple[str, ...]:
    """The article's path, or that of all articles beside it if they hold a good part."""
    names, tag, parent = page.names(best), _tag(page.labels[best]), page.parents[best]
    others = [
        n
        for n in range(1, len(page.labels))
        if n != best and page.parents[n] == parent and _tag(page.labels[n]) == tag
    ]
    beside = sum(sizes[n] - linked[n] for n in others)
    if beside and beside >= SIBLING * (sizes[best] - linked[best]):
        return (*names[:-1], tag)
    more, more_linked = sizes[parent] - sizes[best], linked[parent] - linked[best]
    if _tag(page.labels[parent]) == "main" and more <= 0.25 * sizes[best] and 2 * more_linked <= more:
        return names[:-1]
    return names


def page_blocks(page: str) -> Page:
    """The page, read without regard to classes if these would leave nothing."""
    found = Page(page)
    if not found.blocks and found.dropped:
        found = Page(page, by_class=False)
    return found


def main_text(page: str | None, path: str | None = None) -> str:
    """The text under `path`, or under the page's own best container; blocks joined by \\n."""
    found = page_blocks(page or "")
    if path is not None and (texts := found.under(tuple(path.split("/")) if path else ())):
        return "\n".join(texts)
    own = best_path(found)
    return "\n".join(found.under(own[0])) if own else ""


def votes(pages: DataFrame) -> DataFrame:
    """For each row (host, html) with any text: host, path and the vote's weight."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, page in zip(batch.column("host"), batch.column("html")):
                best = best_path(page_blocks(page.as_py() or ""))
                if best:
                    rows.append((host.as_py(), "/".join(best[0]), best[1]))
            hosts, paths, shares = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.float64())],
                names=["host", "path", "share"],
            )

    return pages.select("host", "html").mapInArrow(vote, "host string, path string, share double")


def consensus(pages: DataFrame) -> DataFrame:
    """The path that won the most votes of each host: won_host, path."""
    totals = votes(pages).groupBy("host", "path").agg(
        # Shares are added as whole numbers, so that the order doesn't matter.
        F.sum((F.col("share") * 1_000_000).cast("long")).alias("weight")
    )
    return totals.groupBy(F.col("host").alias("won_host")).agg(
        F.max_by("path", F.struct("weight", "path")).alias("path")
    )


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """The main text of every row: page_id, url, text, n_chars, path.

    Null and empty pages, and pages without text outside of furniture, have the empty
    text. Pages without a host, null urls among them, vote together. Repeated rows vote
    and are returned as often as they occur; an empty table gives an empty result; other
    columns are not read. `path` is what the host's pages agreed on, null for a host
    without text.

    Votes are added before they are shuffled, so a host with most of the pages is as
    many rows as it has layouts. The winners are joined by host; Spark broadcasts them
    if their file is small, and splits a hot host if it is not.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    winners = stored(consensus(rows), "paths")
    ready = rows.join(winners, F.col("host") == F.col("won_host"), "left").select(
        "page_id", "url", "html", "path"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page.as_py(), path.as_py())
                for page, path in zip(batch.column("html"), batch.column("path"))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                    batch.column("path"),
                ],
                names=["page_id", "url", "text", "n_chars", "path"],
            )

    kind = ready.schema["page_id"].dataType.simpleString()
    return ready.mapInArrow(
        read, f"page_id {kind}, url string, text string, n_chars long, path string"
    )
