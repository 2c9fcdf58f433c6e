"""Main text of web pages by the container paths that the pages of a host agree on.

Each page scores its containers and names the best one's path of tags and classes,
numbers left out. Names of classes tell menus and adverts from text, but never empty a
page: see ``Page.settle``. Spark counts the votes per host, and every page is then read again
below the winning path. A page without that path keeps its own best container.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored

# Element and class names of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body div main section td".split())
NOISE_TAGS = frozenset(
    "aside button canvas dialog footer form head header iframe menu nav noscript object "
    "option select script style svg template textarea title".split()
)
NOISE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header menu modal nav navbar navigation newsletter notice "
    "pager pagination popup promo recommended related replies share sharing sidebar signup "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
# A name makes none of the first noise, and of the second only as a whole.
MAIN = frozenset("html body main article".split())
TEXT_BLOCKS = frozenset(
    "blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre summary td th".split()
)
DOUBTS = 16  # open elements in doubt that are told apart
SHARES = 64  # containers around a block that its text counts for; beyond, halves vanish
# Opening one of these ends an open one of the same kind.
CLOSED_BY_NEXT = {"p": BLOCKS, "li": {"li"}, "td": {"td", "th", "tr"}, "tr": {"tr"},
                  "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>|<[!?][^>]*>",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
SPACE = re.compile(r"\s+")
NUMBER = re.compile(r"[0-9]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


@dataclass
class Element:
    """An open element: where its path is, and what holds for all text below it."""

    tag: str
    path: int
    container: int  # path of the innermost container, -1 without one
    noise: bool
    link: bool
    doubts: tuple[int, ...]  # the open elements whose names tell of noise


@dataclass
class Block:
    text: str
    linked: int  # characters within links
    container: int
    doubts: tuple[int, ...]


class Page:
    """Blocks of a page, and the tree of its paths: each a step below another path."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.parents: list[int] = []
        self.steps: list[str] = []
        self.outer: list[int] = []  # the container around each path, -1 without one
        self.numbers: dict[tuple[int, str], int] = {}
        self.whole_names: list[bool] = []  # of the elements in doubt

    def path_below(self, parent: int, step: str, container: int) -> int:
        number = self.numbers.setdefault((parent, step), len(self.steps))
        if number == len(self.steps):
            self.parents.append(parent)
            self.steps.append(step)
            self.outer.append(container)
        return number

    def named(self, number: int) -> str:
        """The path as text; a step holds no white space."""
        steps = []
        while number >= 0:
            steps.append(self.steps[number])
            number = self.parents[number]
        return " ".join(reversed(steps))

    def found(self, path: str) -> int | None:
        number = -1
        for step in path.split(" "):
            number = self.numbers.get((number, step))
            if number is None:
                return None
        return number

    def settle(self) -> None:
        """Drop the blocks of elements whose names tell of noise, but not a page's text.

        An element that one of several words in a name makes noise ("has-sidebar") is none
        if it holds more text than all that is beyond doubt; where nothing is, the largest
        one is none.
        """
        while True:
            sure, sizes = 0, defaultdict(int)
            for block in self.blocks:
                if block.doubts:
                    sizes[block.doubts[0]] += len(block.text)
                else:
                    sure += len(block.text)
            held = [
                (size, -mark)
                for mark, size in sizes.items()
                if size > sure and not (sure and self.whole_names[mark])
            ]
            if not held:
                break
            cleared = -max(held)[1]
            for block in self.blocks:
                if block.doubts and block.doubts[0] == cleared:
                    block.doubts = block.doubts[1:]
        self.blocks = [block for block in self.blocks if not block.doubts]


def _noise_name(tag: str, attributes: str) -> bool | None:
    """Whether a name of a block element is one of noise: as a whole (True), or, of an
    element that holds others, by one of its words (False)."""
    if tag not in BLOCKS or tag in MAIN:
        return None
    by_word = False
    for found in NAMES.finditer(attributes):
        for name in (found[2] or found[3] or found[4] or "").lower().split():
            if name in NOISE_NAMES:
                return True
            by_word |= any(word in NOISE_NAMES for word in re.split("[_-]+", name))
    return False if by_word and tag not in TEXT_BLOCKS else None


def _step(tag: str, attributes: str) -> str:
    """Tag and first class without numbers."""
    for found in NAMES.finditer(attributes):
        if found[1].lower() == "class":
            names = (found[2] or found[3] or found[4] or "").split()
            return f"{tag}.{NUMBER.sub('', names[0])}" if names else tag
    return tag


def parse_page(text: str) -> Page:
    """Text blocks in page order, each with the container it lies in.

    The page is read once from left to right; unclosed and stray tags are tolerated. Menus,
    forms, scripts and other noise give no blocks. White space of a block is one space.
    Paths are numbers with parents and open tags are counted, so deep pages cost no more.
    """
    page, stack, words, linked = Page(), [], [], 0
    opened: Counter[str] = Counter()
    doubts: tuple[int, ...] = ()
    container = -1

    def flush() -> None:
        nonlocal linked
        block = SPACE.sub(" ", entities.unescape("".join(words))).strip()
        if block:
            page.blocks.append(Block(block, linked, container, doubts))
        words.clear()
        linked = 0

    def close(place: int) -> None:
        nonlocal container, doubts
        for element in stack[place:]:
            opened[element.tag] -= 1
        del stack[place:]
        container = stack[-1].container if stack else -1
        doubts = stack[-1].doubts if stack else ()

    at, length = 0, len(text)
    while at < length:
        found = TAG.search(text, at)
        piece = text[at : found.start() if found else length]
        if piece and not (stack and stack[-1].noise):
            words.append(piece)
            if stack and stack[-1].link:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            words.append(" ")
        if found[1]:
            for place in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[place].tag == tag:
                    close(place)
                    break
                if stack[place].tag in CONTAINERS and tag not in BLOCKS:
                    break
            continue
        closes = [other for other, by in CLOSED_BY_NEXT.items() if opened[other] and tag in by]
        for place in range(len(stack) - 1, -1, -1) if closes else ():
            if stack[place].tag in closes:
                close(place)
                break
            if stack[place].tag in CONTAINERS or stack[place].tag in ("ul", "ol", "table", "dl"):
                break
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(text, at)
            at = end.end() if end else length
            continue
        if tag in VOID or found[3].rstrip().endswith("/"):
            continue
        above = stack[-1] if stack else None
        noise = bool(above and above.noise) or tag in NOISE_TAGS
        named = None if noise else _noise_name(tag, found[3])
        if named is not None and len(doubts) < DOUBTS:
            doubts = (*doubts, len(page.whole_names))
            page.whole_names.append(named)
        path = page.path_below(above.path if above else -1, _step(tag, found[3]), container)
        container = path if tag in CONTAINERS else container
        link = tag == "a" or bool(above and above.link)
        stack.append(Element(tag, path, container, noise, link, doubts))
        opened[tag] += 1
    flush()
    page.settle()
    return page


def best_path(page: Page) -> str | None:
    """The container with the most text outside links, its inner containers counted half;
    ties go to the first. A page without a container has none."""
    scores: dict[int, float] = defaultdict(float)
    for block in page.blocks:
        value, path = float(max(len(block.text) - 2 * block.linked, 0)), block.container
        for _ in range(SHARES):
            if path < 0:
                break
            scores[path] += value
            value, path = value / 2, page.outer[path]
    return page.named(max(scores, key=scores.get)) if scores else None


def text_below(page: Page, path: str | None) -> str | None:
    """The blocks within a container, joined by an empty line; all without one.

    None if no block lies there.
    """
    if path is None:
        return "\n\n".join(block.text for block in page.blocks)
    number = page.found(path)
    if number is None:
        return None
    # A path is numbered after its parents, so one pass marks all that lie below.
    below = [False] * len(page.steps)
    for place in range(number, len(below)):
        below[place] = place == number or (page.parents[place] >= 0 and below[page.parents[place]])
    kept = [block.text for block in page.blocks if block.container >= 0 and below[block.container]]
    return "\n\n".join(kept) if kept else None


def _voted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        paths = [best_path(parse_page(html)) for html in batch["html"]]
        yield pd.DataFrame({"host": batch["host"], "path": paths})


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for html, path in zip(batch["html"], batch["path"]):
            page = parse_page(html)
            text = text_below(page, path) if path is not None else None
            texts.append(text_below(page, best_path(page)) if text is None else text)
        out = batch[["page_id", "url"]].copy()
        out["text"], out["n_chars"] = texts, [len(text) for text in texts]
        yield out


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    Votes are counted per host of the url (null and odd urls are the host ""), ties between
    paths go to the smaller one. A null or empty html has an empty text and no vote. Rows
    are read one by one, so repeated pages vote and are returned each time; other columns
    are dropped. Whole pages are read, long or deep, in time that grows with their length.
    An empty table gives no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    given = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host")
    )
    votes = given.select("host", "html").mapInPandas(_voted, "host string, path string")
    counts = votes.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("n"))
    # Stored, their size is known before pages are joined: small tables are broadcast by
    # Spark, and the pages of a host stay where they are.
    winners = stored(
        counts.groupBy("host").agg(F.max_by("path", F.struct("n", F.col("path"))).alias("path"))
    )
    page_id = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {page_id}, url string, text string, n_chars long"
    joined = given.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInPandas(_extracted, schema)
