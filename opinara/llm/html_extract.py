"""HTML extraction by consensus host paths.

Each page's containers are scored by the running text they hold. A container is known by its generalised path: tags and
classes from the body down, without digits. Spark adds up the votes of a host's pages for their best paths; the pages
are then read again, and the first winning path that a page has decides what its article is. A page without a host, or
without any winning path, goes by its own best container.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.session import lookup_join, new_path, stored

# A path wins if it has this share of its host's best path and this one of all the host's votes, so a host has at most
# 1 / CONSENSUS winners; a page votes for its best few containers.
WINNING_SHARE = 0.15
CONSENSUS = 0.01
VOTES = 3
# Largest table of winners, in rows and characters, that is broadcast; a larger one is joined by a shuffle.
BROADCAST = (50_000, 20_000_000)

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# HTML's elements by what they do to text.
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video head select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub"
    " sup time tt u var label output ruby rt rp".split()
)
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr"
        " main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option"]),
}
LISTS = frozenset(["ul", "ol", "table", "dl"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
TEXTUAL = HEADINGS | {"p", "pre", "blockquote", "li", "td", "th", "dd", "dt", "figcaption", "tr", "tbody", "thead", "table"}
BAD_TAGS = frozenset("nav footer aside form menu button dialog fieldset header".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist"
    " consent cookie cookies disqus discussion footer form gdpr header login masthead menu modal nav navbar navigation"
    " newsletter notice notices pager pagination popup promo promoted recommended related replies reply respond search"
    " share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget"
    " widgets reactions".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus discussion replies reply respond reactions".split())
# An element named like a sidebar or the like that holds more of a page's text than this is its layout.
LAYOUT_SHARE = 0.6
# Inside an article, an element of a compound name that holds as many characters, nearly all outside links, is part of it.
SECTION_CHARS, SECTION_LINKED = 400, 0.1
GOOD_WORDS = frozenset("article articlebody body content entry main post story text prose".split())
HEAD_END = re.compile(r"<body(?=[\s>/])", re.IGNORECASE)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())


@dataclass
class Node:
    parent: int
    tag: str
    step: str
    bad: bool
    good: bool
    # Bad by its class alone: layouts are named after their sidebars and menus, too.
    soft: bool = False
    # The number of the path, how many elements from the root down are bad, and the nearest element that may be an article.
    path: int = 0
    bads: int = 0
    holder: int = 0
    score: float = 0.0


@dataclass
class Block:
    node: int
    text: str
    linked: int


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    # Numbers of the paths by (number of the path above, step), and the other way round.
    paths: dict[tuple[int, str], int] = field(default_factory=dict)
    steps: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])

    def path_of(self, number: int) -> str:
        steps = []
        while number > 0:
            number, step = self.steps[number]
            steps.append(step)
        return "/".join(reversed(steps))

    def number_of(self, path: str) -> int | None:
        number: int | None = 0
        for step in path.split("/"):
            number = self.paths.get((number, step))
            if number is None:
                return None
        return number

    def settle(self) -> None:
        """Fill in what elements know of those around them."""
        for number, node in enumerate(self.nodes[1:], 1):
            up = self.nodes[node.parent]
            key = (up.path, node.step)
            if key not in self.paths:
                self.paths[key] = len(self.steps)
                self.steps.append(key)
            node.path = self.paths[key]
            node.bads = up.bads + node.bad
            node.holder = up.holder if node.tag in TEXTUAL or node.tag == "html" else number


def words_of(name: str) -> list[str]:
    """The lower-cased words of a class or id: split at signs, digits and inner capitals."""
    return re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())


def describe(tag: str, written: str) -> tuple[str, bool, bool, bool]:
    """Path step, whether the element is no part of an article, named like one, and bad by its class alone."""
    if not written.strip():
        return tag, tag in BAD_TAGS, tag in ("article", "main"), False
    found = {}
    for m in ATTRIBUTE.finditer(written):
        found.setdefault(m.group(1).lower(), entities.unescape(m.group(2) or m.group(3) or m.group(4) or ""))
    classes = found.get("class", "")
    names = words_of(classes) + words_of(found.get("id", ""))
    style = found.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in found or "display:none" in style or found.get("aria-hidden") == "true"
    good = tag in ("article", "main") or found.get("role") in ("main", "article") or bool(GOOD_WORDS & set(names))
    bad = hidden or tag in BAD_TAGS or found.get("role") in ROLES
    named = tag not in ("body", "html", "article", "main") and bool(BAD_WORDS & set(names))
    soft = named and not bad and not COMMENT_WORDS & set(names)
    step = ".".join([tag, *sorted({"-".join(words_of(c)) for c in classes.split()} - {""})])
    return step, bad or named, good, soft


def parse(source: str) -> Page:
    """Elements and text blocks of a page, however broken it is; what raw elements and comments hold is left out."""
    page = Page([Node(-1, "", "", False, False)])
    stack, pending, linked, links, at = [0], [], 0, 0, 0
    opened: dict[str, int] = {}
    implied = not HEAD_END.search(source)

    def push(tag: str, step: str, bad: bool, good: bool, soft: bool) -> None:
        page.nodes.append(Node(stack[-1], tag, step, bad, good, soft))
        stack.append(len(page.nodes) - 1)
        opened[tag] = opened.get(tag, 0) + 1

    def cut(depth: int) -> None:
        for node in stack[depth:]:
            opened[page.nodes[node].tag] -= 1
        del stack[depth:]

    def body() -> None:
        nonlocal implied
        if implied:
            implied = False
            push("body", "body", False, False, False)

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            if implied and not piece.isspace():
                body()
            pending.append(piece)
            if links:
                linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if pending:
            body = " ".join(entities.unescape("".join(pending)).split())
            if body:
                page.blocks.append(Block(stack[-1], body, min(linked, len(body))))
            pending.clear()
        linked = 0

    def close(tag: str, stop: frozenset[str] = frozenset()) -> None:
        if not opened.get(tag):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if page.nodes[stack[depth]].tag == tag:
                cut(depth)
                return
            if page.nodes[stack[depth]].tag in stop:
                return

    while True:
        m = MARKUP.search(source, at)
        text(source[at : m.start() if m else len(source)])
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue
        end, written = bool(m.group(1) or m.group(4)), m.group(3) or m.group(6) or ""
        if tag in RAW:
            if not end and not written.endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}(?=[\s>/]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                if tag == "head":  # its end tag may be left out: the body closes it
                    first = HEAD_END.search(source, at)
                    if not over or first and first.start() < over.start():
                        continue
                at = over.end() if over else len(source)
            continue
        if tag == "a":
            links = max(0, links + (-1 if end else 1))
        if tag in INLINE:
            continue
        flush()
        if tag in VOID:
            continue
        if end:
            close(tag, LISTS if tag in CLOSED_BY and tag != "p" else frozenset())
            continue
        links = 0
        if tag not in ("html", "body"):
            body()
        while len(stack) > 1 and tag in CLOSED_BY.get(page.nodes[stack[-1]].tag, ()):
            cut(len(stack) - 1)
        if tag in ("li", "dt", "dd", "tr", "td", "th"):
            for closed in ("li",) if tag == "li" else ("dt", "dd") if tag in ("dt", "dd") else ("td", "th", "tr")[: 3 if tag == "tr" else 2]:
                close(closed, LISTS)
        push(tag, *describe(tag, written))
    flush()
    forgive(page)
    page.settle()
    return page


def forgive(page: Page) -> None:
    """Elements that are bad by their class alone are not, if they hold most of the page's text, or, of a compound name
    inside an article, a long running text."""
    if not any(node.soft for node in page.nodes):
        return
    held, linked = [0] * len(page.nodes), [0] * len(page.nodes)
    for block in page.blocks:
        held[block.node] += len(block.text)
        linked[block.node] += block.linked
    inside = [False] * len(page.nodes)
    for number, node in enumerate(page.nodes[1:], 1):
        inside[number] = inside[node.parent] or page.nodes[node.parent].good
    for number in range(len(page.nodes) - 1, 0, -1):
        held[page.nodes[number].parent] += held[number]
        linked[page.nodes[number].parent] += linked[number]
    for number, node in enumerate(page.nodes):
        if node.soft:
            layout = held[number] - linked[number] > LAYOUT_SHARE * (held[0] - linked[0])
            section = "-" in node.step and inside[number] and held[number] >= SECTION_CHARS
            if layout or section and linked[number] <= SECTION_LINKED * held[number]:
                node.bad = False


def scores(page: Page) -> dict[int, float]:
    """Score of each generalised path: running text, in full for the nearest container and in part further up."""
    found: dict[int, float] = {}
    for block in page.blocks:
        if page.nodes[block.node].bads:
            continue
        worth = (len(block.text) - block.linked) * (1 + min(block.text.count(",") + block.text.count("."), 10) / 10)
        if page.nodes[block.node].tag not in TEXTUAL:
            worth *= 0.7
        holder = page.nodes[block.node].holder
        for level in range(4):
            if holder <= 0:
                break
            node = page.nodes[holder]
            node.score += worth * (2.0 if node.good else 1.0) / (1 + level)
            holder = page.nodes[node.parent].holder
    for node in page.nodes:
        if node.score > 0:
            found[node.path] = found.get(node.path, 0.0) + node.score
    return found


def ballot(page: Page) -> list[tuple[str, float]]:
    """The page's best paths with their shares of the best one's score."""
    every = scores(page)
    least = sorted(every.values())[-VOTES:][:1]
    named = [(page.path_of(number), score) for number, score in every.items() if score >= least[0]]
    found = sorted(named, key=lambda x: (-x[1], x[0]))[:VOTES]
    return [(path, score / found[0][1]) for path, score in found]


def article(page: Page, winners: Iterable[str]) -> str:
    """The text under the first winning path that the page has, else under its best container."""
    chosen = next((number for w in winners if (number := page.number_of(w))), None)
    if chosen is None:
        chosen = next((page.number_of(path) for path, _ in ballot(page)), None)
    if chosen is None:
        return ""
    tops = [0] * len(page.nodes)  # the nearest element of that path around each
    for number, node in enumerate(page.nodes[1:], 1):
        tops[number] = number if node.path == chosen else tops[node.parent]
    lines = []
    for block in page.blocks:
        node, top = page.nodes[block.node], page.nodes[tops[block.node]]
        if tops[block.node] == 0 or top.bads:
            continue
        title = node.tag in HEADINGS and page.nodes[node.parent].tag == "header"
        if node.bads and not title:
            continue
        lines.append(block.text)
    return "\n".join(lines)


def host_of(url: str | Column) -> Column:
    """Lower-cased host of a URL without port; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(F.length(found) > 0, found)


def votes(pages: DataFrame, html: str, url: str) -> DataFrame:
    """Sums of votes by host and path, added up within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], float] = {}
        for batch in batches:
            for host, source in zip(batch.column("_host").to_pylist(), batch.column("_html").to_pylist(), strict=True):
                for path, share in ballot(parse(source)):
                    found[host, path] = found.get((host, path), 0.0) + share
            if len(found) > 100_000:
                yield rows(found)
                found = {}
        yield rows(found)

    def rows(found: dict[tuple[str, str], float]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _ in found], pa.string()),
                pa.array([p for _, p in found], pa.string()),
                pa.array(found.values(), pa.float64()),
            ],
            ["host", "path", "votes"],
        )

    named = pages.select(host_of(url).alias("_host"), F.col(html).alias("_html")).where("_host IS NOT NULL AND _html != ''")
    return named.mapInArrow(run, "host string, path string, votes double").groupBy("host", "path").agg(
        F.sum("votes").alias("votes")
    )


def winning_paths(counted: DataFrame) -> DataFrame:
    """For each host its winning paths, most votes first (equal votes: the longer path, then by name)."""
    counted = stored(counted, "html-votes")
    whole = counted.groupBy("host").agg(F.max("votes").alias("_best"), F.sum("votes").alias("_all"))
    ranked = lookup_join(counted, whole, ["host"], max_rows=BROADCAST[0])
    ranked = ranked.where((F.col("votes") >= WINNING_SHARE * F.col("_best")) & (F.col("votes") >= CONSENSUS * F.col("_all")))
    order = F.struct((-F.round("votes", 6)).alias("v"), (-F.length("path")).alias("n"), F.col("path").alias("p"))
    best = F.transform(F.sort_array(F.collect_list(order)), lambda o: o["p"])
    return ranked.groupBy("host").agg(best.alias("_winners"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", text: str = "text") -> DataFrame:
    """``pages`` with the text of each page's article.

    Null and empty pages give an empty text; a page whose URL is null or has no host goes by its own best container;
    repeated pages give the same text; pages are read whole; a column named ``text`` is replaced; an empty table stays
    empty. A host's winners depend on all its pages.
    """
    kept = [f for f in pages.schema.fields if f.name != text or f.name == html]
    path = new_path(pages.sparkSession, "html-winners")
    winning_paths(votes(pages, html, url)).write.parquet(path)
    winners = pages.sparkSession.read.parquet(path)
    rows, chars = winners.agg(F.count(F.lit(1)), F.sum(F.length("host") + F.length(F.array_join("_winners", "")))).first()
    if rows <= BROADCAST[0] and (chars or 0) <= BROADCAST[1]:
        winners = F.broadcast(winners)
    known = pages.withColumn("_host", host_of(url)).join(
        winners.withColumnRenamed("host", "_winner_host"), F.col("_host") == F.col("_winner_host"), "left"
    )
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept if f.name != text), f"`{text}` string"])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [
            article(parse(source), chosen or ()) if source else ""
            for source, chosen in zip(batch.column(html).to_pylist(), batch.column("_winners").to_pylist(), strict=True)
        ]
        names = [f.name for f in kept if f.name != text]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, pa.string())], [*names, text])

    return common.map_batches(known, schema, work)


def op1_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    found = extract(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
