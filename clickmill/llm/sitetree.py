"""Main text of web pages by site style trees."""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import stored

PAGES = 3  # of a host, that must share a branch before it can be judged
LOW = 0.3  # importance below which a branch is noise
LOW_MAIN = 0.1  # the same within what the page itself marks as its article
DEPTH_WEIGHT = 0.9  # of what lies below a branch, against its own presentation
BROADCAST_ROWS = 100_000  # noise branches of all hosts, or contents of such, that are sent to every task

# What HTML says about its elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul head button select option".split()
)
CLOSES = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
SCOPE = set("table ul ol dl select html body article section div main nav aside footer header form".split())
NOISE_TAGS = set("head nav footer aside menu button select option dialog fieldset".split())
NOISE_WORDS = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead footer sidebar aside widget related recommended "
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay "
    "cookie cookies consent gdpr notice notices notification alert newsletter subscribe signup login search share sharing "
    "social comment comments reply replies respond disqus discussion pagination pager skip toolbar complementary "
    "contentinfo form".split()
)
# What a name may say beside such a word; others, as in has-sidebar or search-page, make it the name of something else.
THING_WORDS = set(
    "area bar block blocks bottom box boxes button buttons col column container group icon icons inner item items left "
    "link links list lists outer panel pane post posts primary right row secondary section site slot text title top unit "
    "wrap wrapper x".split()
)
# What stands before such a word or after it in a name for a part of a page, as in page-footer and comment-body.
BEFORE_WORDS = set("page user reader site global".split())
AFTER_WORDS = set("content contents body articles stories text".split())
NAMED_NEVER = set("html body main article".split())
MAIN_WORDS = {"articlebody", "article-body", "article-content", "entry-content", "post-content", "post-body", "main-content", "story-body", "page-content"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
SPACE = re.compile(r"\s+")
PLAIN, MARKED, MAIN, ARTICLE = range(4)
OUTSIDE, JUDGED, CORE = range(3)


@dataclass
class Element:
    tag: str
    path: str
    noise: bool  # by tag or hidden
    named: tuple[int, ...]  # the elements around it, itself included, that their names alone mark as noise
    level: int
    marks: tuple[tuple[int, int], ...]  # number and level of the marked elements around it, itself included
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    """What a page says: its blocks in order, and for each branch of its tree the children there.

    A block's place is OUTSIDE what the page marks as its article, in the CORE of that, or
    elsewhere in it or on an unmarked page, where the style tree judges it as any branch.
    """

    blocks: list[tuple[str, bool, int, str]] = field(default_factory=list)  # path, noise, place, text
    branches: dict[str, list[str]] = field(default_factory=dict)


def _named(names: str) -> set[str]:
    """Noise words that are whole names, or parts of names that only say what kind of thing it is."""
    found = set()
    for name in names.split():
        parts = re.findall("[a-z]+", name)
        if len(parts) > 1 and parts[0] in BEFORE_WORDS:
            parts = parts[1:]
        if len(parts) > 1 and parts[-1] in AFTER_WORDS:
            parts = parts[:-1]
        words = set(parts)
        if words <= NOISE_WORDS | THING_WORDS | {"header"}:
            found |= words - THING_WORDS
    return found


def _element(tag: str, attributes: str, parent: Element, number: int) -> Element:
    found = {}
    for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
        found.setdefault(name.lower(), value.strip("\"'").lower())
    names = " ".join(found[a] for a in ("class", "id", "role", "itemprop") if a in found)
    label = tag + "".join("." + re.sub(r"\d{3,}", "", w) for w in sorted(names.split()))
    words = _named(names) if names and tag not in NAMED_NEVER else set()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    noise = parent.noise or hidden or tag in NOISE_TAGS or tag == "header" and parent.level < MARKED
    named = tag == "form" or bool(words & NOISE_WORDS) or "header" in words and parent.level < MARKED
    level = ARTICLE if tag == "article" else MAIN if tag == "main" or "main" in found.get("role", "").split() else MARKED if MAIN_WORDS & set(names.split()) else PLAIN
    marks = (*parent.marks, (number, level)) if level else parent.marks
    return Element(tag, f"{parent.path}/{label}", noise, (*parent.named, number) if named else parent.named, max(level, parent.level), marks)


def _places(blocks: list[tuple[str, bool, tuple[tuple[int, int], ...], str]]) -> list[int]:
    """The place of each block (path, noise, marks, text).

    A page's article are all outermost marked elements, or the main ones alone if the one of
    the most text is a main. Its core is the innermost marked element that holds half of its
    text. On an unmarked page all is judged alike.
    """
    size: Counter[tuple[int, int]] = Counter()
    for _, noise, marks, text in blocks:
        if not noise:
            size.update({mark: len(text) for mark in marks})
    outermost = {marks[0] for _, noise, marks, _ in blocks if marks and not noise}
    if not outermost:
        return [JUDGED] * len(blocks)
    if max(sorted(outermost), key=size.get)[1] == MAIN:
        outermost = {mark for mark in outermost if mark[1] == MAIN}
    total = sum(size[mark] for mark in outermost)
    held = [[mark for mark in marks if 2 * size[mark] >= total] for _, noise, marks, _ in blocks if not noise and marks and marks[0] in outermost]
    core = max(held, key=len)[-1:]
    return [
        OUTSIDE if not marks or marks[0] not in outermost else CORE if not core or marks[-1:] == tuple(core) else JUDGED
        for _, _, marks, _ in blocks
    ]


def _lifted(blocks: list[tuple[str, bool, tuple[int, ...], int, str]], forms: set[int]) -> set[int]:
    """Named elements and forms that hold the page's main text, so that this says nothing.

    A form that, itself alone, makes noise of over half of a page's other text is a frame
    round the page. If all text is noise, it is the outermost named element of the most text,
    and so on inside of it. If text that the page marks as its article stands in named
    elements only, and is more than what is not noise, it is those around the most of it.
    """
    only: Counter[int] = Counter()
    for _, noise, named, _, text in blocks:
        if not noise and forms.issuperset(named):
            only.update(dict.fromkeys(named or (0,), len(text)))
    total = sum(len(text) for _, noise, named, _, text in blocks if not noise and forms.issuperset(named))
    lifted = {form for form, size in only.items() if form and 2 * size > total}
    while True:
        clean, marked = 0, False
        held: Counter[tuple[int, ...]] = Counter()
        article: Counter[tuple[int, ...]] = Counter()
        for _, noise, named, level, text in blocks:
            left = tuple(n for n in named if n not in lifted)
            if noise:
                continue
            if not left:
                clean += len(text)
                marked |= level > PLAIN
                continue
            held[left[:1]] += len(text)
            if level > PLAIN:
                article[left] += len(text)
        most = max(article, key=article.get, default=()) if not marked else ()
        if not (most and article[most] > clean):
            most = max(held, key=held.get, default=()) if not clean else ()
        if not most:
            return lifted
        lifted.update(most)


def read_page(html: str) -> Page:
    """Parse a page, however malformed, into text blocks and the branches they hang on."""
    page, stack = Page(), [Element("", "", False, (), PLAIN, ())]
    blocks: list[tuple[str, bool, tuple[int, ...], int, str]] = []
    marks: list[tuple[tuple[int, int], ...]] = []
    text: list[str] = []
    forms: set[int] = set()

    def flush() -> None:
        joined = SPACE.sub(" ", unescape("".join(text))).strip()
        text.clear()
        if joined:
            at = next(e for e in reversed(stack) if e.tag in BLOCK or not e.tag)
            blocks.append((at.path, stack[-1].noise, stack[-1].named, stack[-1].level, joined))
            marks.append(stack[-1].marks)

    def close(depth: int) -> None:
        while len(stack) > depth:
            done = stack.pop()
            if done.tag in BLOCK:
                page.branches.setdefault(done.path, []).extend(done.children)

    def open_at(tags: set[str]) -> int:
        """Depth of the innermost open element of one of the tags, within its table, list or section."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                return depth
            if stack[depth].tag in SCOPE:
                return 0
        return 0

    at = 0
    while token := TOKEN.search(html, at):
        text.append(html[at : token.start()])
        at = token.end()
        ending, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if ending:
            depth = len(stack) - 1
            while depth and stack[depth].tag != tag:
                # A stray inline end tag closes no block.
                depth = 0 if tag not in BLOCK and stack[depth].tag in BLOCK else depth - 1
            if tag in BLOCK:
                flush()
            if depth:
                close(depth)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            closing = open_at({"p"}) if tag not in ("button", "option", "select") else 0
            if closing:
                close(closing)
            if tag in CLOSES and (closing := open_at(CLOSES[tag])):
                close(closing)
            if tag not in ("html", "head"):
                head = next((i for i, e in enumerate(stack) if e.tag == "head"), 0)
                if head:
                    close(head)
        if tag in VOID:
            continue
        element = _element(tag, attributes, stack[-1], at)
        if tag == "form":
            forms.add(at)
        if tag in BLOCK:
            owner = next(e for e in reversed(stack) if e.tag in BLOCK or not e.tag)
            if not owner.children or owner.children[-1] != tag:
                owner.children.append(tag)
        else:
            element.path = stack[-1].path
        stack.append(element)
    text.append(html[at:])
    flush()
    close(1)
    lifted = _lifted(blocks, forms) if any(named for _, _, named, _, _ in blocks) else set()
    found = [(path, noise or not lifted.issuperset(named), mark, text) for (path, noise, named, _, text), mark in zip(blocks, marks)]
    page.blocks = [(path, noise, place, text) for (path, noise, _, text), place in zip(found, _places(found))]
    return page


def _parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, copy (a hash of what may be its main text), blocks and branches of every page.

    A branch has path, look, content (hashes of its children and of its text) and bare, whether
    all of its text is noise by name or outside of the article.
    """
    block = pa.struct([("path", pa.string()), ("noise", pa.bool_()), ("place", pa.int32()), ("text", pa.string())])
    branch = pa.struct([("path", pa.string()), ("look", pa.int64()), ("content", pa.int64()), ("bare", pa.bool_())])
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("copy", pa.int64()), ("blocks", pa.list_(block)), ("branches", pa.list_(branch))])

    def hashed(parts) -> int:
        return xxhash.xxh64_intdigest("\0".join(parts)) - (1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(column.to_pylist() for column in batch.columns)):
                page = read_page(html)
                content: dict[str, list[str]] = {}
                for path, _, _, text in page.blocks:
                    content.setdefault(path, []).append(text)
                paths = page.branches.keys() | content.keys()
                clean = {path for path, noise, place, _ in page.blocks if not noise and place != OUTSIDE}
                rows.append(
                    {
                        "page_id": page_id,
                        "url": url,
                        "copy": hashed(text for _, noise, place, text in page.blocks if not noise and place != OUTSIDE),
                        "blocks": [dict(zip(("path", "noise", "place", "text"), b)) for b in page.blocks],
                        "branches": [
                            {"path": p, "look": hashed(page.branches.get(p, [])), "content": hashed(content.get(p, [])), "bare": p not in clean}
                            for p in sorted(paths)
                        ],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema)

    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    blocks = "array<struct<path: string, noise: boolean, place: int, text: string>>"
    branches = "array<struct<path: string, look: long, content: long, bare: boolean>>"
    parsed = rows.mapInArrow(run, f"page_id long, url string, copy long, blocks {blocks}, branches {branches}")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return parsed.withColumn("host", host)


def _shown(parsed: DataFrame) -> DataFrame:
    """host, path, look, content, bare: what each branch shows on every host's different pages."""
    rows = parsed.select("host", "copy", F.explode("branches").alias("b")).select("host", "copy", "b.*")
    one = F.min(F.struct("look", "content", "bare")).alias("b")  # copies may differ in noise
    return rows.groupBy("host", "copy", "path").agg(one).select("host", "path", "b.*")


def _and_above(path: str) -> Column:
    """A path and all paths above it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def style_tree(parsed: DataFrame) -> DataFrame:
    """host, path, pages, importance: the merged trees of every host's different pages.

    Pages of a host with the same text, noise and what is outside the article left out, count once. The entropy of what a branch shows, over
    the m pages that have it, divided by log m, is the importance of its content; that of the
    sequences of its children is the importance of its look. A branch weighs its own look
    little and the larger part by its content and the most important branch below it. A
    branch of one page has importance 1.
    """
    seen = _shown(parsed)

    def entropy(kind: str) -> DataFrame:
        counts = seen.groupBy("host", "path", kind).agg(F.count("*").alias("n"))
        sums = counts.groupBy("host", "path").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
        spread = F.when(F.col("pages") > 1, 1 - F.col("nlogn") / (F.col("pages") * F.log("pages"))).otherwise(1.0)
        return sums.select("host", "path", "pages", spread.alias(kind))

    nodes = entropy("content").join(entropy("look").drop("pages"), ["host", "path"])
    # Every branch also tells each branch above it how important it is.
    below = nodes.select("host", F.explode(_and_above("path")).alias("path"), "content").groupBy("host", "path").agg(F.max("content").alias("below"))
    importance = DEPTH_WEIGHT * F.col("below") + (1 - DEPTH_WEIGHT) * F.col("look")
    return nodes.join(below, ["host", "path"]).select("host", "path", "pages", importance.alias("importance"))


def recurring(spark: SparkSession, parsed: DataFrame) -> DataFrame:
    """host, path, content, importance, own: what branches of low importance show again and again.

    These are contents that PAGES different pages of a host have on a branch that is of low
    importance itself or hangs on one; importance is the lowest of these. own tells whether
    PAGES pages have something of their own there, shown on fewer pages than that: then the
    branch carries texts of the site, and what recurs may be one of them, copied often.
    """
    low = style_tree(parsed).where((F.col("pages") >= PAGES) & (F.col("importance") < LOW))
    low = stored(spark, low.select("host", F.col("path").alias("root"), "importance"), "low")
    low = F.broadcast(low) if low.count() <= BROADCAST_ROWS else low
    counts = _shown(parsed).groupBy("host", "path", "content").agg(F.count("*").alias("n"), F.min("bare").alias("bare"))
    paths = counts.groupBy("host", "path").agg((F.sum(F.when(F.col("n") < PAGES, F.col("n")).otherwise(0)) >= PAGES).alias("own"))
    paths = paths.select("*", F.explode(_and_above("path")).alias("root")).join(low, ["host", "root"])
    paths = paths.groupBy("host", "path").agg(F.min("importance").alias("importance"), F.first("own").alias("own"))
    paths = stored(spark, paths, "paths")
    paths = F.broadcast(paths) if paths.count() <= BROADCAST_ROWS else paths
    return counts.where((F.col("n") >= PAGES) & ~F.col("bare")).join(paths, ["host", "path"]).drop("n", "bare")


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The main text of every page of pages (page_id, url, html).

    Branches that HTML or their class, id or role name as menu, header, footer, sidebar,
    notice, advert, form or comments are noise; a name counts as a whole, never on html, body,
    main and article, and not where it would hide the article a page marks or all it says. A
    form round over half of the page is none. So is what a page shows on a branch whose
    importance in the style tree of its host is low, if other pages of the host show the same
    there; what only this page shows stays. Where a branch carries texts of the site, what
    recurs and is over half of a page's text is an article copied often, and stays. If a page
    marks its article, only that is taken: all outermost marked elements, or if a main holds the
    most of their text, the main ones. In the innermost marked element that holds half of this, branches
    are noise only at very low importance. A page of which nothing would remain keeps all that is not noise by name.
    White space within a block becomes one space, blocks are joined by a line feed in page order.

    Returns page_id, url, text and n_chars (code points), a row for each row of pages. Null
    and empty html give an empty text. Pages without a url form one site. Whole pages count,
    repeated ones once in the tree.
    """
    parsed = stored(spark, _parsed(pages), "parsed")
    noise = stored(spark, recurring(spark, parsed), "noise")
    by_path = noise.groupBy("host", "path").agg(
        (F.min("importance") < LOW_MAIN).alias("very_low"), F.first("own").alias("own"), F.collect_list("content").alias("contents")
    )
    by_host = by_path.groupBy("host").agg(F.collect_list(F.struct("path", "very_low", "own", "contents")).alias("low"))
    by_host = F.broadcast(by_host) if noise.count() <= BROADCAST_ROWS else by_host
    joined = parsed.join(by_host, "host", "left")
    candidates = F.filter("blocks", lambda b: ~b["noise"] & (b["place"] != OUTSIDE))
    joined = joined.withColumn("candidates", candidates)

    def shown(low: Column) -> Column:
        return F.exists("branches", lambda b: (b["path"] == low["path"]) & F.array_contains(low["contents"], b["content"]))

    bad = F.transform(F.filter("low", shown), lambda low: F.struct(low["path"], low["very_low"], low["own"]))
    joined = joined.withColumn("bad", F.coalesce(bad, F.array().cast("array<struct<path: string, very_low: boolean, own: boolean>>")))

    def on(block: Column, *own: bool) -> Column:
        def counts(low: Column) -> Column:
            return (low["path"] == block["path"]) & low["own"].isin(*own) & ((block["place"] == JUDGED) | low["very_low"])

        return F.exists("bad", counts)

    def chars(blocks: Column) -> Column:
        return F.aggregate(blocks, F.lit(0), lambda n, b: n + F.char_length(b["text"]))

    copied = 2 * chars(F.filter("candidates", lambda b: on(b, True))) > chars(F.col("candidates"))
    joined = joined.withColumn("copied", copied)
    good = F.filter("candidates", lambda b: ~on(b, False) & (F.col("copied") | ~on(b, True)))
    joined = joined.withColumn("good", good)
    chosen = F.when(F.size("good") == 0, F.col("candidates")).otherwise(F.col("good"))
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
