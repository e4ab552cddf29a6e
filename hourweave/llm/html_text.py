"""Main text of web pages by consensus container paths.

1. One pass scores each page's containers: the text of a paragraph counts for its parent and half for its grandparent,
   less the share of it that is links, more for containers named as content. The page votes for the generalised path
   (tags and classes without digits) of its best container, with its share of the page's score.
2. Spark adds up the votes by host and path; the path with most votes wins its host.
3. A second pass extracts the text of every container on the winning path, in page order; a page that has none on it
   falls back to its own best container.

Inside a container, menus, sidebars, footers, forms, scripts, styles, adverts, notices and reader comments are left
out by tag, role, class or id. Each class and the id is judged by itself: a bad word wins over a good one beside it
("article-comments", "content-sidebar"), except in names that state or sort something ("has-sidebar", "comments-open",
"tag-cookies", but not "category-menu"), that wrap article and sidebar ("content-sidebar-wrap"), or that name an article
by its subject ("cookie-story"). What is left out is also judged by its share of the page: an element named so stays if
it holds most of the page's text and with it all its h1 or, without any, its only article; a part by its tag only if
nothing would be left without it (a form or "sidebar-right-layout" around the whole page). References are decoded once, white space in a block becomes one space, blocks are joined by
one space.

Defined results: null and empty pages give the empty text; pages without markup are one block; unclosed and crossed
tags are closed as browsers do for paragraphs, list items and table cells; a `<` that no `>` follows is text, and after a
quote that is never closed tags end at their first `>`, so the scan is linear in any input; urls without a host share one; repeated
rows give equal results, equal votes are decided by the larger path; an empty table gives none; all columns of the
input are kept, the text goes under a new name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourweave.llm.common import col, fresh, ship_package, slices, texts
from hourweave.session import materialise

#: Hosts whose winners are sent to all tasks, at most some 100 bytes each; more are joined by a shuffle.
BROADCAST_HOSTS = 100_000
#: Steps of a path that are kept, counted from the container upwards.
PATH_STEPS = 12

_OPENING = re.compile(r"<(?=[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile("[>\"']")
_COMMENT_END = re.compile("--!?>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.S)
_DIGITS = re.compile(r"\d+")

# HTML's element names by role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_CONTAINER = frozenset("article main section div td body blockquote center dd details form aside footer header nav ul ol li table fieldset figure".split())
_DROPPED = frozenset(
    "script style noscript template svg math iframe object embed head title button select textarea input dialog canvas audio video noembed noframes xmp".split())
_DOUBTED = frozenset("nav menu footer aside form".split())
#: Elements that are parts of a page by their tag: only an otherwise empty page is taken from them.
_PLAIN_PART = frozenset("nav menu footer aside header".split())
#: A start tag in the key closes an open element of the value, unless one of _SCOPE lies between.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("html body table ul ol dl article section main div aside nav footer header form blockquote".split())
_CLOSE_P = _BLOCK - {"br", "option", "html", "head", "body", "tbody", "td", "tfoot", "th", "thead", "tr", "caption", "legend", "summary"}

_BAD_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_BAD_WORD = frozenset(
    "nav navbar navigation menu sidebar aside footer ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner comment comments "
    "respond disqus replies cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup share sharing social related "
    "breadcrumb breadcrumbs pagination pager widget login masthead toolbar skip disclaimer copyright".split())
#: Bad words written together, as one word of a name.
_JOINED = re.compile(
    "(?:left|right|top|sub|main|side|bottom|foot|site|mega|user|mobile|page|primary|secondary)(?:nav|menu|navbar|menubar)|comments?(?:list|form|area|section|box|block|thread)"
    "|cookies?(?:bar|banner|notice|consent|law|box|popup)|adsbygoogle|(?:top|side|bottom|banner)?ad(?:box|slot|unit|banner|wrapper|container)|(?:left|right)sidebar|sidenote"
    "|related(?:posts|links|articles)|share(?:bar|buttons)|social(?:bar|links|icons)|newsletterbox|sitefooter|pagefooter")
_GOOD_WORD = frozenset("article content post entry story main body text".split())
#: Bad words that are harmless before one of _ITEM, where they say what the article is about.
_SUBJECT = frozenset("notice notices alert cookie cookies consent gdpr disclaimer copyright login promotion".split())
_ITEM = frozenset("article entry post story".split())
#: First and last words of names that state what a page has or sort it under something, and last words of frames.
_STATES = frozenset("has have no not with without is".split())
_SORTS = frozenset("category cat tag type status format topic".split())
#: Last words that name a part of the page whatever stands before them, but for _STATES.
_PART = frozenset("nav navbar navigation menu advert adverts ad ads advertisement advertising sidebar related".split())
_STATED = frozenset("open closed enabled disabled".split())
_FRAME = frozenset("wrap wrapper container layout grid row".split())
_BESIDE = frozenset("sidebar aside".split())
_WORDS = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Node:
    """An element. `drop` leaves it out for good; `doubt` does so unless its share of the page speaks against it."""

    __slots__ = ("tag", "label", "parent", "drop", "doubt", "bad", "score", "in_article", "block", "container", "held", "heads", "articles", "paragraphs")

    def __init__(self, tag: str, label: str, parent: "_Node | None", drop: bool, doubt: bool):
        self.tag, self.label, self.parent = tag, label, parent
        self.drop = drop or (parent is not None and parent.drop)
        self.doubt = doubt
        self.bad = self.drop or doubt or (parent is not None and parent.bad)
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        self.block: _Node = self if tag in _BLOCK or parent is None else parent.block
        self.container: _Node = self if tag in _CONTAINER or parent is None else parent.container
        self.score = 0.0
        self.held = self.heads = self.articles = self.paragraphs = 0

    def path(self) -> str:
        steps, node = [], self
        while node is not None and len(steps) < PATH_STEPS:
            steps.append(node.label)
            node = node.parent
        return ">".join(reversed(steps))


def _bad_name(name: str) -> bool:
    """Whether a class or an id names something that is left out."""
    words = _WORDS.findall(_HUMP.sub(" ", name).lower())
    bad = {w for w in words if w in _BAD_WORD or _JOINED.fullmatch(w)}
    if not bad or len(words) > 1 and (words[0] in _STATES or words[-1] in _STATED):
        return False
    if len(words) > 1 and words[0] in _SORTS and words[-1] not in _PART:
        return False
    if bad <= _SUBJECT and words[-1] in _ITEM:
        return False
    return not (bad <= _BESIDE and words[-1] in _FRAME and _GOOD_WORD.intersection(words))


def _node(tag: str, attributes: str, parent: _Node) -> _Node:
    found = {}
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), value[1:-1] if value[:1] in "\"'" and value[:1] else value)
    names = unescape(found.get("class", ""))
    marks = [*names.split(), *unescape(found.get("id", "")).split()]
    drop = tag in _DROPPED or "hidden" in found or found.get("aria-hidden") == "true"
    doubt = tag in _DOUBTED or found.get("role", "").lower() in _BAD_ROLE or tag == "header" and not parent.in_article
    doubt = doubt or tag not in ("html", "body", "article", "main") and any(map(_bad_name, marks))
    label = tag + "".join(sorted("." + c for c in set(_DIGITS.sub("", names).lower().split()) if c))
    node = _Node(tag, label, parent, drop, doubt)
    if tag in ("article", "main") or marks and _GOOD_WORD.intersection(_WORDS.findall(_HUMP.sub(" ", " ".join(marks)).lower())):
        node.score = 25.0
    return node


class _Tags:
    """Ends of tags, each character looked at a fixed number of times."""

    def __init__(self, html: str) -> None:
        self.html, self.last, self.plain = html, html.rfind(">"), False

    def end(self, start: int) -> int:
        """The place of the `>` of the tag that begins at `start`, -1 if it has none."""
        if start > self.last:
            return -1
        at = start
        while not self.plain:
            m = _QUOTE_OR_END.search(self.html, at)
            if m is not None and m[0] == ">":
                return m.start()
            # a quote that is not closed: from here on quotes mean nothing
            at = -1 if m is None else self.html.find(m[0], m.end()) + 1
            self.plain = at <= 0
        return self.html.find(">", start)


def parse(html: str) -> list[tuple[_Node, str, int]]:
    """Blocks in page order: the element they stand in, their text and how much of it is links. Left-out parts are not in it."""
    blocks: list[tuple[_Node, str, int]] = []
    root = _Node("", "", None, False, False)
    nodes, stack = [root], [root]
    open_tags: Counter[str] = Counter()
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            value = " ".join("".join(text).split())
            if value:
                blocks.append((stack[-1].block, value, min(linked, len(value))))
            text.clear()
        linked = 0

    def add(value: str) -> None:
        nonlocal linked
        if value and not stack[-1].drop:
            value = unescape(value)
            text.append(value)
            if open_tags["a"]:
                linked += len(value)

    def pop_to(index: int) -> None:
        open_tags.subtract(x.tag for x in stack[index:])
        del stack[index:]

    tags = _Tags(html)
    at = 0
    size = len(html)
    while at < size:
        m = _OPENING.search(html, at)
        if m is None:
            add(html[at:])
            break
        start = m.start()
        add(html[at:start])
        if html.startswith("<!--", start):
            m = _COMMENT_END.search(html, start + 4)
            at = m.end() if m else size
            continue
        if html[start + 1] in "!?":
            end = html.find(">", start)
            at = end + 1 if end >= 0 else size
            continue
        end = tags.end(start)
        if end < 0:
            add(html[start:])
            break
        at = end + 1
        m = _NAME.match(html, start + 1, end)
        tag, attributes = m[2].lower(), html[m.end() : end]
        block = tag in _BLOCK
        if block:
            flush()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if open_tags[tag] > 0 else ():
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if not block and stack[i].tag in _BLOCK or tag in ("p", "li") and stack[i].tag in _SCOPE:
                    break
            continue
        if tag in _CLOSE_P or tag in _CLOSES:
            ends = _CLOSES.get(tag, frozenset()) | {"p"}
            for i in range(len(stack) - 1, 0, -1) if any(open_tags[x] > 0 for x in ends) else ():
                if stack[i].tag in ends:
                    pop_to(i)
                    break
                if stack[i].tag in _SCOPE:
                    break
        if tag in _RAW:
            end = _raw_end(tag).search(html, at)
            at = end.end() if end else size
            continue
        if tag in _VOID or attributes.endswith("/") and not block:
            continue
        node = _node(tag, attributes, stack[-1])
        nodes.append(node)
        stack.append(node)
        open_tags[tag] += 1
    flush()
    _decide(nodes, blocks)
    return [b for b in blocks if not b[0].bad]


@lru_cache(None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I)


def _decide(nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> None:
    """Settle the doubts: an element stays if it holds what the page is about."""
    if not any(n.doubt and not n.drop for n in nodes):
        return
    for node, value, linked in blocks:
        node.held += len(value) - linked
    for node in reversed(nodes):  # children come after their parents
        node.heads += node.tag == "h1"
        node.articles += node.tag in ("article", "main")
        node.paragraphs += node.tag == "p"
        if node.parent is not None:
            up = node.parent
            up.held, up.heads, up.articles, up.paragraphs = up.held + node.held, up.heads + node.heads, up.articles + node.articles, up.paragraphs + node.paragraphs
    page = nodes[0]
    left = sum(len(value) - linked for node, value, linked in blocks if not node.bad)
    for node in nodes[1:]:
        if node.doubt and not node.drop and not node.parent.bad:
            most = 2 * node.held > page.held
            whole = node.heads == page.heads if page.heads else node.articles == page.articles == 1
            about = node.heads or node.articles or node.tag == "form" and node.paragraphs
            if most and (about and not left or whole and node.tag not in _PLAIN_PART):
                node.doubt = False
        node.bad = node.drop or node.doubt or node.parent.bad


def score(blocks: list[tuple[_Node, str, int]]) -> list[_Node]:
    """Containers with a score, best first."""
    seen: dict[int, _Node] = {}
    for node, value, linked in blocks:
        holder = node.container
        worth = len(value) * (1 - linked / max(1, len(value))) * (1.25 if len(value) > 80 else 0.5)
        for share in (1.0, 0.5):
            if holder is None:
                break
            seen[id(holder)] = holder
            holder.score += share * worth
            holder = holder.parent.container if holder.parent is not None else None
    return sorted(seen.values(), key=lambda n: (-n.score, n.path()))


def vote(html: str) -> tuple[str, float] | None:
    ranked = score(parse(html))
    total = sum(max(0.0, n.score) for n in ranked)
    return (ranked[0].path(), ranked[0].score / total) if total > 0 else None


def main_text(html: str, path: str | None) -> str:
    """The text on the path, or of the page's best container."""
    blocks = parse(html)

    def below(is_top: Callable[[_Node], bool]) -> list[str]:
        """Texts of the blocks with such an element at or above them; each element is asked once."""
        known: dict[int, bool] = {}
        out = []
        for node, value, _ in blocks:
            way = []
            while node is not None and id(node) not in known and not is_top(node):
                way.append(node)
                node = node.parent
            found = node is not None and known.get(id(node), True)
            known.update((id(x), found) for x in way)
            if found:
                out.append(value)
        return out

    if path is not None:
        last = path.rpartition(">")[2]
        # label first: building a path costs more
        if found := below(lambda node: node.label == last and node.path() == path):
            return " ".join(found)
    ranked = score(blocks)
    return " ".join(below(lambda node: node is ranked[0])) if ranked else ""


def host(url: Column) -> Column:
    """The lower-cased host, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`host, path`: the winners, stored."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            found = [(h, v) for h, v in zip(part.column(0).to_pylist(), map(vote, texts(part.column(1)))) if v]
            yield pa.record_batch({
                "host": pa.array([h for h, _ in found], pa.string()), "path": pa.array([v[0] for _, v in found], pa.string()),
                "vote": pa.array([v[1] for _, v in found], pa.float64())})

    ship_package(pages.sparkSession)
    votes = pages.select(host(col(url)).alias("host"), col(html).cast("string").alias("html")).mapInArrow(run, "host string, path string, vote double")
    # votes in millionths, so the order of addition cannot change a sum
    summed = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("vote") * 1_000_000).cast("long")).alias("votes"))
    return materialise(summed.groupBy("host").agg(F.max(F.struct("votes", "path"))["path"].alias("path")), "host-paths")


def extract_text(pages: DataFrame, url: str = "url", html: str = "html", name: str = "text") -> DataFrame:
    """`pages` with the main text under `name`."""
    spark = pages.sparkSession
    ship_package(spark)
    paths = host_paths(pages, url, html)
    of, path, whole = (fresh(x, [*pages.columns, name]) for x in ("page__host", "host__path", "page__html"))
    paths = paths.toDF(of + "_", path)
    few = paths.count() <= BROADCAST_HOSTS
    rows = pages.withColumns({of: host(col(url)), whole: col(html).cast("string")})
    rows = rows.join(F.broadcast(paths) if few else paths, col(of) == col(of + "_"), "left").drop(of, of + "_")
    rows = rows.select(*[col(c) for c in pages.columns], col(whole), col(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            n = part.num_columns
            found = [main_text(h, p) for h, p in zip(texts(part.column(n - 2)), part.column(n - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*part.columns[: n - 2], pa.array(found, pa.string())], schema=pa.schema([*list(part.schema)[: n - 2], pa.field(name, pa.string())]))

    return rows.mapInArrow(run, pages.withColumn(name, F.lit("")).schema)
