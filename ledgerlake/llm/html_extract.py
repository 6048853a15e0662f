"""Main text of web pages by consensus host paths.

Pages of one host share templates. Every page scores its containers by the text of their paragraphs less that
of links, and votes with each container's share of the page for its generalised path: tags and classes from
the body down, digits replaced. Votes are summed per host in Spark with partial aggregates, and the text is
then taken from the containers on the winning path. A page without that path, or without nearly all of its main
text under it, uses its own best container; where that shares no text with the path, half as much under the path will do.
Containers are lifted to the smallest one around them that holds all text of their main, article or outermost container.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out by
tag, role and by words of class and id. An element that is only a form or has such a word stays if it wraps the page's main
text (``wrappers``), and words in names of a state or layout ("has-sidebar") don't count. Both passes parse a page in one scan by a regular expression.

Edge cases: a null or empty page has empty text; a page without any container takes the whole body; unclosed
elements end with their parent, stray end tags are ignored; a comment or script that never ends takes the rest of
the page; a null url is a host of its own; rows that repeat a page_id are pages of their own; an empty
table gives no row; pages of any length are read whole; extra columns are
carried along.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import store

NEARLY_ALL = 0.9  # of its own main text that a page must have on the winning path
APART = 0.5  # the same, where the page's best container shares no text with that path
LINKED = 0.5  # a block with more link text than that doesn't lift a container

_RAW = "script|style|noscript|template|svg|textarea|iframe|math|object|canvas|title"
_SCAN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
BLOCK_IN_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                       "nav ol p pre section table ul".split())
CONTAINERS = frozenset("article body div main section td".split())
NOISE_TAGS = frozenset("aside button dialog footer head header input menu nav option select".split())
SOFT_NOISE_TAGS = frozenset("fieldset form".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
NOISE_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice pager pagination "
    "popup promo promotion promoted recommended related replies respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split())
OUTSIDE_NOISE_WORDS = frozenset("header topbar".split())
GOOD_WORDS = frozenset("article body content entry main post story text".split())
# Names that only tell a state or layout of the element: no-sidebar, with-ads, comments-open.
_STATE = re.compile(r"(?:has|have|is|no|not|with|without|show|hide)[-_].*|.*[-_](?:open|opened|closed|enabled|disabled|on|off)", re.I)
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MOST = 0.5  # of the page's text that a wrapper holds
KEPT_TAGS = frozenset("article body html main".split())
SELF_CLOSING = {"li": ("li", ("ul", "ol", "menu")), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")),
                "tr": ("tr", ("table",)), "dd": ("dd", ("dl",)), "dt": ("dt", ("dl",)), "option": ("option", ("select",))}


class Node:
    __slots__ = ("parent", "tag", "label", "noise", "soft", "article", "score", "good", "named_good", "comments")

    def __init__(self, parent: Node | None, tag: str, attrs: str):
        self.parent, self.tag, self.score = parent, tag, 0.0
        self.article = (parent is not None and parent.article) or tag == "article"
        self.noise, self.label, self.good = parent is not None and parent.noise, tag, tag in ("article", "main")
        # The nearest element around, itself included, that is noise unless it wraps the main text.
        self.soft = parent.soft if parent is not None else None
        self.named_good = self.comments = False
        if tag in SOFT_NOISE_TAGS:
            self.soft = self
        if tag in NOISE_TAGS and not (tag == "header" and self.article):
            self.noise = True
        if attrs.strip(" /"):
            found = {}
            for name, a, b, c, hidden in _ATTR.findall(attrs):
                found[(name or hidden).lower()] = a or b or c
            classes = found.get("class", "").split()
            words = {w.lower() for w in _WORDS.findall(" ".join(classes) + " " + found.get("id", ""))}
            if classes:
                self.label = tag + "".join(sorted("." + re.sub(r"\d+", "#", c.lower()) for c in classes))
            if tag not in KEPT_TAGS:
                style = found.get("style", "").replace(" ", "").lower()
                if (found.get("role", "").lower() in NOISE_ROLES or "hidden" in found
                        or found.get("aria-hidden") == "true" or "display:none" in style):
                    self.noise = True
                names = [c for c in [*classes, *found.get("id", "").split()] if not _STATE.fullmatch(c)]
                telling = {w.lower() for w in _WORDS.findall(" ".join(names))}
                if telling & NOISE_WORDS or not self.article and telling & OUTSIDE_NOISE_WORDS:
                    self.soft, self.comments = self, bool(telling & COMMENT_WORDS)
            self.named_good = bool(words & GOOD_WORDS) and self.soft is not self
            self.good = self.good or self.named_good

    def path(self) -> str:
        labels, node = [], self
        while node is not None and node.tag != "html":
            labels.append(node.label)
            node = node.parent
        return ">".join(reversed(labels))

    def within(self, others: set[Node]) -> bool:
        node = self
        while node is not None:
            if node in others:
                return True
            node = node.parent
        return False


class _Inside:
    """What an element of possible noise holds: text, text of paragraphs and headings, text of articles and mains in it."""

    __slots__ = ("text", "written", "main", "headed", "articles")

    def __init__(self):
        self.text = self.written = self.main = 0.0
        self.headed, self.articles = False, set()


def wrappers(blocks: list[tuple[Node, str, float]]) -> set[Node]:
    """Possible noise that wraps the page's main text. It holds most of the text, and no article, main, element of a good name
    or text under an h1 stands outside all possible noise. Its share alone never tells: it must have the structure of an article
    (an h1, or most of its text in an article or main; for a form paragraphs will do), or be the only place with text at all.
    Reader comments need that structure in any case, and articles of theirs count only where there is one."""
    total, clean, clean_main, clean_headed = 0.0, 0.0, 0.0, False
    held: dict[Node, _Inside] = {}
    for node, text, linked in blocks:
        worth, heading = len(text) * (1.0 - linked), node.tag in HEADINGS
        total += worth
        seen, main, good, article, headed = node, False, False, None, False
        while seen is not None:
            main, good = main or seen.tag in ("article", "main"), good or seen.named_good
            headed = headed or seen.tag == "h1"
            if seen.tag == "article":
                article = seen
            if seen.soft is seen:
                inside = held.setdefault(seen, _Inside())
                inside.text += worth
                inside.written += worth if heading or seen is not node and node.tag == "p" else 0.0
                inside.main += worth if main else 0.0
                inside.headed = inside.headed or headed
                if article is not None:
                    inside.articles.add(article)
            seen = seen.parent
        if node.soft is None:
            clean += 0.0 if heading else worth
            clean_main += worth if (main or good) and not heading else 0.0
            clean_headed = clean_headed or headed
    if clean_main > 0 or clean_headed and clean > 0:
        return set()

    def wraps(node: Node, inside: _Inside) -> bool:
        if inside.text <= MOST * total:
            return False
        structured = inside.headed or inside.main > MOST * inside.text
        if node.comments:
            return inside.headed or structured and len(inside.articles) <= 1
        if node.tag in SOFT_NOISE_TAGS:
            structured = structured or inside.written > MOST * inside.text
            return structured
        return structured or clean == 0

    return {n for n, inside in held.items() if wraps(n, inside)}


def _is_noise(node: Node, kept: set[Node]) -> bool:
    soft = node.soft
    while soft is not None and soft in kept:
        soft = soft.parent.soft
    return soft is not None


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, float]]]:
    """(containers, blocks): blocks are (element, text, share of link text) in page order, noise left out."""
    root = Node(None, "html", "")
    body = Node(root, "body", "")
    stack, containers = [root, body], [body]
    blocks: list[tuple[Node, str, float]] = []
    parts: list[tuple[str, bool]] = []
    links, at = 0, 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(x for x, _ in parts).split())
            if text:
                linked = sum(len(x) for x, link in parts if link) / max(1, sum(len(x) for x, _ in parts))
                blocks.append((stack[-1], text, linked))
            parts.clear()

    def text(upto: int) -> None:
        if upto > at and not stack[-1].noise:
            raw = page[at:upto]
            parts.append((entities.unescape(raw) if "&" in raw else raw, links > 0))

    def close(tags: tuple[str, ...], stop: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, 1, -1):
            if stack[i].tag in tags:
                flush()
                del stack[i:]
                return
            if stack[i].tag in stop:
                return

    for m in _SCAN.finditer(page):
        text(m.start())
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if m["end"] else 1
            elif tag == "br":
                parts.append((" ", False))
            continue
        links = 0
        if tag in ("html", "body"):
            if not m["end"] and tag == "body":
                flush()
                attrs = Node(root, "body", m["attrs"])
                body.label, body.good = attrs.label, attrs.good
                del stack[2:]
            continue
        if m["end"]:
            close((tag,))
            continue
        flush()
        if tag in BLOCK_IN_P:
            close(("p",), tuple(CONTAINERS))
        if tag in SELF_CLOSING:
            close((SELF_CLOSING[tag][0],), SELF_CLOSING[tag][1])
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        node = Node(stack[-1], tag, m["attrs"])
        stack.append(node)
        if tag in CONTAINERS and not node.noise:
            containers.append(node)
    text(len(page))
    flush()
    kept = wrappers(blocks)
    return [n for n in containers if not _is_noise(n, kept)], [b for b in blocks if not _is_noise(b[0], kept)]


def score(containers: list[Node], blocks: list[tuple[Node, str, float]]) -> None:
    """Text of paragraphs counts in full for the nearest container and by half for each further one."""
    for node, text, linked in blocks:
        worth, share = len(text) * (1.0 - linked), 1.0
        while node is not None:
            if node.tag in CONTAINERS:
                node.score += worth * share
                share /= 2
            node = node.parent
    for node in containers:
        if node.good:
            node.score *= 1.5


def _worth(blocks: list[tuple[Node, str, float]], inside: set[Node]) -> float:
    return sum(len(text) * (1.0 - linked) for node, text, linked in blocks if node.within(inside))


def _top(node: Node) -> Node:
    """The outermost main around, else the nearest article, else the outermost container below the body."""
    main = article = outer = None
    up = node
    while up is not None:
        if up.tag == "main":
            main = up
        if up.tag == "article" and article is None:
            article = up
        if up.tag in CONTAINERS and up.tag != "body":
            outer = up
        up = up.parent
    return main or article or outer or node


def lift(containers: list[Node], blocks: list[tuple[Node, str, float]]) -> dict[Node, Node]:
    """Every container with the smallest one around it that holds all blocks of its ``_top`` that aren't links: headings and
    sections next to the best one stay with it. An article stays whole."""
    held: dict[Node, int] = {}
    for node, _, linked in blocks:
        if linked <= LINKED:
            while node is not None:
                held[node] = held.get(node, 0) + 1
                node = node.parent
    out = {}
    for node in containers:
        top, up = _top(node), node
        while up is not top and (up.tag not in CONTAINERS or held.get(up, 0) < held.get(top, 0)):
            up = up.parent
        out[node] = top if top.tag == "article" else up
    return out


def ranked(page: str) -> tuple[list[Node], list[tuple[Node, str, float]]]:
    """(containers by falling score, blocks)."""
    containers, blocks = parse(page)
    score(containers, blocks)
    lifted = lift(containers, blocks)
    best: dict[Node, float] = {}
    for node in containers:
        if node.score > 0:
            best[lifted[node]] = max(best.get(lifted[node], 0.0), node.score)
    for node, value in best.items():
        node.score = value
    return sorted(best, key=lambda n: -n.score), blocks


def votes(page: str) -> list[tuple[str, float]]:
    found, _ = ranked(page)
    total = sum(n.score for n in found)
    return [(n.path(), n.score / total) for n in found]


def extract(page: str | None, path: str | None) -> str:
    """The page's text under ``path``, or under its best container."""
    if not page:
        return ""
    found, blocks = ranked(page)
    if not found:
        return "\n".join(text for _, text, _ in blocks)
    inside, own = {n for n in found if path is not None and n.path() == path}, {found[0]}
    if inside != own:
        both = any(node.within(inside) and node.within(own) for node, _, _ in blocks)
        if not inside or _worth(blocks, inside) < (NEARLY_ALL if both else APART) * _worth(blocks, own):
            inside = own
    return "\n".join(text for node, text, _ in blocks if node.within(inside))


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, path): the winning path of every host, ties by the larger page count, then by path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[tuple[str, str], list[float]] = {}
            for at, page in batch.itertuples(index=False):
                for path, share in votes(page) if page else ():
                    sums = out.setdefault((at, path), [0.0, 0])
                    sums[0] += share
                    sums[1] += 1
            rows = [(*k, v[0], v[1]) for k, v in out.items()]
            yield pd.DataFrame(rows, columns=["host", "path", "share", "pages"])

    cast = pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html"))
    summed = cast.mapInPandas(run, "host string, path string, share double, pages bigint").groupBy("host", "path").agg(
        F.sum("share").alias("share"), F.sum("pages").alias("pages"))
    # Sums of doubles depend on their order in the last digits; rounding makes reruns agree.
    place = F.struct(F.round("share", 6), F.col("pages"), F.col("path"))
    return summed.groupBy("host").agg(F.max(place).alias("best")).select("host", "best.path")


def extract_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` less the markup, with ``text`` and ``n_chars``."""
    winners = store(host_paths(pages, html, url), "host-paths").select(
        F.col("host").alias("__he_host"), F.col("path").alias("__he_path"))
    joined = pages.withColumn("__he_at", host(F.col(url))).join(winners, F.col("__he_at") == F.col("__he_host"), "left")
    rest = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [extract(page, path) for page, path in zip(batch["__he_html"], batch["__he_path"])]
            batch = batch.drop(columns=["__he_html", "__he_path"])
            yield batch.assign(text=texts, n_chars=[len(t) for t in texts])

    kinds = dict(pages.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in rest] + ["text string", "n_chars bigint"])
    return joined.select(*rest, F.col(html).alias("__he_html"), "__he_path").mapInPandas(run, schema)
