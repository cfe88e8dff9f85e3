"""Main text of web pages by paths that a host's pages agree on.

Each page scores its containers.  Scores are votes for the containers' generalised paths of tags and classes, added
up per host by Spark.  Pages are then read again and the text is taken from the one of their paths that most of the
pages with that path agree on.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from kindred.llm.common import slices, store

# a container votes if its score reaches this share of the page's best
VOTING = 0.5
# a path wins if so many pages agree on it (second choices count half), or if it has this share of the votes of the
# host's first path
SUPPORT = 3
WINNING = 0.1
# a page uses a winning path if the container's own score reaches this share of the page's best
TRUSTED = 0.05
# levels and classes of a level that a path spells out; further ones are in it as a hash
DEEPEST = 30
CLASSES = 4
# winners are broadcast up to so many bytes, and joined by salted hosts beyond
BROADCAST_BYTES = 16 << 20
SALTS = 16

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*+)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+'|["'])*+)>""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
RAW = frozenset("script style title textarea noscript iframe noembed noframes template xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr label output meter progress nobr blink".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CANDIDATES = frozenset("body div section article main td center form blockquote".split())
# never part of an article, whatever they hold
OUTSIDE = frozenset("nav footer aside menu dialog button select datalist fieldset svg math canvas object audio video map".split())
# forms and page headers may wrap a whole page
WRAPPERS = frozenset("form header".split())
# name parts of containers that hold no article; the second set may also name a layout around one
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted comment comments disqus respond "
    "reply replies discussion share sharing social related recommended recommendations newsletter subscribe signup "
    "breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr popup modal login footer".split()
)
LAYOUT = frozenset("nav navbar navigation menu sidebar side rail widget widgets header masthead banner notice notices alert toolbar search form topbar".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt", ("dl",)), "dd": ("dt", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("td", ("tr", "table"))}
SAME = {"dd": "dt", "th": "td"}


@dataclass
class Node:
    tag: str
    path: str
    parent: int
    depth: int
    flag: int  # 0: may hold the article, 1: not unless it holds most of the page, 2: never
    good: int = 0  # characters outside links and outside what is flagged
    total: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)  # node, text
    dropped: list[bool] = field(default_factory=list)
    scores: list[tuple[float, int]] = field(default_factory=list)  # score, node; the best first


def _name_parts(value: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())


def _hashed(text: str) -> str:
    return "~" + xxhash.xxh64_hexdigest(text.encode())


def _below(above: Node, name: str) -> str:
    """The path of a container inside another; the levels below the deepest that is spelled out are one hash."""
    path = f"{above.path}>{name}"
    if above.depth < DEEPEST:
        return path
    stem = above.path if above.depth == DEEPEST else above.path.rpartition(">")[0]
    return f"{stem}>{_hashed(path)}"


def _describe(tag: str, attributes: str) -> tuple[str, int]:
    """The tag with its generalised classes, and whether it can be part of an article."""
    flag = 2 if tag in OUTSIDE else 1 if tag in WRAPPERS else 0
    classes: list[str] = []
    if attributes and not attributes.isspace():
        for found in ATTRIBUTE.finditer(attributes):
            name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if name == "class":
                classes = sorted(set(re.sub(r"\d+", "#", c.lower()) for c in value.split()))
                if len(classes) > CLASSES:
                    classes[CLASSES:] = [_hashed(" ".join(classes[CLASSES:]))]
            if name in ("class", "id"):
                for word in value.split():
                    parts = _name_parts(word)
                    if parts and parts[0] in ("with", "has", "no", "without"):
                        continue
                    if not BOILERPLATE.isdisjoint(parts):
                        flag = 2
                    elif not LAYOUT.isdisjoint(parts):
                        flag = max(flag, 1)
            elif name == "role" and value.lower() in ROLES:
                flag = max(flag, 1)
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
                flag = 2
    return ".".join([tag, *classes]), flag


def parse(html: str) -> Page:
    """Blocks of text in page order, and the containers around them.

    Inline tags only mark text; tags that are never closed, or closed twice, end with what is around them.  Takes time
    in proportion to the page, however its tags are nested or broken: where each tag is open is known without a search.
    """
    page = Page()
    nodes, blocks = page.nodes, page.blocks
    nodes.append(Node("html", "", -1, 0, 0))
    stack = [0]
    # places in the stack of each open tag
    opened: defaultdict[str, list[int]] = defaultdict(list)

    def close(tag: str) -> None:
        """Close the innermost open ``tag``, and with it what is open inside."""
        first = opened[tag][-1]
        while len(stack) > first:
            opened[nodes[stack.pop()].tag].pop()

    text: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(unescape("".join(text)).split())
            if whole:
                node = stack[-1]
                blocks.append((node, whole))
                size = len(whole)
                nodes[node].total += size
                nodes[node].good += max(0, size - linked)
            text.clear()
        linked = 0

    at, lower = 0, None
    while True:
        found = TOKEN.search(html, at)
        piece = html[at : found.start()] if found else html[at:]
        if piece:
            text.append(piece)
            if links:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        if not found[2]:  # a comment or declaration
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if tag in RAW:
            if not closing:
                lower = lower or html.lower()
                # letters that change their length in lower case would shift places
                end = lower.find(f"</{tag}", at) if len(lower) == len(html) else re.compile(f"</{tag}", re.IGNORECASE).search(html, at)
                end = end if isinstance(end, int) else end.start() if end else -1
                at = len(html) if end < 0 else end
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        if tag == "br":
            text.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        links = 0
        if closing:
            known = SAME.get(tag, tag)
            if opened[known]:
                close(known)
            continue
        if nodes[stack[-1]].tag == "p":
            close("p")
        if tag in CLOSES:
            same, fence = CLOSES[tag]
            if opened[same] and opened[same][-1] > max((opened[f][-1] for f in fence if opened[f]), default=0):
                close(same)
        if found[3].endswith("/") and tag not in CANDIDATES:
            continue
        above = stack[-1]
        name, flag = _describe(tag, found[3])
        path = name if tag == "body" or not nodes[above].path else _below(nodes[above], name)
        nodes.append(Node(SAME.get(tag, tag), path, above, nodes[above].depth + 1, flag))
        opened[nodes[-1].tag].append(len(stack))
        stack.append(len(nodes) - 1)
    flush()
    _score(page)
    return page


def _score(page: Page) -> None:
    """Which nodes are dropped, and scores of those that may hold the article: its share of the page's text, squared,
    times the share of such text in it.  Of equal containers the innermost is first."""
    nodes = page.nodes
    for node in reversed(nodes[1:]):
        nodes[node.parent].total += node.total
    whole = nodes[0].total
    page.dropped = [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        article_header = node.tag == "header" and any(t in nodes[node.parent].path.split(">")[-1].split(".")[0] for t in ("article", "main"))
        page.dropped[i] = page.dropped[node.parent] or node.flag == 2 or node.flag == 1 and node.total < 0.6 * whole and not article_header
    for i in range(len(nodes) - 1, 0, -1):
        if page.dropped[i]:
            nodes[i].good = 0
        nodes[nodes[i].parent].good += nodes[i].good
    everything = nodes[0].good
    if not everything:
        return
    found = []
    for i, node in enumerate(nodes):
        if node.good and (i == 0 or node.tag in CANDIDATES) and not page.dropped[i]:
            found.append((round((node.good / everything) ** 2 * node.good / node.total, 6), node.depth, -i))
    page.scores = [(score, -i) for score, _, i in sorted(found, reverse=True)]


def votes(page: Page, voting: float = VOTING) -> Iterator[tuple[str, float]]:
    """(path, weight) of the page's good containers, the best with its score, others with half of theirs; each path once."""
    seen: set[str] = set()
    for score, node in page.scores:
        if score < voting * page.scores[0][0]:
            break
        path = page.nodes[node].path
        if path not in seen:
            yield path, score / 2 if seen else score
            seen.add(path)


def trusted_paths(page: Page, trusted: float = TRUSTED) -> set[str]:
    """Paths of the page's containers whose score reaches a share of its best."""
    return {page.nodes[node].path for score, node in page.scores if score >= trusted * page.scores[0][0]}


def extract(page: Page, winners: list[str] | None, trusted: float = TRUSTED) -> str:
    """The blocks inside the containers of the first winning path that the page has, else of its own best container."""
    if not page.scores:
        return ""
    best = page.scores[0]
    chosen = {best[1]}
    own: dict[str, list[tuple[float, int]]] = defaultdict(list)
    for score, node in page.scores:
        own[page.nodes[node].path].append((score, node))
    for path in winners or ():
        if path in own and max(s for s, _ in own[path]) >= trusted * best[0]:
            chosen = {node for _, node in own[path]}
            break
    inside = [False] * len(page.nodes)
    for i, node in enumerate(page.nodes):
        inside[i] = i in chosen or i > 0 and inside[node.parent]
    return "\n\n".join(text for node, text in page.blocks if inside[node] and not page.dropped[node])


def host(url: str = "url") -> Column:
    """The host of an address in lower case, without user and port; empty if there is none."""
    whole = F.regexp_extract(F.lower(F.coalesce(F.col(url).cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#\\]*)", 1)
    return F.regexp_replace(F.regexp_replace(whole, r"^.*@", ""), r":\d*$", "")


def _order() -> Column:
    """Winning paths with support by their share of the pages that have them, then others by votes."""
    supported = F.col("wins") >= SUPPORT
    share = F.when(supported, F.round(-F.col("wins") / F.col("n"), 6)).otherwise(-F.col("votes"))
    return F.struct((~supported).alias("weak"), share.alias("share"), (-F.col("votes")).alias("votes"), (-F.length("path")).alias("length"), F.col("path"))


def path_votes(pages: DataFrame, voting: float = VOTING, winning: float = WINNING) -> DataFrame:
    """(host, path, order): every path with enough support on its host, for all hosts of (host, html).

    Votes are added up in tasks before they are shuffled, and no group holds the paths of a host, so a host with very
    many pages or paths is no more work than others.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: defaultdict[tuple[str, str], list[float]] = defaultdict(lambda: [0.0, 0.0, 0])

        def rows() -> pa.RecordBatch:
            keys = list(sums)
            columns = [pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.string())]
            columns += [pa.array([sums[k][i] for k in keys], kind) for i, kind in enumerate((pa.float64(), pa.float64(), pa.int64()))]
            sums.clear()
            return pa.RecordBatch.from_arrays(columns, names=["host", "path", "votes", "wins", "n"])

        for batch in batches:
            for part in slices(batch, "html"):
                for name, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    page = parse(html or "")
                    for path in {page.nodes[node].path for _, node in page.scores}:
                        sums[name, path][2] += 1
                    for i, (path, weight) in enumerate(votes(page, voting)):
                        own = sums[name, path]
                        own[0] += weight
                        own[1] += 0.5 if i else 1
                    if len(sums) > 50_000:
                        yield rows()
        yield rows()

    counted = pages.where("host <> ''").select("host", "html").mapInArrow(run, "host string, path string, votes double, wins double, n long")
    # votes are rounded, so that the order in which they were added does not decide
    sums = [F.round(F.sum("votes"), 3).alias("votes"), F.sum("wins").alias("wins"), F.sum("n").alias("n")]
    total, _ = store(counted.groupBy("host", "path").agg(*sums).where("wins > 0"), "path-votes")
    tops = total.groupBy("host").agg(F.max("votes").alias("top")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = total.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).join(tops, ["host", "salt"])
    return salted.where((F.col("wins") >= SUPPORT) | (F.col("votes") >= F.col("top") * winning)).select("host", "path", _order().alias("order"))


def _chosen(rows: DataFrame, winners: DataFrame, trusted: float = TRUSTED) -> DataFrame:
    """``rows`` with the first winning path that each page has, by joins per host and path."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                out: list[tuple] = []
                columns = [part.column(c).to_pylist() for c in ("host", "key", "check", "html")]
                for name, key, check, html in zip(*columns, strict=True):
                    page = parse(html or "")
                    out += [(name, key, check, path) for path in trusted_paths(page, trusted)]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["host", "key", "check", "path"])

    keyed = rows.withColumns({"key": F.xxhash64("html"), "check": F.xxhash64(F.lit(1), "html")})
    has = keyed.where("host <> ''").select("host", "key", "check", "html").mapInArrow(run, "host string, key long, check long, path string")
    salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = has.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")).join(salted, ["host", "path", "salt"])
    first = met.groupBy("host", "key", "check").agg(F.min("order")["path"].alias("winner"))
    return keyed.join(first, ["host", "key", "check"], "left")


def extract_pages(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of (page_id, url, html).

    ``text`` is the main text: blocks joined by an empty line, empty if there is none (also for a null or empty page).
    Pages without a host (null or malformed url) use their own best container.  Equal rows give equal rows; other
    columns are ignored; no rows in, no rows out.  Pages of any length are read whole, in time in proportion to it.
    """
    rows = pages.select("page_id", "url", pages["html"].cast("string"), host().alias("host"))
    winners, _ = store(path_votes(rows), "host-paths")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).first()[0] or 0
    known = None
    if size <= broadcast_bytes:
        ranks: defaultdict[str, dict[str, tuple]] = defaultdict(dict)
        for name, path, order in winners.select("host", "path", "order").collect():
            ranks[name][path] = tuple(order)
        known = pages.sparkSession.sparkContext.broadcast(dict(ranks))
        joined = rows.withColumn("winner", F.lit(None).cast("string"))
    else:
        joined = _chosen(rows, winners)
    cut = joined.select("page_id", "url", "html", "host", "winner")

    def text(html: str | None, name: str, winner: str | None) -> str:
        page = parse(html or "")
        if known is None:
            return extract(page, [winner] if winner is not None else None)
        own = known.value.get(name, {})
        orders = [own[p] for p in trusted_paths(page) if p in own]
        return extract(page, [min(orders)[-1]] if orders else None)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [text(*x) for x in zip(*(part.column(c).to_pylist() for c in ("html", "host", "winner")), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}
    return cut.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
