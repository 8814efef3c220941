"""Main text of HTML pages by consensus paths of each host.

Every page's containers are scored by the text they hold outside links and
boilerplate. An element whose class or id names boilerplate is skipped, unless it
holds an article or main with more than the text outside such elements, or, on a
page without article and main outside them, most of the unlinked text (and is no
discussion or consent notice); a page without other text gives theirs. A container is named by its generalised path:
tag and classes of each ancestor, without ids, and with digits in class names as
one ``0``. Pages vote with their containers' scores; Spark sums the votes per host and path, and
the path with the largest sum (at a tie the first in string order) is the
host's, widened to the nearest article or main around it (without one, to what
encloses the containers with high sums) and to its title. A page's text is then taken from the elements at its host's path, or
from its own best container where it has none there.

Elements nested more than ``DEPTH`` deep become children of the one at that
depth, as browsers do, so a page's time and memory grow with its length only;
no text is lost by it.

Null and empty pages have empty text. Null URLs and URLs without ``://`` share
the empty host. Repeated rows vote and are answered each time. Further columns
are carried along; one with the name of a new column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventide.llm.common import materialize, slices, table
from eventide.llm.url_filter import host_and_path

#: Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template head title svg math iframe object canvas audio video map dialog nav aside footer form button select option textarea input label fieldset menu".split())
BLOCK = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CONTAINER = frozenset("article main section div td body".split())
CLOSES_P = BLOCK - {"body", "html"}
SCOPE = frozenset("article section div td th li body main aside nav header footer blockquote table ul ol dl".split())
#: Elements that an opening one of the same list or table ends, and what holds them.
ENDS = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr")}
LISTS = frozenset("ul ol dl table select".split())
#: Words in class, id or role names that mark menus, notices, adverts, comments and the like.
BOILERPLATE = re.compile(
    r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?s?|cookies?|consent|gdpr|notices?|popup|modal|overlay"
    r"|newsletter|subscribe|signup|login|menu|navbar|nav|navigation|breadcrumbs?|sidebar|side-?bar|widget|related|recommended|share|sharing|social|comments?"
    r"|commentlist|disqus|replies|respond|footer|foot|masthead|toolbar|pagination|pager|tags?|search|skip|disclaimer|copyright)(?:[-_ ]|$)", re.I)
#: Names that tell a wrapper's state or an article's tags, not an element's own role.
STATE = re.compile(
    r"(?:has|no|with|without|category|tag(?![-_](?:clouds?|lists?|links?)(?:[-_]|$)))[-_].*|.*[-_](?:open|closed)|search[-_]results?|elementor-widget(?:-(?:container|wrap|text-editor|heading|image|theme-post-content))?", re.I)
#: Boilerplate that can be most of a page.
DISCUSSION = re.compile(r"(?:^|[-_ ])(?:comments?|commentlist|disqus|replies|respond|cookies?|consent|gdpr)(?:[-_ ]|$)", re.I)
_DIGITS = re.compile(r"\d+")
#: Share of the best score from which on a container belongs to the text where no article or main tells.
PEER = 0.25
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())


#: Deepest level of the tree; elements opened further inside are siblings there.
DEPTH = 512
#: Ends a block where no element does; an object of its own, as texts may hold any character.
BREAK = object()


class _Node:
    __slots__ = ("tag", "path", "skip", "never", "mark", "parts", "parent", "own", "text", "linked", "inner", "paragraphs", "titles", "depth", "in_article", "in_p", "opener", "holder")

    def __init__(self, tag: str, path: str, skip: bool, parent: _Node | None, mark: str = "", opener: _Node | None = None) -> None:
        self.tag, self.path, self.skip, self.parent = tag, path, skip, parent
        self.never, self.mark = skip, mark
        self.parts: list = []
        self.own = self.text = self.linked = self.inner = self.paragraphs = self.titles = 0
        self.depth = 0 if parent is None else parent.depth + 1
        #: Whether the element or one around it is an article or main, or a p.
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        #: The element that was open when this one began, which lies further in than the parent beyond DEPTH.
        self.opener = opener
        self.in_p = tag == "p" or (opener is not None and opener.in_p)
        #: The nearest container around it.
        self.holder = parent if parent is not None and parent.tag in CONTAINER else parent.holder if parent is not None else None


@lru_cache(maxsize=20_000)
def _named(tag: str, classes: str, ident: str) -> tuple[str, str]:
    """An element's step in a generalised path, and its names that mark boilerplate; pages of a site repeat them."""
    each = sorted(set(classes.split()))
    name = tag + "".join("." + _DIGITS.sub("0", c).replace("/", "|") for c in each)
    return name, " ".join(m for m in (*each, ident) if m and BOILERPLATE.search(m) and not STATE.fullmatch(m))


class _Tree(HTMLParser):
    """Element tree of a page, with the closings that HTML implies."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", "", False, None)
        self.nodes = [self.root]
        self.containers: list[_Node] = []
        self._paths: dict[tuple[str, str], str] = {}
        self._open: Counter[str] = Counter()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P and self.at.in_p:
            self._close("p", SCOPE)
        if tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
            for other in ENDS.get(tag, (tag,)):
                self._close(other, LISTS)
        if tag in VOID:
            self.at.parts.append(BREAK if tag == "hr" else " ")
            return
        found = dict(attrs)
        classes, ident = found.get("class") or "", found.get("id") or ""
        # the table of names stays small: long ones are not kept
        name, mark = (_named if len(classes) + len(ident) < 500 else _named.__wrapped__)(tag, classes, ident)
        parent = self.at if self.at.depth < DEPTH else self.at.parent
        skip = parent.skip or tag in SKIP or (tag == "header" and not parent.in_article) or (found.get("role") or "").lower() in _ROLES or "hidden" in found
        if skip or tag in ("body", "html", "article", "main"):
            mark = ""
        path = self._paths.setdefault((parent.path, name), f"{parent.path}/{name}")
        node = _Node(tag, path, skip, parent, mark, self.at)
        self._open[tag] += 1
        parent.parts.append(node)
        self.nodes.append(node)
        self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.at.parts.append(" ")
        elif tag != "p" or self.at.in_p:
            self._close(tag, frozenset(("article", "main", "body", "table")) if tag not in SCOPE else frozenset())

    def _close(self, tag: str, stop: frozenset) -> None:
        if not self._open[tag]:
            return
        node = self.at
        while node.opener is not None and node.tag != tag:
            if node.tag in stop:
                return
            node = node.opener
        if node.opener is not None:
            while self.at is not node.opener:
                self._open[self.at.tag] -= 1
                self.at = self.at.opener

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)
        self.at.own += len(data) - data.count(" ")

    def finish(self) -> None:
        """Decide which marked elements are skipped, and count."""
        if any(n.mark for n in self.nodes):
            self._count()
            clear = {id(self.root)}
            for n in self.nodes[1:]:
                if id(n.parent) in clear and not n.skip and not n.mark:
                    clear.add(id(n))
            most = self.root.text - self.root.linked
            if any(n.tag in ("article", "main") and n.text > n.linked and id(n) in clear for n in self.nodes):
                most = float("inf")
            wide = {id(n) for n in self.nodes if n.mark and 2 * (n.text - n.linked) > most and not DISCUSSION.search(n.mark)}
            outside, rest = {id(self.root): True}, 0
            for n in self.nodes[1:]:
                outside[id(n)] = outside[id(n.parent)] and n.tag != "a" and not n.skip and (not n.mark or id(n) in wide)
                rest += n.own * outside[id(n)]
            for n in self.nodes[1:]:
                holds = id(n) in wide or n.inner > rest and (n.inner == self.root.inner or not DISCUSSION.search(n.mark))
                n.skip = n.never or n.parent.skip or (bool(n.mark) and not holds)
        self._count()
        for n in self.nodes:
            if n.skip:
                continue
            if n.tag in CONTAINER:
                self.containers.append(n)
            if n.tag in ("p", "pre", "blockquote", "h1", "h2", "h3"):
                if n.holder is not None:
                    n.holder.paragraphs += 1
                    n.holder.titles += n.tag == "h1"

    def _count(self) -> None:
        """Text and linked text of all elements, and the most unlinked text of an article or main that they hold."""
        for n in self.nodes:
            n.text, n.linked, n.inner = n.own, 0, 0
        for n in reversed(self.nodes[1:]):
            if n.skip:
                continue
            if n.tag == "a":
                n.linked = n.text
            n.parent.text += n.text
            n.parent.linked += n.linked
            n.parent.inner = max(n.parent.inner, n.inner, n.text - n.linked if n.tag in ("article", "main") else 0)


def _tops(tree: _Tree, path: str) -> list[_Node]:
    """Containers at ``path`` that lie in no other element of that path."""
    inside, tops = set(), []
    for n in tree.nodes[1:]:
        if n.path == path or id(n.parent) in inside:
            inside.add(id(n))
            if n.path == path and id(n.parent) not in inside and n.tag in CONTAINER and not n.skip:
                tops.append(n)
    return tops


def parse(html: str) -> _Tree:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    tree.finish()
    return tree


def score(node: _Node) -> float:
    """Text outside links; containers with more paragraphs of their own and deeper ones count more."""
    clean = node.text - 2 * node.linked
    return clean * (1 + min(node.paragraphs, 20) / 4) * (1.5 if node.tag in ("article", "main") else 1) if clean > 0 else 0.0


def scored(tree: _Tree) -> list[tuple[str, float, int]]:
    """Paths of a page's containers with their scores and whether they hold a title of their own, best first."""
    best: dict[str, tuple[float, int]] = {}
    for node in tree.containers:
        s = score(node)
        if s or node.titles:
            found, titles = best.get(node.path, (0, 0))
            best[node.path] = found + s, titles or int(node.titles > 0)
    return sorted(((p, *x) for p, x in best.items()), key=lambda x: (-x[1], x[0]))


def _tag(step: str) -> str:
    return step.split(".")[0]


def widening(path: str, score: float, pages: int, other: str, other_score: float, other_titles: int) -> tuple[int, int]:
    """How many steps of the best ``path`` enclose ``other`` too, if that is text as good (least counts) or the title of most pages (greatest counts, 0 for none).

    An article or main around the path holds the text; without one, containers
    with at least PEER of the score do.
    """
    steps, others = path.split("/"), other.split("/")
    whole = next((k for k in range(len(steps), 0, -1) if _tag(steps[k - 1]) in ("article", "main")), 0)
    shared = next((k for k, (a, b) in enumerate(zip(steps, others)) if a != b), min(len(steps), len(others)))
    inside = shared == len(others) < len(steps)
    while shared and _tag(steps[shared - 1]) not in CONTAINER:
        shared -= 1
    peer = whole or (shared if shared and not inside and other_score >= PEER * score else len(steps))
    return peer, shared if 2 * other_titles >= pages and other_titles else 0


def widened(path: str, peer: int, title: int) -> str:
    return "/".join(path.split("/")[: min(peer, title or peer)])


def blocks(node: _Node, marked: bool = False) -> list[str]:
    """Texts of a container's blocks in page order, white space as one space, without empty ones; also of ``marked`` elements."""
    out, now = [], []

    def flush() -> None:
        text = " ".join("".join(now).split())
        if text:
            out.append(text)
        now.clear()

    stack: list = [iter(node.parts)]
    open_nodes = [node]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if open_nodes.pop().tag in BLOCK:
                flush()
        elif part is BREAK:
            flush()
        elif isinstance(part, str):
            now.append(part)
        elif not (part.never if marked else part.skip):
            if part.tag in BLOCK:
                flush()
            stack.append(iter(part.parts))
            open_nodes.append(part)
    flush()
    return out


def extract(html: str, path: str | None) -> str:
    """Text at the elements of ``path``; of the best container, or of the whole page, where that has none."""
    tree = parse(html)
    found: list[str] = []
    if path:
        found = [b for n in _tops(tree, path) for b in blocks(n)]
    if not found and (own := scored(tree)) and own[0][1]:
        wide = [widening(own[0][0], own[0][1], 1, *x) for x in own]
        path = widened(own[0][0], min(x for x, _ in wide), max(x for _, x in wide))
        found = [b for n in _tops(tree, path) for b in blocks(n)]
    if not found:
        found = blocks(tree.root) or blocks(tree.root, marked=True)
    return "\n".join(found)


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, score, pages, titles): summed in Spark, with partial sums in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], list] = {}
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                for path, s, title in scored(parse(html)) if html else ():
                    to = sums.setdefault((host, path), [0.0, 0, 0])
                    to[0] += float(round(s))
                    to[1] += 1
                    to[2] += title
            yield pa.RecordBatch.from_pydict(
                {"host": pa.array([k[0] for k in sums], pa.string()), "path": pa.array([k[1] for k in sums], pa.string()),
                 "score": pa.array([x[0] for x in sums.values()], pa.float64()), "pages": pa.array([x[1] for x in sums.values()], pa.int64()),
                 "titles": pa.array([x[2] for x in sums.values()], pa.int64())})

    return (
        pages.select("host", "html").mapInArrow(run, "host string, path string, score double, pages bigint, titles bigint")
        .groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in ("score", "pages", "titles")])
    )


def host_paths(sums: DataFrame) -> DataFrame:
    """(host, path): each host's best path, widened to what encloses its text."""
    top = sums.where("score > 0").groupBy("host").agg(F.max("score").alias("score"))
    best = sums.join(top, ["host", "score"]).groupBy("host").agg(F.min_by(F.struct("path", "score", "pages"), "path").alias("best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            wide = [widening(x["best"]["path"], x["best"]["score"], x["best"]["pages"], x["path"], x["score"], x["titles"]) for x in rows]
            yield pa.RecordBatch.from_pydict(
                {"host": batch.column("host"), "path": pa.array([x["best"]["path"] for x in rows], pa.string()),
                 "peer": pa.array([p for p, _ in wide], pa.int32()), "title": pa.array([t for _, t in wide], pa.int32())})

    wide = sums.join(best, "host").mapInArrow(run, "host string, path string, peer int, title int").groupBy("host", "path").agg(F.min("peer").alias("peer"), F.max("title").alias("title"))
    depth = F.when(F.col("title") > 0, F.least("peer", "title")).otherwise(F.col("peer"))
    return wide.select("host", F.array_join(F.slice(F.split("path", "/"), F.lit(1), depth), "/").alias("path"))


#: At most this many hosts with a path of their own are broadcast; more are joined by a shuffle.
BROADCAST_HOSTS = 20_000


def main_text(pages: DataFrame) -> DataFrame:
    """Columns of ``pages`` (url, html) plus text and n_chars."""
    keep = [c for c in pages.columns if c not in ("text", "n_chars", "host", "path")]
    host, _ = host_and_path(F.col("url"))
    based = pages.select(*keep).withColumn("host", host)
    sums = materialize(votes(based), "votes")
    winners = materialize(host_paths(sums), "paths")
    common = winners.groupBy("path").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "path").limit(1)
    usual = [r["path"] for r in common.collect()]
    usual_path = usual[0] if usual else None
    own = winners.where(~F.col("path").eqNullSafe(F.lit(usual_path)))
    few = len(own.select("host").limit(BROADCAST_HOSTS + 1).collect()) <= BROADCAST_HOSTS
    joined = based.join(F.broadcast(own) if few else own, "host", "left").withColumn("path", F.coalesce("path", F.lit(usual_path)))

    new = [StructField("text", StringType()), StructField("n_chars", LongType())]
    schema = StructType([f for f in pages.select(*keep).schema.fields] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "html"):
                out = [extract(h, p) if h else "" for h, p in zip(b.column("html").to_pylist(), b.column("path").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in keep), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=[*keep, "text", "n_chars"])

    return joined.select(*keep, "path").mapInArrow(run, schema)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
