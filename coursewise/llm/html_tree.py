"""Main text of web pages through site style trees.

The DOMs of a host's different pages are merged by style path (tags and class names from the root).
Copies of a page count once, and so do all nodes of a path in a page. For each path, the entropy of
its presentations (sequences of child tags) and of its contents, to the base of the number of pages,
says how much it varies across the site: a branch that looks and reads alike everywhere is
boilerplate, whatever it is called. Branches that say themselves what they are, by a tag or role for
menus, forms and the like or by a whole class or id token that names adverts, comments, sidebars or
notices, go on every site, as just these differ from page to page; only one that holds an article
stays. The rest of a page, inside its article if it has one, is its main text.

Parsing takes time in proportion to the page, however deep it nests: a path is a hash of the path
above and the own style, and a content is a hash of the contents below.

The paths of a page are shuffled by (host, page, path) as hashes of their looks, and are counted
inside each task before they are summed by (host, path), so a host with a third of all pages is
spread out; pages themselves are only shuffled if the table of unimportant branches is too large to
broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Set
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from coursewise.llm.common import map_texts
from coursewise.llm.url_filters import host_and_path
from coursewise.sources.staging import staged

MIN_PAGES = 5
MIN_IMPORTANCE = 0.3
PRESENTATION_SHARE = 0.3  # of the importance; the rest is content
BROADCAST_BYTES = 8 << 20
# HTML's void elements, the elements without text, blocks, and marks of boilerplate.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SILENT = {"head", "script", "style", "noscript", "template", "iframe", "svg", "object", "canvas", "title"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
BOILERPLATE_WORDS = {
    "nav", "navbar", "navigation", "menu", "footer", "sidebar", "ad", "ads", "advert", "adverts", "advertisement", "sponsor",
    "sponsored", "promo", "banner", "cookie", "cookies", "consent", "notice", "popup", "modal", "newsletter", "subscribe",
    "social", "share", "sharing", "related", "comment", "comments", "reply", "replies", "disqus", "breadcrumb", "breadcrumbs",
    "pagination", "pager", "widget", "login", "signup",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | BOILERPLATE_TAGS
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "ul", "ol", "li", "dl", "dt", "dd", "figure", "figcaption", "table"}
COMMENT_END = re.compile("--!?>")
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


ARTICLES = ("article", "main")


@dataclass(eq=False)
class Node:
    tag: str
    style: str
    path: int
    silent: bool = False
    named: bool = False  # as boilerplate, by tag, role, class or id
    children: list[Node | str] = field(default_factory=list)
    holds: bool = False  # an article or main below
    content: int = 0

    def gone(self, turned: Set[int] = frozenset()) -> bool:
        """Whether the node goes with all below it, in its own right or because its path is unimportant."""
        return self.silent or (not self.holds and (self.named or self.path in turned))


def key_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def words_of(token: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())


class TreeBuilder(HTMLParser):
    """A lenient DOM: implied ends of paragraphs and list items, unknown end tags ignored.

    Comments end as in browsers, other markup declarations at their first ``>``, a tag or
    declaration that never ends takes the rest of the page: no page raises an error.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", 0)
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # of the open nodes, by tag
        self.articles = 0

    def goahead(self, end: bool) -> None:
        self.last = self.rawdata.rfind(">")
        super().goahead(end)

    def until(self, start: int, mark: str) -> int:
        at = self.rawdata.find(mark, start)
        return len(self.rawdata) if at < 0 else at + len(mark)

    def parse_comment(self, i: int, report: int = 1) -> int:
        for empty in ("<!-->", "<!--->"):
            if self.rawdata.startswith(empty, i):
                return i + len(empty)
        found = COMMENT_END.search(self.rawdata, i + 4)
        return found.end() if found else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<![CDATA[", i) and (at := self.rawdata.find("]]>", i)) > 0:
            return at + 3
        return self.until(i, ">")

    def parse_pi(self, i: int) -> int:
        return self.until(i, ">")

    def parse_starttag(self, i: int) -> int:
        return super().parse_starttag(i) if i < self.last else len(self.rawdata)

    def parse_endtag(self, i: int) -> int:
        return super().parse_endtag(i) if i < self.last else len(self.rawdata)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end("p", {"table", "td", "th", "div", "article", "section", "blockquote", "button"})
        if tag in CLOSED_BY_SAME:
            for other in ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,):
                self.end(other, CLOSED_BY_SAME[tag])
        if tag == "body":
            self.end("head", set())
        found = {k: v or "" for k, v in attrs}
        known = BOILERPLATE_WORDS if self.articles else BOILERPLATE_WORDS | {"header"}
        tokens = f"{found.get('class', '')} {found.get('id', '')}".split()
        named = tag in BOILERPLATE_TAGS or found.get("role", "").lower() in BOILERPLATE_ROLES or (tag == "header" and not self.articles)
        named = named or any(map(known.issuperset, filter(None, map(words_of, tokens))))
        named = named and tag not in ("html", "body", "main")
        if tag in ARTICLES and not named:
            for n in reversed(self.open):
                if n.holds:
                    break
                n.holds = True
        style = ".".join([tag, *sorted(c for c in found.get("class", "").split() if c.isalpha())])
        above = self.open[-1]
        node = Node(tag, style, key_of(f"{above.path}/{style}"), tag in SILENT, named)
        above.children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)
            self.articles += tag in ARTICLES

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "object", "iframe"):
            self.end(tag, set())

    def handle_endtag(self, tag: str) -> None:
        self.end(tag, set())

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)

    def end(self, tag: str, within: set[str]) -> None:
        """Close the innermost open ``tag`` with all inside it, unless one of ``within`` is open inside it."""
        at = self.places.get(tag)
        if not at or any(self.places[t][-1] > at[-1] for t in within if self.places.get(t)):
            return
        start = at[-1]
        for n in self.open[start:]:
            self.places[n.tag].pop()
            self.articles -= n.tag in ARTICLES
        del self.open[start:]


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def walk(root: Node):
    """Nodes in page order without what goes anyhow, each with whether it is inside an article."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        if node.gone():
            continue
        inside = inside or node.tag in ARTICLES
        yield node, inside
        todo.extend((c, inside) for c in reversed(node.children) if isinstance(c, Node))


def blocks_of(node: Node, turned: Set[int]) -> list[str]:
    """Texts of the blocks below a node, white space inside each turned into one space."""
    found: list[str] = []
    line: list[str] = []

    def end() -> None:
        if text := " ".join("".join(line).split()):
            found.append(text)
        line.clear()

    todo: list[Node | str | None] = [node]
    while todo:
        at = todo.pop()
        if at is None:
            end()
        elif isinstance(at, str):
            line.append(at)
        elif at.tag == "br":
            line.append(" ")
        elif at is node or not at.gone(turned):
            block = at.tag in BLOCKS
            if block:
                end()
                todo.append(None)
            todo.extend(reversed(at.children))
    end()
    return found


def judged(root: Node) -> list[Node]:
    """The nodes whose importance is to be estimated, their contents hashed from the leaves up.

    They are blocks that neither are nor hold an article, without prose inside one.
    """
    nodes = list(walk(root))
    for node, _ in reversed(nodes):  # what is below a node comes after it
        parts = [str(c.content) if isinstance(c, Node) else " ".join(c.split()) for c in node.children if isinstance(c, str) or not c.gone()]
        node.content = key_of("\0".join(filter(None, parts)))
    return [
        n for n, inside in nodes
        if n.tag in BLOCKS and n.tag not in ("html", "body", *ARTICLES) and not n.holds and not (inside and n.tag in PROSE)
    ]


def main_text(root: Node, turned: Set[int]) -> str:
    """The text of the outermost articles, or else of the page, without the branches that go."""
    tops: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node.gone(turned):
            continue
        if node.tag in ARTICLES:
            tops.append(node)
        else:
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return "\n\n".join(b for top in tops or [root] for b in blocks_of(top, turned))


def style_tree(pages: DataFrame) -> DataFrame:
    """The merged trees: rows (host, path, part, look, times); part is p or c.

    ``look`` is the hash of a page's presentations (p) or contents (c) of the path, ``times`` the
    number of different pages with it.
    """

    def build(batch: pa.RecordBatch) -> dict:
        rows: list[tuple] = []
        seen: set[tuple] = set()
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = key_of(html or "")
            if (host, page) in seen:
                continue
            seen.add((host, page))
            looks: dict[int, tuple[list[str], list[str]]] = {}
            for node in judged(parse(html or "")):
                shown, read = looks.setdefault(node.path, ([], []))
                shown.append(",".join(c.style for c in node.children if isinstance(c, Node)))
                read.append(str(node.content))
            rows += [(host, page, path, key_of("\0".join(shown)), key_of("\0".join(read))) for path, (shown, read) in looks.items()]
        columns = zip(*rows, strict=True) if rows else [()] * 5
        types = [pa.string(), *[pa.int64()] * 4]
        return {n: pa.array(c, t) for n, c, t in zip(["host", "page", "path", "p", "c"], columns, types, strict=True)}

    host, _ = host_and_path(F.col("url"))
    looks = map_texts(pages.select(host.alias("host"), "html"), "host string, page long, path long, p long, c long", build).distinct()
    parts = F.inline(F.array(*[F.struct(F.lit(x).alias("part"), F.col(x).alias("look")) for x in "pc"]))
    return looks.select("host", "path", parts).groupBy("host", "path", "part", "look").agg(F.count(F.lit(1)).alias("times"))


def importance(tree: DataFrame) -> DataFrame:
    """Rows (host, path, pages, importance from 0 to 1): entropies to the base of the page count."""
    n = F.col("times").cast("double")
    sums = tree.groupBy("host", "path", "part").agg(F.sum("times").alias("pages"), F.sum(n * F.ln(n)).alias("nlogn"))
    entropy = F.when(F.col("pages") > 1, 1 - F.col("nlogn") / (F.col("pages") * F.ln("pages"))).otherwise(1.0)
    share = F.when(F.col("part") == "p", F.lit(PRESENTATION_SHARE)).otherwise(F.lit(1 - PRESENTATION_SHARE))
    return sums.groupBy("host", "path").agg(F.max("pages").alias("pages"), F.sum(entropy * share).alias("importance"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null html counts as empty and gives an empty text. Pages with a null url, or one without a
    host, form a site of their own. Paths that fewer than MIN_PAGES different pages of a site have are
    judged by tags, roles and names alone. Malformed or very deep markup raises no error. Repeated rows come out repeated.
    """
    weak = importance(style_tree(pages)).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < MIN_IMPORTANCE))
    weak = staged(weak.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("turned")), "turned-branches")
    size = weak.agg(F.sum(F.length("host") + 8 * F.size("turned") + 64)).first()[0] or 0
    host, _ = host_and_path(F.col("url"))
    keyed = pages.select("page_id", "url", "html", host.alias("host"))
    joined = keyed.join(F.broadcast(weak) if size <= BROADCAST_BYTES else weak, "host", "left")

    def build(batch: pa.RecordBatch) -> dict:
        turned = batch.column("turned").to_pylist()
        texts = [main_text(parse(h or ""), set(d or ())) for h, d in zip(batch.column("html").to_pylist(), turned, strict=True)]
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        }

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_texts(joined.select("page_id", "url", "html", "turned"), f"page_id {kind}, url string, text string, n_chars long", build)
