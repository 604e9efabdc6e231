"""Main text of web pages by wrappers inferred per host."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.prefix import partitions
from riskloom.session import stage

#: Elements below this depth count for their ancestor at it, in wrappers only.
DEPTH = 40
#: Hosts whose wrappers a task holds before it hands them on.
HOSTS_HELD = 1_000
#: Share of an element's text that one child must have for the article to lie in that child.
DOMINANT = 0.7
#: Bytes of wrappers up to which they are broadcast; beyond, pages are joined with them.
BROADCAST_BYTES = 32 << 20

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q"
    " rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: An element of the key ends open elements of the value, up to the nearest of its scope.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Elements that are never part of an article's text.
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe svg math object button select"
    " textarea input menu dialog head title canvas audio video map noframes noembed xmp".split()
)
#: Words in class, id and role that mark such elements.
MARKS = frozenset(
    "nav navbar navigation menu menubar submenu sidebar footer contentinfo masthead complementary"
    " ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notification alert newsletter subscribe subscription"
    " signup login social share sharing related recommended recommendations trending comment"
    " comments commentlist respond reply replies disqus discussion breadcrumb breadcrumbs"
    " pagination pager popup modal overlay dialog search searchbox widget widgets toolbar"
    " copyright legal disclaimer skip skiplink hidden".split()
)
#: Marks of the page's own header; inside an article a header holds the title.
HEADER = frozenset("header topbar siteheader pageheader".split())
ARTICLE = frozenset(("article", "main"))
#: Start tags that can stand in a head; any other ends it, as its end tag may be left out.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<([a-zA-Z/!?])([^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)>?", re.S)
_NAME = re.compile(r"[^\s/>]*")
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_PART = re.compile(r"[a-z0-9]+")
_ENDS = {name: re.compile(f"</{name}[^>]*>?", re.I) for name in RAW}
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


@dataclass(slots=True)
class Element:
    """An element of a page; children are elements and texts in page order."""

    name: str
    sign: str
    dropped: bool
    header: bool
    children: list = field(default_factory=list)


def _element(name: str, rest: str) -> Element:
    classes, ident, role, hidden = "", "", "", False
    if rest and not rest.isspace():
        for m in _ATTRIBUTE.finditer(rest):
            key = m[1].lower()
            value = m[2] or m[3] or m[4] or ""
            if key == "class":
                classes = value.lower()
            elif key == "id":
                ident = value.lower()
            elif key == "role":
                role = value.lower()
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                hidden = True
            elif key == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
    words = {*_PART.findall(classes), *_PART.findall(ident), *_PART.findall(role)}
    whole = name in ARTICLE or name in ("html", "body")
    marked = bool(words & MARKS) and not (whole and not words & {"comment", "comments"})
    header = name == "header" or bool(words & HEADER) or role == "banner"
    if name in ("html", "body"):
        marked = header = hidden = False
    sign = name
    if role == "main" or "articlebody" in words:
        sign = "main"
    elif classes:
        sign = f"{name}.{'.'.join(sorted(set(classes.split())))}"
    return Element(name if sign != "main" else "main", sign, marked or hidden or name in DROPPED, header)


def parse(html: str) -> Element:
    """The page as elements; never fails, however broken or cut short the page is.

    Elements that HTML closes without an end tag are closed, stray end tags are passed over, and
    whatever is open at the end is closed there.  A head ends at ``<body>``, at the first start tag
    that cannot stand in it, and at text.
    """
    root = Element("html", "html", False, False)
    stack = [root]

    def add(text: str) -> None:
        if stack[-1].name == "head" and not text.isspace():
            del stack[1:]
        stack[-1].children.append(text)

    at, length = 0, len(html)
    while at < length:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        kind = m[1]
        if kind is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        if kind in "!?":
            continue
        if kind == "/":
            name = _NAME.match(m[2])[0].lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name or (stack[i].sign == "main" and name in ("div", "section", "main")):
                    del stack[i:]
                    break
                if stack[i].name in ARTICLE and name not in ("body", "html"):
                    break  # what an article left open does not end at tags around it
            continue
        body = kind + m[2]
        name = _NAME.match(body)[0]
        rest = body[len(name) :]
        name = name.lower()
        # a head stands directly below the root
        if name == "body" and len(stack) > 1 and stack[1].name == "head":
            del stack[1:]
        elif stack[-1].name == "head" and name not in IN_HEAD:
            del stack[1:]
        if name == "head" and len(stack) > 1:
            continue
        if name in RAW:
            ending = _ENDS[name].search(html, at)
            stack[-1].children.append(Element(name, name, True, False))
            if ending is None:
                break
            at = ending.end()
            continue
        if name in ("html", "body"):
            continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name not in INLINE:
                    break
        if name in SIBLINGS:
            ended, scope = SIBLINGS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ended:
                    del stack[i:]
                    break
                if stack[i].name in scope:
                    break
        made = _element(name, rest)
        stack[-1].children.append(made)
        if name not in VOID and not rest.endswith("/"):
            stack.append(made)
    return root


@dataclass(slots=True)
class Node:
    """A part of a wrapper: an element's or a text's place in the pages of a host.

    ``text`` is a template's text, or None for a slot.  ``chars`` counts text outside links.
    """

    sign: str
    optional: bool = False
    repeated: bool = False
    text: str | None = None
    chars: int = 0
    children: list[Node] = field(default_factory=list)

    def packed(self) -> list:
        return [self.sign, int(self.optional) + 2 * int(self.repeated), self.text, self.chars, [c.packed() for c in self.children]]

    @staticmethod
    def of(x: list) -> Node:
        return Node(x[0], bool(x[1] & 1), bool(x[1] & 2), x[2], x[3], [Node.of(c) for c in x[4]])

    def expression(self) -> str:
        """The wrapper as a union-free regular expression over tags and text."""
        inner = "".join(c.expression() for c in self.children)
        if self.sign == "#":
            inner = "#" if self.text is None else re.escape(self.text)
        else:
            inner = f"<{self.sign}>{inner}</>"
        mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[(self.optional, self.repeated)]
        return f"({inner}){mark}" if mark else inner


def _align(one: list[Node], two: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """The two streams side by side, as many equal signs as possible in line."""
    a, b = [x.sign for x in one], [x.sign for x in two]
    if a == b:
        return list(zip(one, two, strict=True))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out: list[tuple[Node | None, Node | None]] = []
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((one[i], two[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append((one[i], None))
            i += 1
        else:
            out.append((None, two[j]))
            j += 1
    out += [(x, None) for x in one[i:]] + [(None, x) for x in two[j:]]
    return out


def _folded(nodes: list[Node]) -> list[Node]:
    """Neighbours of equal sign made one repeated group."""
    out: list[Node] = []
    for x in nodes:
        if out and out[-1].sign == x.sign:
            out[-1] = merge(out[-1], x)
            out[-1].repeated = True
        else:
            out.append(x)
    return out


def merge(one: Node, two: Node) -> Node:
    """The least wrapper of both: what only one has is optional, texts that differ are a slot."""
    children = []
    for a, b in _align(one.children, two.children):
        if a is not None and b is not None:
            children.append(merge(a, b))
        else:
            alone = a or b
            alone.optional = True
            children.append(alone)
    return Node(
        one.sign,
        one.optional or two.optional,
        one.repeated or two.repeated,
        one.text if one.text == two.text else None,
        one.chars + two.chars,
        _folded(children),
    )


def wrapper(page: Element) -> Node:
    """A page's own wrapper: the block elements that may hold an article, and where text is."""

    def build(e: Element, depth: int) -> Node:
        children: list[Node] = []
        text: list[str] = []
        linked = 0

        def flush():
            nonlocal linked
            words = " ".join(unescape("".join(text)).split())
            if words:
                children.append(Node("#", text=words, chars=max(len(words) - linked, 0)))
            text.clear()
            linked = 0

        waiting: list = [(c, False) for c in reversed(e.children)]
        while waiting:
            c, in_link = waiting.pop()
            if isinstance(c, str):
                text.append(c)
                linked += len(c) if in_link else 0
            elif c.dropped or (c.header and e.name not in ARTICLE):
                continue
            elif c.name in INLINE:
                if c.name == "br":
                    text.append(" ")
                waiting += [(x, in_link or c.name == "a") for x in reversed(c.children)]
            elif depth >= DEPTH:
                text.append(" ")
                waiting += [(x, in_link) for x in reversed(c.children)]
            else:
                flush()
                children.append(build(c, depth + 1))
        flush()
        return Node(e.sign, chars=sum(x.chars for x in children), children=_folded(children))

    return build(page, 0)


def article_path(host: Node) -> list[str]:
    """Signs from the page down to the element that holds the article.

    Elements that say that they do are taken at their word if they have text.  Else the way goes
    down as long as one child, other than a paragraph, has most of the text.
    """
    named: list[tuple[int, int, list[str]]] = []
    waiting = [(host, [])]
    while waiting:
        node, path = waiting.pop()
        for c in node.children:
            if c.sign == "#":
                continue
            if c.sign.partition(".")[0] in ARTICLE and c.chars:
                named.append((c.sign.partition(".")[0] == "article", c.chars, [*path, c.sign]))
            waiting.append((c, [*path, c.sign]))
    if named:
        articles = [x for x in named if x[0]] or named
        return max(articles, key=lambda x: x[1])[2]
    path, node = [], host
    while True:
        best = max(
            (c for c in node.children if c.sign != "#" and not c.repeated and c.sign.partition(".")[0] not in ("p", "li", "pre", "blockquote", "h1", "h2", "h3")),
            key=lambda c: c.chars,
            default=None,
        )
        if best is None or not best.chars or best.chars < DOMINANT * node.chars:
            return path
        path.append(best.sign)
        node = best


def _at(page: Element, path: list[str]) -> list[Element]:
    """The elements at a path, in page order; wrappers pass inline elements over, so this does."""
    level = [page]
    for sign in path:
        below = []
        for e in level:
            waiting = list(reversed(e.children))
            while waiting:
                c = waiting.pop()
                if isinstance(c, str) or c.dropped or (c.header and e.name not in ARTICLE):
                    continue
                if c.name in INLINE:
                    waiting += reversed(c.children)
                elif c.sign == sign:
                    below.append(c)
        level = below
    return level


def blocks(e: Element) -> list[str]:
    """Texts of the element's blocks, character references decoded and white space evened out."""
    out: list[str] = []
    text: list[str] = []

    def flush():
        words = " ".join(unescape("".join(text)).split())
        if words:
            out.append(words)
        text.clear()

    inside = e.name in ARTICLE
    waiting: list = list(reversed(e.children))
    while waiting:
        c = waiting.pop()
        if c is None:  # a block ends
            flush()
        elif isinstance(c, str):
            text.append(c)
        elif c.dropped or (c.header and not inside):
            if c.name not in INLINE:
                flush()
        elif c.name in INLINE:
            if c.name == "br":
                text.append(" ")
            waiting += reversed(c.children)
        else:
            flush()
            waiting.append(None)
            waiting += reversed(c.children)
    flush()
    return out


def extract(html: str | None, plan: dict | None) -> str:
    """Main text of a page under its host's plan; the page decides where the plan finds nothing."""
    page = parse(html or "")
    found = _at(page, plan["path"]) if plan else []
    parts = [b for e in found for b in blocks(e)]
    if not parts:
        own = wrapper(page)
        parts = [b for e in _at(page, article_path(own)) for b in blocks(e)]
    return "\n\n".join(parts)


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def infer_wrappers(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Wrappers of all hosts: ``host, pages, expression, plan``; stored.

    Each task aligns the pages of a host that it meets, one after another, into one wrapper, and
    hands on a wrapper per host; the hosts' wrappers are then aligned in the same way.  A host
    with a third of all pages so meets in as many wrappers as there are tasks.  ``plan`` (JSON)
    has the path to the article's element.
    """
    schema = "host string, pages long, packed string"

    def emit(held: dict[str, tuple[int, Node]]) -> pa.RecordBatch:
        rows = [(h, n, json.dumps(w.packed())) for h, (n, w) in held.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            ["host", "pages", "packed"],
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, Node]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                host = host_of(batch.column(0)[i].as_py())
                page = wrapper(parse(batch.column(1)[i].as_py() or ""))
                if host in held:
                    n, so_far = held[host]
                    held[host] = n + 1, merge(so_far, page)
                else:
                    held[host] = 1, page
                if len(held) >= HOSTS_HELD:
                    yield emit(held)
                    held = {}
        yield emit(held)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, n, so_far = None, 0, None

        def done():
            plan = json.dumps({"path": article_path(so_far)})
            return pa.RecordBatch.from_pydict(
                {"host": [host], "pages": [n], "expression": [so_far.expression()], "plan": [plan]}
            )

        for batch in batches:
            for row in batch.to_pylist():
                part = Node.of(json.loads(row["packed"]))
                if row["host"] != host or so_far is None:
                    if so_far is not None:
                        yield done()
                    host, n, so_far = row["host"], 0, part
                else:
                    so_far = merge(so_far, part)
                n += row["pages"]
        if so_far is not None:
            yield done()

    read = pages.select(F.col(url_column).cast("string"), F.col(html_column).cast("string"))
    parts = stage(read.mapInArrow(gather, schema), "wrapper-parts")
    dealt = parts.repartition(partitions(pages), "host").sortWithinPartitions("host")
    return stage(
        dealt.mapInArrow(settle, "host string, pages long, expression string, plan string"), "wrappers"
    )


def main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Main text of every page: ``id_column, url_column, text``.

    Scripts, styles, forms, menus, page headers and footers, sidebars, notices, adverts and reader
    comments are left out by element and by the words of class, id and role.  Where the article is
    the host's wrapper tells; a page that the wrapper does not fit decides by itself.  Text of the
    article stays, also where all pages of the host have it in common.  Blocks are joined by two line feeds; inside one white space is a
    space.

    One row per input row, repeated rows included; null and empty pages give an empty text.  Null
    and odd addresses share the wrapper of the empty host.  Broken and cut pages are read as far
    as they go.  An empty table gives no rows; other columns are left out, whatever their names.
    """
    wrappers = infer_wrappers(pages, url_column, html_column).select("host", "plan")
    size = wrappers.agg(F.sum(F.length("plan") + F.length("host"))).first()[0] or 0
    host = F.regexp_extract(F.col(url_column).cast("string"), HOST_IN_SQL, 1)
    read = pages.select(
        F.col(id_column).alias("_id"),
        F.col(url_column).alias("_url"),
        F.lower(F.coalesce(host, F.lit(""))).alias("host"),
        F.col(html_column).cast("string").alias("_html"),
    )
    if size <= BROADCAST_BYTES:
        wrappers = F.broadcast(wrappers)
    joined = read.join(wrappers, "host", "left").select("_id", "_url", "_html", "plan")
    plans: dict[str, dict] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for i in range(batch.num_rows):
                packed = batch.column(3)[i].as_py()
                if packed not in plans:
                    if len(plans) >= HOSTS_HELD:
                        plans.clear()
                    plans[packed] = json.loads(packed) if packed else None
                texts.append(extract(batch.column(2)[i].as_py(), plans[packed]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["_id", "_url", "text"]
            )

    kind = dict(joined.dtypes)
    out = joined.mapInArrow(run, f"_id {kind['_id']}, _url {kind['_url']}, text string")
    return out.withColumnsRenamed({"_id": id_column, "_url": url_column})


#: The same hosts as ``host_of`` finds.
HOST_IN_SQL = r"^(?i:[a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)"
