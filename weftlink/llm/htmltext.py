"""Main text of HTML pages by composite text density.

Every element gets its characters a tag, adjusted by the share of links; the block whose
blocks' densities sum to the most is the article, whatever it is called, and the least
density on the way from the body to it is the threshold for what else is kept. Tags and
roles that hold no article count for nothing; names (class, id) only make text weigh as link
text, and give way to what an element holds."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
#: Fixed tag sets of HTML.
RAW = {"script", "style", "textarea", "title", "xmp", "noscript", "iframe", "noembed", "noframes", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Never part of an article.
OUT = {"aside", "button", "canvas", "dialog", "fieldset", "footer", "form", "head", "header", "iframe", "input", "label", "menu", "nav", "noscript", "object", "option", "script", "select", "style", "svg", "template", "textarea", "title"}
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog", "toolbar"}
#: Words that name boilerplate, and words that may stand beside one in such a name
#: ("cookie-banner", "site_footer"). With any other word beside it ("page-with-sidebar",
#: "social-science") a name says nothing.
COMMENTS = set("comment comments commentlist disqus replies reply respond responses".split())
NAMES = COMMENTS | set("ad ads advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo promos promotion banner banners nav navbar navigation menu menus header footer sidebar sidebars side breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup modal overlay subscribe newsletter signup login share sharing social related recommended widget widgets toolbar pagination pager masthead skip hidden legal".split())
BESIDE = set("area articles bar bottom box block body button buttons center col column container content entry form frame global group inner item items left link links list main message outer page panel posts primary right secondary section site slot text thread title top unit wrap wrapper".split())
#: Share of a page's text (reader comments and excluded elements left out) over which a
#: named element is taken for the page itself.
MOST = 0.8
#: A block of so many links, and of so large a share of link text, is a menu.
MENU_LINKS, MENU_SHARE = 3, 0.8
ATTR = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>]+)))?""")
#: What a head can hold.
METADATA = {"base", "head", "link", "meta", "noscript", "script", "style", "template", "title"}
#: Where a name in camel case parts.
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Elements that an opening tag closes, up to the given boundaries.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}


class Node:
    __slots__ = ("tag", "parent", "kids", "out", "named", "comment", "wide", "block", "chars", "link", "plain", "tags", "links", "density", "total")

    def __init__(self, tag: str, parent: Node | None, out: bool, named: bool = False, comment: bool = False):
        self.tag, self.parent, self.out, self.named, self.comment, self.kids = tag, parent, out, named, comment, []
        self.wide = self.block = tag in BLOCK
        self.chars = self.link = self.plain = self.tags = self.links = 0
        self.density = self.total = 0.0


def _names(value: str) -> set[str]:
    """The words of ``NAMES`` that a class or id attribute names an element by."""
    said: set[str] = set()
    for name in value.split():
        parts = {x for x in re.split(r"[-_]+", CAMEL.sub("-", name).lower().rstrip("0123456789")) if x and not x.isdigit()}
        if parts <= NAMES | BESIDE:
            said |= parts & NAMES
    return said


def _boilerplate(tag: str, attrs: str) -> tuple[bool, bool, bool]:
    """Whether an element is none of the page's text by its tag, role or state; whether its
    name says so; and whether it is named for comments."""
    if tag in OUT:
        return True, False, False
    if not attrs or tag in ("html", "body", "main"):
        return False, False, False
    low = attrs.lower()
    if not ("class" in low or "id" in low or "role" in low or "hidden" in low or "style" in low):
        return False, False, False
    said: set[str] = set()
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.lower().strip() in OUT_ROLES:
            return True, False, False
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True, False, False
        if name in ("class", "id"):
            said |= _names(value)
    if tag == "article":
        said &= COMMENTS
    return False, bool(said), bool(said & COMMENTS)


def parse(page: str) -> Node:
    """A tree of elements; strings among the children are texts, with character
    references decoded. Comments, scripts and other raw content are left out; open
    elements end as HTML has it (a block ends a paragraph; list items, rows and cells
    end their like; what is no metadata ends the head). How many elements of each tag
    are open is kept, so an end tag without its start costs no walk up the tree."""
    root = Node("html", None, False)
    at, pos, n = root, 0, len(page)
    opened: Counter = Counter()

    def closed(at: Node, to: Node) -> Node:
        while at is not to:
            opened[at.tag] -= 1
            at = at.parent
        return to

    while pos < n:
        m = TOKEN.search(page, pos)
        text = page[pos : m.start() if m else n]
        if text:
            if opened["head"] and at.tag == "head" and text.strip():
                at = closed(at, at.parent)
            at.kids.append(html.unescape(text))
        if m is None:
            break
        pos = m.end()
        tag = m[2]
        if tag is None:
            continue
        if not m[4]:
            break  # the page ends within a tag
        tag = tag.lower()
        if m[1]:
            if opened[tag]:
                up = at
                while up.tag != tag:
                    up = up.parent
                if up is not root:
                    at = closed(at, up.parent)
            continue
        if tag == "html" or tag == "body" and opened["body"]:
            continue
        if opened["head"] and tag not in METADATA:
            up = at
            while up.tag != "head":
                up = up.parent
            at = closed(at, up.parent)
        if tag in BLOCK and opened["p"]:
            up = at
            while up is not root and up.tag != "p" and up.tag not in ("button", "td", "th", "caption", "table"):
                up = up.parent
            if up.tag == "p":
                at = closed(at, up.parent)
        if tag in CLOSES and any(opened[x] for x in CLOSES[tag][0]):
            ends, stops = CLOSES[tag]
            up, to = at, at
            while up is not root and up.tag not in stops:
                if up.tag in ends:
                    to = up.parent
                up = up.parent
            at = closed(at, to)
        if tag == "body":
            at = closed(at, root)
        node = Node(tag, at, *_boilerplate(tag, m[3]))
        at.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else n
        elif tag not in VOID and (tag in BLOCK or not m[3].rstrip().endswith("/")):
            at = node  # a slash does not close a block
            opened[tag] += 1
    return root


def _path(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def _order(root: Node) -> list[Node]:
    """Nodes that are not excluded, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.out:
            continue
        out.append(node)
        todo += [k for k in reversed(node.kids) if type(k) is not str]
    return out


def overrule(nodes: list[Node]) -> None:
    """Names give way to what a page holds. An element named for boilerplate that holds an
    article or main element is no boilerplate; and where no such element is marked, one
    that holds over ``MOST`` of the page's text is the page. Comments stay comments."""
    marked = False
    aside, above = set(), set()  # within comments; around marked elements
    for x in nodes:
        if x.comment or x.parent is not None and id(x.parent) in aside:
            aside.add(id(x))
        elif x.tag in ("article", "main") and not x.named:
            marked = True
            for up in _path(x.parent):
                if id(up) in above:
                    break
                above.add(id(up))
                up.named = False
    if marked:
        return
    held: dict[int, int] = {}
    for x in reversed(nodes):
        held[id(x)] = 0 if id(x) in aside else sum(len(k.strip()) if type(k) is str else held.get(id(k), 0) for k in x.kids)
    at = nodes[0]
    while (most := next((k for k in at.kids if type(k) is not str and held.get(id(k), 0) > MOST * held[id(nodes[0])]), None)) is not None:
        most.named, at = False, most


def weigh(nodes: list[Node]) -> None:
    """Composite text density of every node: characters a tag, times the logarithm of the
    same over the share that is not links, whose base grows with the links; and the sum of
    the densities of a block's blocks (of a block without any: its own). Text in an element
    that a name speaks against weighs as link text. All children come after their parents."""
    for node in reversed(nodes):
        for k in node.kids:
            if type(k) is str:
                node.chars += len(k.strip())
            elif not k.out:
                node.chars += k.chars
                node.link += k.link
                node.tags += k.tags + 1
                node.links += k.links + (k.tag == "a")
                node.block = node.block or k.block
        if node.tag == "a" or node.named:
            node.link = node.chars
        if node.named:
            node.links = max(node.links, node.tags)
    top = nodes[0]
    share = top.link / top.chars if top.chars else 0.0
    for node in nodes:
        c, lc, t, lt = node.chars, max(1, node.link), max(1, node.tags), max(1, node.links)
        if c > node.link:
            base = math.log(c / (c - node.link) * node.link + share * c + math.e)
            node.density = c / t * max(0.0, math.log(c / lc * t / lt)) / max(1.0, math.log(base))
    for node in reversed(nodes):
        below = [k for k in node.kids if type(k) is not str and not k.out and k.block]
        own = sum(len(k.strip()) if type(k) is str else k.chars - k.link for k in node.kids if type(k) is str or not k.out and not k.block)
        if below:
            node.total = sum(k.density for k in below if not k.named) + own
            node.plain = own + sum(k.plain for k in below if not k.named)
        elif not node.named:
            node.total = node.density
            node.plain = 0 if node.link or re.fullmatch("h[1-6]", node.tag) else node.chars


def _menu(node: Node) -> bool:
    """Whether a block is a list of links: no text beside them but headings and what
    stands between links."""
    return node.block and node.links >= MENU_LINKS and node.link >= MENU_SHARE * node.chars and not node.plain


def _skipped(node: Node) -> bool:
    return node.out or node.named or _menu(node)


def _runs(node: Node):
    """The blocks among the children, and the runs of texts and inline elements between."""
    run: list = []
    for k in node.kids:
        if type(k) is not str and k.block:
            if run:
                yield run
            run = []
            yield k
        else:
            run.append(k)
    if run:
        yield run


def regions(root: Node) -> list:
    """The parts to keep, in page order, None between them: the block with the largest
    density sum; beside the path from the body to it every block and run of text that
    reaches the path's least density (the threshold), and headings; within an article or
    main element around it all that is no list of links; and other article or main
    elements that reach the threshold."""
    nodes = _order(root)
    overrule(nodes)
    weigh(nodes)
    body = next((x for x in nodes if x.tag == "body"), root)
    best, todo = body, [body]
    while todo:
        x = todo.pop()
        best = x if x.block and x.total > best.total else best  # of equals the outermost
        todo += [k for k in reversed(x.kids) if type(k) is not str and k.chars and not _skipped(k)]
    path = list(_path(best))
    path = path[: path.index(body) + 1] if body in path else path
    floor = min((x.density for x in path if x.density > 0), default=0.0)
    marked = max((k for k, x in enumerate(path) if x.tag in ("article", "main")), default=-1)
    inside, around = {id(x) for x in path[1 : marked + 1]}, {id(x) for x in path[1:]}
    out: list = []
    todo = [(body, False)]
    while todo:
        x, beside = todo.pop()
        if type(x) is list:
            long = sum(len(k.strip()) if type(k) is str else k.chars - k.link for k in x if type(k) is str or not _skipped(k))
            if beside or long >= max(1.0, floor):
                out += [None, *x]
        elif id(x) in around:
            todo += [(k, id(x) in inside) for k in reversed(list(_runs(x)))]
        elif x is best:
            out += [None, *x.kids] if x is body else [None, x]
        elif _skipped(x) or not x.chars:
            continue
        elif beside or x.density >= floor and (x.tag in ("article", "main") or x.parent is not None and id(x.parent) in around) or re.fullmatch("h[1-6]", x.tag) and id(x.parent) in around:
            out += [None, x]
        else:
            todo += [(k, False) for k in reversed(x.kids) if type(k) is not str]
    return out


def text_of(parts: list) -> str:
    """The texts of subtrees: white space inside a block is one space, blocks are parted by
    an empty line. Excluded elements, named ones and lists of links are left out."""
    blocks: list[list[str]] = [[]]
    todo: list = list(reversed(parts))
    while todo:
        k = todo.pop()
        if k is None:
            blocks.append([])
        elif type(k) is str:
            blocks[-1].append(k)
        elif k.tag == "br" or k.tag == "wbr":
            blocks[-1].append(" " if k.tag == "br" else "")
        elif not _skipped(k):
            if k.wide:
                blocks.append([])
                todo.append(None)
            todo += reversed(k.kids)
    return "\n\n".join(x for b in blocks if (x := " ".join("".join(b).split())))


def main_text(page: str | None) -> str:
    """The main text of a page; null, empty and textless pages give an empty string."""
    return text_of(regions(parse(page))) if page else ""


def _main_texts(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(p) for p in pages], dtype=object)


main_text_udf = F.pandas_udf(_main_texts, StringType())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row; repeated rows and null ids or urls are
    rows like any; an empty table gives none; other columns are ignored."""
    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), main_text_udf(F.col(html_col)).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
