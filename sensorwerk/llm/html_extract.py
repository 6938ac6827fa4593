"""HTML extraction (2): composite text density.

A page is parsed into a tree (HTML's implied end tags for the common cases). Every node gets its
characters, tags, link characters and link tags, and the link-adjusted density

    C / T * log(C / LC * T / LT) to the base ln(C / notLC * LC + LC_body / C_body * C + e)

(a divisor of zero counts as 1). The density sum of a node adds its children's densities; the node with the
largest sum (ties: the outermost) is the article. The smallest density on its path to the body is
the page's threshold: every subtree, leaf and run of bare text beside the path is kept if its density
reaches the threshold. The density of text without links grows with its length, so on pages whose
article is no article or main element, and for further elements of these, a part is measured as if it
were as long as the threshold's node (sections of unequal length). Such pages also keep headings
and paragraphs beside the path that are too short for the threshold.

Elements without text of their own (scripts, controls, ...) are left out by tag. Page furniture
(menus, footers, forms, adverts, comments, ...) is told by tag, role or a whole class name and left
out too, unless it lies on the path to the main text: a wrapper that holds the article or main
element, or, where the page names no other part its article, the largest density sum.

Defined cases: null or empty html gives an empty text; unclosed and misnested tags are repaired,
truncated pages are read as far as they go; pages without a body element use the whole tree;
repeated rows are extracted each; other columns are not read.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, and words that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript template".split())
DROPPED = frozenset("""head title script style noscript template iframe object embed svg canvas math audio video
    button select option textarea input label""".split())
PARTS = frozenset("nav aside footer menu dialog".split())
ARTICLE = ("article", "main")
BLOCK = frozenset("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th
    thead tr ul caption""".split())
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption summary legend".split())
IMPLIED_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody")}
SCOPE = frozenset("html body article section div main table ul ol dl td th blockquote li".split())
FURNITURE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar
    navigation menu breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent notice notification
    popup modal newsletter subscribe subscription share sharing social comment comments disqus reply replies related
    recommended widget toolbar pagination pager skip""".split())
COMMENTS = frozenset("comment comments disqus reply replies".split())
# further words that a compound name of furniture is made of (cookie-banner, comment-list, site-footer)
COMPANIONS = frozenset("""area articles bar block box button buttons container content form icons item items label link links
    list main page posts section site slot stories top unit wrap wrapper zone bottom""".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTR_NAME = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SHORT = HEADINGS | {"p", "blockquote", "pre"}


class Node:
    __slots__ = ("tag", "kids", "parent", "part", "named", "skip", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", skip: bool = False, part: bool = False, named: bool = False):
        self.tag, self.parent, self.part, self.named, self.kids = tag, parent, part, named, []
        self.skip = skip or part or named
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def named_furniture(value: str) -> set[str]:
    """The furniture words of the class names (or ids) that are made of such words and their companions alone."""
    hits: set[str] = set()
    for name in value.split():
        words = [w for w in re.split("[-_]+", name) if w]
        own = FURNITURE.intersection(words)
        if own and all(w in own or w in COMPANIONS for w in words):
            hits |= own
    return hits


def furniture(tag: str, attrs: list[tuple[str, str]], at: Node) -> bool:
    """Page furniture by its role, its class names or its id.

    Inside an article, headings and text elements are the article's whatever their names, and so is what only
    an id names, reader comments aside."""
    if tag == "form":
        return True
    if not attrs or tag in ("html", "body", *ARTICLE):
        return False
    inside = None
    for name, value in attrs:
        value = value.lower()
        if name == "role" and value.strip() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id"):
            hits = named_furniture(value)
            if hits and (hits != {"header"} or _site_header("header", at)):
                inside = _above(at) if inside is None else inside
                if not inside or tag not in SHORT and (name == "class" or "article" not in inside or hits & COMMENTS):
                    return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _above(at: Node | None) -> set[str]:
    """The article and main elements that a place lies in."""
    found = set()
    while at is not None:
        if at.tag in ARTICLE:
            found.add(at.tag)
        at = at.parent
    return found


class Reader:
    """Reads tags from left to right. What was looked for in vain is not looked for again, so a page is read in
    time proportional to its length however broken it is."""

    def __init__(self, html: str):
        self.html, self.size, self.absent = html, len(html), set()

    def find(self, what: str, start: int) -> int:
        at = -1 if what in self.absent else self.html.find(what, start)
        if at < 0:
            self.absent.add(what)
        return at

    def past(self, what: str, start: int) -> int:
        at = self.find(what, start)
        return self.size if at < 0 else at + len(what)

    def comment_end(self, at: int) -> int:
        """End of a comment whose ``<!--`` ends at ``at``; ``<!-->`` and ``<!--->`` are whole ones."""
        for short in (">", "->"):
            if self.html.startswith(short, at):
                return at + len(short)
        ends = [e + n for e, n in ((self.find("-->", at), 3), (self.find("--!>", at), 4)) if e >= 0]
        return min(ends, default=self.size)

    def attributes(self, at: int) -> tuple[list[tuple[str, str]], int, bool]:
        """Names and values up to the tag's end, the place after it, and whether a slash closes it."""
        out = []
        while True:
            gap = _GAP.match(self.html, at)
            at = gap.end()
            if at >= self.size:
                return out, at, False
            if self.html[at] == ">":
                return out, at + 1, gap[0].endswith("/")
            name = _ATTR_NAME.match(self.html, at)
            at, value = name.end(), ""
            equals = _EQUALS.match(self.html, at)
            if equals:
                at = equals.end()
                quote = self.html[at:at + 1]
                close = self.find(quote, at + 1) if quote in ("'", '"') else -1
                if close >= 0:
                    value, at = self.html[at + 1:close], close + 1
                else:                                              # bare, or a quote that nothing ends
                    bare = _BARE.match(self.html, at)
                    value, at = bare[0].strip("\"'"), bare.end()
            out.append((name[0].lower(), unescape(value)))


def parse(html: str) -> Node:
    root = at = Node("#root", None)
    read, pos, n = Reader(html), 0, len(html)
    while pos < n:
        cut = read.find("<", pos)
        if cut < 0:
            at.kids.append(html[pos:])
            break
        after = html[cut + 1:cut + 2]
        name = _NAME.match(html, cut + 2 if after == "/" else cut + 1)
        if not name and after not in ("!", "?", "/"):              # a sign of its own
            end = read.find("<", cut + 1)
            end = n if end < 0 else end
            at.kids.append(html[pos:end])
            pos = end
            continue
        if cut > pos:
            at.kids.append(html[pos:cut])
        if not name:
            pos = read.comment_end(cut + 4) if html.startswith("<!--", cut) else read.past(">", cut)
            continue
        tag = name[0].lower()
        attrs, pos, closed = read.attributes(name.end())
        if after == "/":
            at = _close(at, tag)
            continue
        at = _implied(at, tag)
        node = Node(tag, at, tag in DROPPED, tag in PARTS or _site_header(tag, at), furniture(tag, attrs, at))
        at.kids.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(html, pos) if ("</", tag) not in read.absent else None
            if not end:
                read.absent.add(("</", tag))
            pos = end.end() if end else n
        elif tag not in VOID and not closed:
            at = node
    return root


def _site_header(tag: str, at: Node) -> bool:
    """A header belongs to the page unless it opens the article itself."""
    if tag != "header":
        return False
    while at is not None and at.tag not in ARTICLE:
        at = at.parent
    return at is None


def _close(at: Node, tag: str) -> Node:
    node = at
    while node.parent is not None and node.tag != tag:
        if node.tag in SCOPE and tag not in BLOCK:
            return at                                   # an inline end tag does not close a block
        node = node.parent
    return node.parent if node.parent is not None else at


def _implied(at: Node, tag: str) -> Node:
    ends = ("p",) if tag in CLOSES_P else IMPLIED_END.get(tag, ())
    if tag in IMPLIED_END and tag in CLOSES_P:
        ends = ("p", *IMPLIED_END[tag])
    node, found = at, at
    while node.parent is not None and ends:
        if node.tag in ends:
            found = node.parent
        elif node.tag in SCOPE and not (node.tag in ("td", "th") and tag in ("tr", "tbody")):
            break
        node = node.parent
    return found


def measure(node: Node, in_link: bool = False) -> None:
    """Counts of a tree without its furniture, children first (no recursion: pages nest deeply)."""
    stack = [(node, in_link, False)]
    while stack:
        x, link, done = stack.pop()
        if not done:
            x.chars = x.tags = x.link_chars = x.link_tags = 0
            stack.append((x, link, True))
            stack += [(k, link or k.tag == "a", False) for k in x.kids if isinstance(k, Node) and not k.skip]
            continue
        for k in x.kids:
            if isinstance(k, str):
                c = len("".join(k.split()))
                x.chars += c
                x.link_chars += c if link else 0
            elif not k.skip:
                x.chars += k.chars
                x.tags += k.tags + 1
                x.link_chars += k.link_chars
                x.link_tags += k.link_tags + (k.tag == "a")


def density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """Composite text density; ``ratio`` is the body's share of link characters."""
    if not chars:
        return 0.0
    c, t, lc, lt = (max(1, v) for v in (chars, tags, link_chars, link_tags))
    base = math.log(c / max(1, chars - link_chars) * link_chars + ratio * c + math.e)
    inside = max(1.0, c / lc * t / lt)
    return c / t * (math.log(inside) / math.log(base) if base > 1.0 + 1e-9 else math.log(inside))


def densities(body: Node) -> list[Node]:
    """Sets density and density sum of every counted node; returns them in page order."""
    order, stack = [], [body]
    ratio = body.link_chars / max(1, body.chars)
    while stack:
        x = stack.pop()
        order.append(x)
        x.density = density(x.chars, x.tags, x.link_chars, x.link_tags, ratio)
        stack += [k for k in reversed(x.kids) if isinstance(k, Node) and not k.skip]
    for x in order:
        x.total = sum(k.density for k in x.kids if isinstance(k, Node) and not k.skip) or 0.0
    return order


def reopen(body: Node) -> None:
    """Measures the tree without its furniture, but with the furniture that the main text lies in.

    A named element may hold the main text if an article or main element with text is in it (and
    none lies outside all furniture) or if no article lies beside it; parts (nav, footer, ...) only
    in the first case. The largest density sum of the page decides: what lies on its path is kept.
    """
    order, under, stack = [], set(), [body]
    while stack:
        x = stack.pop()
        order.append(x)
        kids = [k for k in reversed(x.kids) if isinstance(k, Node) and (not k.skip or (k.part or k.named) and k.tag not in DROPPED)]
        if id(x) in under or x.part or x.named:
            under.update(map(id, kids))
        stack += kids
    marked = [x for x in order if x.part or x.named]
    measure(body)
    if not marked:
        return
    stated = [x for x in order if x.tag in ARTICLE and x.chars and id(x) not in under]
    if not stated:
        for x in marked:
            x.skip = False
        measure(body)
        stated = [x for x in order if x.tag in ARTICLE and x.chars]
    named, holds, above = set(map(id, stated)), set(), {}
    for x in stated:
        while x is not None and id(x) not in holds:
            holds.add(id(x))
            x = x.parent
    for x in order:
        above[id(x)] = 0 if x is body else above[id(x.parent)] + (id(x.parent) in named)
    for x in marked:
        x.skip = id(x) not in holds and (x.part or above[id(x)] < len(stated))
    if not all(x.skip for x in marked):
        measure(body)
        ratio = body.link_chars / max(1, body.chars)

        def text_sum(x: Node) -> float:                        # text beside the child elements counts as one of them
            own = len("".join("".join(k for k in x.kids if isinstance(k, str)).split())) if x.tag != "a" else 0
            return density(own, 0, 0, 0, ratio) + sum(
                k.density for k in x.kids if isinstance(k, Node) and not (k.skip or k.part or k.named))

        sums = [(text_sum(x), x) for x in densities(body)]
        most, x = max(sums, key=lambda s: s[0])
        for k in marked:
            k.skip = True
        while most > 0 and x is not None:
            if x.part or x.named:
                x.skip = False
            x = x.parent
    measure(body)


def select(body: Node) -> list[Node]:
    """The main subtrees, in page order."""
    reopen(body)
    order = densities(body)
    best = max(order, key=lambda x: x.total, default=body)     # the first of equals is the outermost
    if best.total <= 0.0:
        return [body]
    path, x = [], best
    while x is not None and x is not body.parent:
        path.append(x)
        x = x.parent
    # text of a path node beside the subtree (a heading outside its section) belongs to the article element
    for x in path:
        if x.tag in ARTICLE:
            best = x
    least = min((x for x in path if x.density > 0), key=lambda x: x.density, default=body)
    ratio, on_path, stated = body.link_chars / max(1, body.chars), set(map(id, path)), best.tag in ARTICLE

    def leads(x: Node) -> bool:
        """Headings and paragraphs straight before the article element, the first a heading, are its title and lead."""
        if x.tag not in SHORT or x.chars <= 2 * x.link_chars or id(x.parent) not in on_path:
            return False
        kids = [k for k in x.parent.kids if isinstance(k, Node) and not k.skip and k.chars]
        end = next((i for i, k in enumerate(kids) if id(k) in on_path), 0)
        begin = end
        while begin and kids[begin - 1].tag in SHORT:
            begin -= 1
        return any(k is x for k in kids[begin:end]) and kids[begin].tag in HEADINGS

    def kept(x: Node) -> bool:
        if x.link_chars >= x.chars:
            return False
        if x.density >= least.density:
            return True
        if stated and x.tag not in ARTICLE:
            return leads(x)
        up = max(1.0, least.chars / x.chars)
        if density(x.chars * up, max(1, x.tags) * up, x.link_chars * up, x.link_tags * up, ratio) >= least.density * (1 - 1e-9):
            return True
        if x.chars <= 2 * x.link_chars:
            return False
        return x.tag in SHORT and id(x.parent) in on_path or x.tag in HEADINGS and not x.parent.link_chars

    chosen, stack = [], [body]
    while stack:
        x = stack.pop()
        if x is best or id(x) not in on_path and kept(x):
            chosen.append(x)
        else:
            stack += reversed(runs(x, on_path, ratio) if id(x) in on_path else [k for k in x.kids if isinstance(k, Node) and not k.skip])
    return chosen


def runs(node: Node, on_path: set[int], ratio: float) -> list[Node]:
    """The counted children of a path node, each run of bare text and inline elements as one leaf."""
    out, run = [], []

    def end() -> None:
        if any(isinstance(k, str) and k.strip() for k in run):
            x = Node("#text", node)
            x.kids = [*run]
            measure(x)
            x.density = density(x.chars, x.tags, x.link_chars, x.link_tags, ratio)
            out.append(x)
        else:
            out.extend(k for k in run if isinstance(k, Node))
        run.clear()

    for k in node.kids:
        if isinstance(k, Node) and k.skip:
            continue
        if isinstance(k, Node) and (id(k) in on_path or k.tag in BLOCK or any(isinstance(j, Node) and j.tag in BLOCK for j in k.kids)):
            end()
            out.append(k)
        else:
            run.append(k)
    end()
    return out


def blocks(node: Node) -> list[str]:
    """Texts of the blocks of a subtree, white space inside a block as one space."""
    out, run = [], []

    def flush() -> None:
        text = " ".join("".join(map(unescape, run)).split())          # a reference ends where its run of text does
        run.clear()
        if text:
            out.append(text)

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.skip:
            continue
        else:
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            elif x.tag == "br":
                run.append(" ")
            stack += reversed(x.kids)
    flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    body, stack = root, [root]
    while stack:
        x = stack.pop()
        if x.tag == "body":
            body = x
            break
        stack += [k for k in reversed(x.kids) if isinstance(k, Node)]
    return "\n".join(b for node in select(body) for b in blocks(node))


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        text = [main_text(h) for h in pdf.html]
        yield pd.DataFrame({"page_id": pdf.page_id, "url": pdf.url, "text": text, "n_chars": [len(t) for t in text]})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
