"""Main text of web pages by tree scoring.

Paragraphs pass points for length and commas to the elements around them,
discounted by link density; the best container and those beside it that also
hold text are kept. Menus, notices, forms and the like are taken out first. Inside
the chosen article only what no article has as its own goes: adverts, comments,
forms. All steps take time in proportion to the page, broken or not.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terralattice.llm.common import by_batch

# Fixed values of HTML, by use.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noframes xmp".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby
s samp small span strike strong sub sup time tt u var wbr""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul""".split())
SIBLINGS_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
                "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tbody",)}
BOUNDS = frozenset("table ul ol dl select body html article section div".split())  # implied ends do not reach across these
PARTS = frozenset("section table blockquote pre ul ol dl figure details".split())  # of a text, beside its other parts
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd div section article main body figcaption".split())

# Elements, roles and name parts that are not article text.
DROP_TAGS = frozenset("""head script style noscript template nav footer aside form button select option input textarea iframe
object embed svg canvas menu dialog audio video title""".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
DROP_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie
cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login share sharing social related
recommended recommendations sidebar comment comments disqus replies reply respond discussion menu nav navbar navigation
breadcrumb breadcrumbs footer masthead topbar widget pagination pager toolbar teaser outbrain taboola""".split())
# Of these, the ones that hold text of others or of the site; no wrapper of an article has them.
APART_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense cookie cookies consent gdpr popup modal overlay newsletter
comment comments disqus replies reply respond discussion""".split())
HEADER_NAMES = frozenset("header head".split())
# Inside an article a name counts only as a whole: each of its parts is of these, and one of the first.
BOX_NAMES = APART_NAMES | frozenset("share sharing social sponsor sponsored promo promotion subscribe subscription related recommended".split())
PLAIN_PARTS = frozenset("area bar block bottom box btn buttons container content form inline item items left links list panel right section slot thread top unit widget wrap wrapper".split())
NEGATIONS = frozenset("with without has no".split())  # "with-sidebar" names what is beside a sidebar

LEAST_KEPT = 0.25  # of the paragraph text, or names are not trusted

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""=\s*["']|>""")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]++)\s*+(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "names", "boxed", "look", "role", "hidden", "points", "chars", "linked", "links", "prose", "holds")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.names, self.boxed, self.look, self.role, self.hidden = frozenset(), False, "", "", False
        self.points, self.chars, self.linked, self.links, self.prose, self.holds = 0.0, 0, 0, 0, 0, False
        if attributes and not attributes.isspace():
            found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)}
            parts = [p.lower() for p in _PART.findall(f"{found.get('class', '')} {found.get('id', '')}")]
            self.names = frozenset(p for before, p in zip(["", *parts], parts) if before not in NEGATIONS)
            self.look = found.get("class", "")
            for name in f"{self.look} {found.get('id', '')}".split():
                whole = {p.lower() for p in _PART.findall(name)}
                self.boxed = self.boxed or bool(whole & BOX_NAMES) and whole <= BOX_NAMES | PLAIN_PARTS
            self.role = found.get("role", "").lower()
            style = found.get("style", "").replace(" ", "").lower()
            self.hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Place after the `>` that closes a tag; quoted values may hold others. `last` has the last place of each mark."""
    while True:
        stop = _STOP.search(page, at)
        if page[stop.end() - 1] == ">":
            return stop.end()
        quote = page[stop.end() - 1]
        # A quote that is never closed, or only beyond the last `>`, is taken as an ordinary character.
        closed = page.find(quote, stop.end()) if stop.end() <= last[quote] else -1
        at = closed + 1 if 0 <= closed < last[">"] else stop.end()


def _tokens(page: str):
    """Texts (None, text, 0) and tags (slash, name, start of its attributes, end) in one pass forward."""
    last = {mark: page.rfind(mark) for mark in (">", '"', "'")}
    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        while start >= 0 and start < last[">"] and not (page[start + 1].isascii() and page[start + 1].isalpha() or page[start + 1] in "!?/"):
            start = page.find("<", start + 1)
        if start < 0 or start >= last[">"]:  # no tag is closed any more
            if page.startswith("<!--", start) and start >= 0:
                yield None, page[at:start], 0, start
                return
            yield None, page[at:], 0, end
            return
        if start > at:
            yield None, page[at:start], 0, start
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = close + 3 if close >= 0 else end
            continue
        name = _NAME.match(page, start)
        if name is None:
            at = page.find(">", start) + 1
            continue
        at = _tag_end(page, name.end(), last)
        moved = yield name[1], name[2].lower(), name.end(), at
        at = moved or at


def parse(page: str) -> Node:
    """A tree of elements and texts; unclosed and misplaced tags are put right as far as text needs it."""
    root = here = Node("html", None)
    unclosed: Counter[str] = Counter()  # elements from here to the root
    source, moved = _tokens(page), None
    while True:
        try:
            slash, tag, start, at = source.send(moved)
        except StopIteration:
            return root
        moved = None
        if slash is None:
            here.children.append(html.unescape(tag))
            continue
        if slash:
            if unclosed[tag]:
                here = _close(here, (tag,), unclosed)
            continue
        if tag in ("html", "body"):
            continue
        ended = ("p",) if tag in CLOSES_P else SIBLINGS_END.get(tag, ())
        if any(unclosed[e] for e in ended):
            above = here
            while above.parent is not None and above.tag not in ended and above.tag not in BOUNDS:
                above = above.parent
            if above.tag in ended and above.parent is not None:
                here = _close(here, (above.tag,), unclosed)
                if tag == "tr" and here.tag == "tr":
                    here = _close(here, ("tr",), unclosed)
        attributes = page[start:at - 1]
        node = Node(tag, here, attributes)
        here.children.append(node)
        if tag in RAW:
            close = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
            moved = page.find(">", close.end() - 1) + 1 or len(page) if close else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            here = node
            unclosed[tag] += 1


def _close(here: Node, tags: tuple[str, ...], unclosed: Counter[str]) -> Node:
    """The parent of the nearest element of one of the tags; what lies between is closed too."""
    while True:
        unclosed[here.tag] -= 1
        found, here = here.tag in tags, here.parent
        if found:
            return here


def _in_order(root: Node) -> list[Node]:
    """Elements, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _weigh(nodes: list[Node]) -> None:
    """Characters, linked characters and links below each element."""
    for node in reversed(nodes):
        node.chars = node.linked = node.links = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
            else:
                node.chars, node.linked, node.links = node.chars + child.chars, node.linked + child.linked, node.links + child.links
        if node.tag == "a":
            node.linked, node.links = node.chars, node.links + 1


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _inline_text(node: Node) -> str:
    """Text directly in a block, with that of its inline elements."""
    parts, stack = [], list(reversed(node.children))
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag in INLINE:
            stack.extend(reversed(item.children))
    return " ".join("".join(parts).split())


def _score(nodes: list[Node]) -> None:
    """A paragraph gives all its points to its parent, half to the next and less further up."""
    for node in nodes:
        if node.tag in PARAGRAPHS:
            text = _inline_text(node)
            if text:
                points = (1 + text.count(",") + text.count("\u060c") + min(len(text) / 100, 3)) * (1 - _density(node))
                node.points += points if node.tag != "p" else 0
                above, share = node.parent, 1.0
                for depth in range(1, 6):
                    if above is None:
                        break
                    above.points += points * share
                    above, share = above.parent, 1 / (2 * depth)


def _junk(node: Node, inside_article: bool, by_name: bool) -> bool:
    if node.tag in DROP_TAGS or node.hidden or node.role in DROP_ROLES:
        return True
    if inside_article:
        return node.boxed and node.tag not in HEADINGS and node.tag not in INLINE and node.tag != "p"
    if not by_name:
        return False
    if node.tag == "header" or node.names & HEADER_NAMES and node.tag not in HEADINGS:
        return True
    return bool(node.names & DROP_NAMES)


def _count_prose(nodes: list[Node]) -> bool:
    """Sums the unlinked text of paragraphs below each element, without what is no article under any name.

    Marks the elements that hold an article or main element. False, and no sums, if
    one of these holds text.
    """
    apart: set[Node] = set()
    for node in nodes:
        if node.parent in apart or node.hidden or node.tag in DROP_TAGS and node.tag != "form" or node.role in DROP_ROLES - {"form"} or node.names & APART_NAMES:
            apart.add(node)
    article = False
    for node in reversed(nodes):
        own = node.tag in ("article", "main") and not node.names & DROP_NAMES
        if node.parent is not None:
            node.parent.holds = node.parent.holds or node.holds or own
        if node not in apart:
            if node.tag in PARAGRAPHS:
                linked = sum(len(_inline_text(c)) for c in node.children if isinstance(c, Node) and c.tag == "a")
                node.prose += max(0, len(_inline_text(node)) - linked)
            article = article or node.tag in ("article", "main") and (node.prose > 0 or bool(_inline_text(node)))
            if node.parent is not None:
                node.parent.prose += node.prose
    return not article


def _wrapper(node: Node, most: float) -> bool:
    """Whether an element is kept whatever its name, as it holds the article or most of the page's paragraphs."""
    if node.hidden:
        return False
    return node.tag in ("div", "section", "form") and node.holds or node.prose > most


def _prune(root: Node, by_name: bool, most: float) -> list[Node]:
    """Takes out what is not article text; a wrapper around the article stays, whatever its name."""
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main")
        stays = []
        for child in node.children:
            if isinstance(child, Node):
                if _junk(child, inside, by_name) and not _wrapper(child, most):
                    continue
                stack.append((child, inside))
            stays.append(child)
        node.children = stays
    return _in_order(root)


def _menu(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "table", "section", "dl") and node.links >= 3 and _density(node) > 0.6


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks below `nodes` in page order, white space made single."""
    out: list[str] = []
    parts: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            out.append(text)
    stack: list[Node | str | None] = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            parts.append(item)
        elif item.tag == "br":
            parts.append(" ")
        elif item.tag in INLINE:
            stack.extend(reversed(item.children))
        else:
            close()
            stack.append(None)
            stack.extend(reversed(item.children))
    close()
    return out


def main_text(page: str | None) -> str:
    """The blocks of the article, joined by line ends; empty if there are none.

    Where the names of elements rule out most of the text, they are not trusted.
    """
    if not page:
        return ""
    text, prose = _article(page, True)
    if len(text) >= LEAST_KEPT * prose and text:
        return text
    return max(text, _article(page, False)[0], key=len)


def _article(page: str, by_name: bool) -> tuple[str, int]:
    """The text, and how much paragraph text the page has that may be of an article; 0 where an article element tells."""
    root = parse(page)
    prose = root.prose if _count_prose(_in_order(root)) else 0
    return _main(root, _prune(root, by_name, prose / 2 if prose else float("inf"))), prose


def _main(root: Node, nodes: list[Node]) -> str:
    _weigh(nodes)
    _score(nodes)
    best = max(nodes, key=lambda n: n.points * (1 - _density(n)))
    if best.points <= 0:
        return "\n".join(_blocks([root]))
    above = best
    while above is not None:  # an article that holds the best container is meant as a whole
        if above.tag in ("article", "main"):
            best = above
            if above.tag == "article":
                break
        above = above.parent
    if best.parent is None:  # the page itself: its menus stand among the text
        return "\n".join(_blocks([n for n in best.children if isinstance(n, str) or not _menu(n)]))
    least = 0.2 * best.points
    kept = [n for n in best.parent.children if n is best or isinstance(n, Node) and _beside(n, least, best)]
    return "\n".join(_blocks(kept))


def _beside(node: Node, least: float, best: Node) -> bool:
    """Whether an element beside the best container belongs to the article too.

    Parts of a text (sections, tables, lists, quotes) do if they are not mostly
    links, whatever their length; other containers if they look like the best one
    or have a share of its points.
    """
    if best.tag in ("article", "main") and node.tag != best.tag:
        return False
    if node.tag in HEADINGS:
        return True
    if node.tag == "p":
        return node.chars > 80 and _density(node) < 0.25 or node.chars > 0 and not node.linked and _inline_text(node)[-1:] in ".!?\u3002"
    if node.tag in PARTS or node.tag == best.tag and node.look == best.look != "":
        return node.chars > 0 and _density(node) < 0.5
    return node.points * (1 - _density(node)) >= least


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text per row of `pages`, from the whole html; the text is empty if there is none.

    A null or empty html gives an empty text; null ids and urls stay null, and
    repeated rows give repeated results. Other columns are not read. Pages are
    parsed alone, so no row is moved.
    """
    def make(columns):
        return {"page_id": pa.array(columns["page_id"], pa.int64()), "url": pa.array(columns["url"], pa.string()),
                "text": pa.array([main_text(h) for h in columns["html"]], pa.string())}
    return by_batch(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"),
                    "page_id long, url string, text string", make)
