"""Main text of web pages by composite text density.

A page is parsed into a tree with the usual repairs (void and raw-text elements, optional
end tags, stray and missing end tags, comments, a tag that the page's end cuts off). What a
page itself declares to be something else is left out first: scripts, styles, forms,
navigation, headers, footers, asides, hidden parts, and elements whose class, id or role
names adverts, notices, side bars, sharing, or comments. A name in a class, and a form, may
also stand around the whole page (``has-sidebar``, ``nav-open``): such an element is a wrapper
and stays if all ``article`` and ``main`` elements are in it and one of them is ``main`` or it
holds half of the page's characters, or, without any such element, if it holds half of them
(four fifths if the name is a whole class or id).

For every remaining element the density is its characters per tag, lowered by the share of
characters and tags that are links (the body's own ratio sets how far). Formatting such as
bold text counts as no tag. The sum over the densities of the children, texts included, is
an element's score. The threshold is the least density on the path from the best element up
to the body; in every branch at or above it the subtree with the largest sum is taken. So an
article in several parts is put together. A block of three links or more that is mostly link
text is a menu, declared or not.

Null html counts as empty, an empty page has an empty text; repeated pages have equal texts.
"""

from __future__ import annotations

import html as references
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyforge.llm.common import map_batches

#: Elements by their role in the page (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
LEFT_OUT = RAW | frozenset("head nav header footer aside form button select option menu svg math object canvas audio video dialog label fieldset map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
#: A block of these kinds is a menu if it has so many links and so large a share of link text.
LISTS = frozenset("ul ol dl div section table p center".split())
MENU_LINKS, MENU_SHARE = 3, 0.7
#: Elements that an implied end never reaches beyond.
SCOPE = frozenset("html body div article section main ul ol dl table td th aside nav header footer form blockquote figure".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_NOTES = (
    r"(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|popup|modal|overlay|cookie\w*|consent|gdpr|notice\w*|alert|"
    r"side-?bar\w*|widget\w*|menu\w*|nav|navbar|navigation|breadcrumb\w*|pagination|pager|footer|header|masthead|toolbar|"
    r"comment|comments|commentlist|comment-?list|disqus\w*|repl(?:y|ies)|respond|share|sharing|social\w*|related\w*|recommend\w*|"
    r"newsletter\w*|subscribe\w*|signup|login|skip-?link\w*|copyright|disclaimer)"
)
NOTED, NOTED_WHOLE = re.compile(rf"(?:^|[\s_-]){_NOTES}(?:$|[\s_-])"), re.compile(_NOTES)
#: Share of a page's characters from which a noted element is a wrapper: by part of a name, by a whole one.
WRAPS = (None, 0.5, 0.8)

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z](?:[^\"'>]|\"[^\"]*\"|'[^']*')*+(?:>|\Z)|</?[A-Za-z][^>]*(?:>|\Z)", re.DOTALL)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")


class Node:
    """An element: its children and texts in order, and counts over its subtree."""

    __slots__ = ("name", "parent", "items", "out", "chars", "tags", "link_chars", "link_tags", "density", "total", "noted")

    def __init__(self, name: str, parent: Node | None, out: bool = False, noted: int = 0):
        self.name, self.parent, self.items, self.out, self.noted = name, parent, [], out, noted
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _declared(tag: str, name: str) -> tuple[bool, int]:
    """Whether an element says that it isn't part of the main text, and whether its name notes
    it as something else: 1 by a part of a class or id, 2 by a whole one or as a form."""
    if name in LEFT_OUT:
        return name != "form", 2 * (name == "form")
    if name in ("html", "body", "article", "main") or "=" not in tag and "hidden" not in tag:
        return False, 0
    noted = 0
    for key, *values in _ATTRIBUTE.findall(tag[len(name) + 1 :].rstrip(">")):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "role" and value in ROLES or key == "aria-hidden" and value == "true":
            return True, 0
        if key in ("class", "id") and NOTED.search(re.sub(r"\s+", " ", value)):
            noted = max(noted, 1 + any(NOTED_WHOLE.fullmatch(x) for x in value.split()))
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True, 0
    return False, noted


def _leave_out_noted(root: Node) -> None:
    """Leave out noted elements, but for those that stand around the page."""
    nodes = _ordered(root)
    if not any(node.noted for node in nodes):
        return
    chars, mains, whole = {}, {}, set()
    for node in reversed(nodes):
        inner = [x for x in node.items if isinstance(x, Node) and not x.out]
        chars[node] = sum(len(x.strip()) for x in node.items if isinstance(x, str)) + sum(chars[x] for x in inner)
        mains[node] = sum(mains[x] for x in inner) + (node.name in ("article", "main") and chars[node] > 0)
        if node.name == "main" and chars[node] or not whole.isdisjoint(inner):
            whole.add(node)
    for node in nodes:
        if node.noted and mains[root]:
            wraps = mains[node] == mains[root] and (node in whole or chars[node] >= WRAPS[1] * chars[root])
            node.out = not wraps
        elif node.noted:
            node.out = chars[node] < WRAPS[node.noted] * chars[root]


def parse(page: str) -> Node:
    """The tree below a made root."""
    root = at = Node("#root", None)
    done, size = 0, len(page)
    while done < size:
        m = _MARKUP.search(page, done)
        stop = m.start() if m else size
        if stop > done:
            at.items.append(references.unescape(page[done:stop]))
        if not m:
            break
        tag, done = m[0], m.end()
        named = _NAME.match(tag)
        if not named:
            continue
        name = named[1].lower()
        if tag[1] == "/":
            node = at
            while node is not root and node.name != name:
                if node.name in SCOPE and name in ("p", "li", "dt", "dd", "tr", "td", "th", *INLINE):
                    node = root
                else:
                    node = node.parent
            if node is not root:
                at = node.parent
            continue
        if not tag.endswith(">"):
            break
        at = _implied_end(at, name)
        out, noted = _declared(tag, name)
        node = Node(name, at, at.out or out, noted)
        at.items.append(node)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, done)
            done = end.start() if end else size
            at = node
        else:
            at = node
    _leave_out_noted(root)
    return root


def _implied_end(at: Node, name: str) -> Node:
    """Where a start tag goes after the elements it ends."""
    ends = CLOSED_BY.get(name)
    if name in CLOSES_P:
        ends = frozenset(["p"])
        if name in ("h1", "h2", "h3", "h4", "h5", "h6") and at.name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            return at.parent
    if not ends:
        return at
    node = at
    while node.parent is not None:
        if node.name in ends:
            return node.parent
        if node.name in SCOPE and node.name not in ends:
            return at
        node = node.parent
    return at


def _ordered(root: Node) -> list[Node]:
    """Nodes that stay, parents first."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack += [x for x in node.items if isinstance(x, Node) and not x.out]
    return found


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        for x in node.items:
            if isinstance(x, str):
                node.chars += len(x.strip())
            elif not x.out:
                node.chars += x.chars
                node.tags += x.tags + (x.name == "a" or x.name not in INLINE and x.name != "br")
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        elif node.name in LISTS and node.link_tags >= MENU_LINKS and node.link_chars > MENU_SHARE * node.chars:
            node.out, node.chars, node.tags, node.link_chars, node.link_tags = True, 0, 0, 0, 0
    body = next((n for n in nodes if n.name == "body"), nodes[0])
    share = body.link_chars / max(1, body.chars)
    for node in nodes:
        node.density = _density(node, share)
    for node in reversed(nodes):
        for x in node.items:
            if isinstance(x, str):
                node.total += len(x.strip())
            elif not x.out:
                node.total += x.total if x.name in INLINE and x.name != "a" else x.density


def _density(node: Node, share: float) -> float:
    """Characters per tag; the logarithm takes links off, to the base of what the body has."""
    if not node.chars:
        return 0.0
    c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
    base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
    inner = c / max(1, lc) * t / lt
    return c / t * math.log(max(inner, 1.0)) / math.log(max(base, math.e)) if inner > 1 else c / t / (1 + base) / (1 + lc)


def selected(root: Node) -> list[Node]:
    """The subtrees that make up the main text, in page order."""
    nodes = _ordered(root)
    _measure(nodes)
    body = next((n for n in nodes if n.name == "body"), root)
    blocks = [n for n in _ordered(body) if n is body or n.name not in INLINE]
    best = max(reversed(blocks), key=lambda n: n.total)
    if best.total == 0:
        return [body]
    threshold, node = best.density, best
    while node is not body and node.parent is not None:
        node = node.parent
        threshold = min(threshold, node.density)
    taken, stack = [], [body]
    while stack:
        node = stack.pop()
        if node is best:
            taken.append(node)
        elif node.density >= threshold and not _holds(node, best):
            taken.append(max(_ordered(node), key=lambda n: n.total))
        elif _holds(node, best) or node.density >= threshold:
            stack += [x for x in reversed(node.items) if isinstance(x, Node) and not x.out]
    return taken


def _holds(node: Node, inner: Node) -> bool:
    at = inner
    while at is not None and at is not node:
        at = at.parent
    return at is node


def text_of(nodes: list[Node]) -> str:
    """Blocks in order, white space within one turned into single blanks, joined by one."""
    blocks, run = [], []

    def end() -> None:
        if words := "".join(run).split():
            blocks.append(" ".join(words))
        run.clear()

    for top in nodes:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                run.append(item)
            elif item is None:
                end()
            elif item.out:
                continue
            elif item.name == "br":
                run.append("\n")
            elif item.name in INLINE:
                stack += reversed(item.items)
            else:
                end()
                stack.append(None)
                stack += reversed(item.items)
        end()
    return " ".join(blocks)


def main_text(page: str | None) -> str:
    """The main text of one page."""
    return text_of(selected(parse(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each page."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    schema = f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint"
    return map_batches(pages.select("page_id", "url", "html"), work, schema)
