"""HTML extraction by composite text density.

A page is read into a tree. Each node has a density, its characters per tag, lowered
the more of them are links. The subtree whose children's densities have the largest
sum holds the article; the least density on the path from it to the body is the
threshold from which other parts of the page belong to it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from caseloom.llm.common import column, first_column, slices

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
LABEL = re.compile(r"[a-z0-9]+")

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead"
    " tr ul caption".split()
)
#: An open element of the first kind is ended by a start tag of the second.
ENDS = {
    "p": BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"},
    "tbody": {"tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
#: Beyond these an open element is not looked for.
SCOPE = frozenset("article aside blockquote body div footer header html main nav section table td th ul ol dl form".split())

#: Elements that never hold the article, and words in class, id or role that say so.
LEFT_OUT = frozenset(
    "head script style noscript template iframe object embed svg canvas nav footer aside form button select textarea input"
    " dialog menu search title noembed noframes xmp audio video map".split()
)
LABELS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs complementary consent contentinfo"
    " cookie cookies dialog disclaimer footer gdpr masthead menu modal nav navbar navigation newsletter notice notices"
    " pager pagination popup promo promotion related search share sharing sidebar signup social sponsor"
    " sponsored subscribe toolbar topbar widget alert".split()
)
COMMENTS = frozenset("comment comments disqus reply replies".split())
ARTICLE = frozenset({"article", "main"})
WRAPPERS = frozenset("div section form table tbody tr td article main".split())
ENDED_BY = {t: [k for k, ends in ENDS.items() if t in ends] for t in set().union(*ENDS.values())}

PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


class Node:
    __slots__ = ("tag", "out", "parent", "children", "inside", "chars", "tags", "links", "link_tags", "density", "sum", "best", "kept")

    def __init__(self, tag: str, out: bool, parent: Node | None):
        self.tag, self.out, self.parent, self.children = tag, out, parent, []
        self.inside = tag in ARTICLE or bool(parent and parent.inside)
        self.chars = self.tags = self.links = self.link_tags = 0
        self.density = self.sum = 0.0
        self.best, self.kept = self, False


def labels_of(attributes: str) -> tuple[set[str], bool]:
    """Words in class, id and role; whether the element is hidden."""
    words, hidden = set(), False
    if attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id", "role"):
                words.update(LABEL.findall(value))
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
    return words, hidden


def left_out(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element never holds the article; whether it holds reader comments."""
    words, hidden = labels_of(attributes)
    comments = bool(words & COMMENTS)
    if hidden or comments or tag in LEFT_OUT:
        return True, comments
    if tag in ARTICLE:
        return False, False
    if not inside and (tag == "header" or "header" in words and tag in ("div", "section", "table", "td")):
        return True, False
    return bool(words & LABELS), False


def parse(page: str) -> list[Node]:
    """Nodes in page order, the first the root; text is held by the element it is in.

    Missing end tags are supplied as browsers do for paragraphs, list items and
    cells; stray end tags are ignored; a tag that never ends ends the page.
    """
    root = Node("body", False, None)
    nodes, top, pos, size = [root], root, 0, len(page)
    opened: Counter[str] = Counter()
    commented: set[Node] = set()

    def leave(node: Node) -> Node:
        """Close everything that is open inside ``node`` and the node itself."""
        at = top
        while at is not node:
            opened[at.tag] -= 1
            at = at.parent
        opened[node.tag] -= 1
        return node.parent

    while pos < size:
        at = page.find("<", pos)
        if at < 0:
            at = size
        if at > pos:
            top.children.append(html.unescape(page[pos:at]))
        if at == size:
            break
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            pos = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            pos = size if end < 0 else end + 1
            continue
        found = TAG.match(page, at) or LOOSE_TAG.match(page, at)
        if not found:
            if not page.startswith("</", at) and not page[at + 1 : at + 2].isalpha():
                top.children.append("<")
                pos = at + 1
                continue
            end = page.find(">", at)
            if end < 0:
                break
            pos = end + 1
            continue
        pos = found.end()
        tag = found[2].lower()
        if found[1]:
            if opened[tag] > 0:
                node = top
                while node.tag != tag:
                    node = node.parent
                top = leave(node)
            continue
        if tag in ("html", "body"):
            continue
        if any(opened[t] > 0 for t in ENDED_BY.get(tag, ())):
            node = top
            while node.parent:
                if tag in ENDS.get(node.tag, ()):
                    top = leave(node)
                    break
                if node.tag in SCOPE:
                    break
                node = node.parent
        out, comments = left_out(tag, found[3], top.inside)
        new = Node(tag, out, top)
        nodes.append(new)
        top.children.append(new)
        if tag in ARTICLE and not out:  # a wrapper's labels do not count against the article in it
            node = top
            while node.parent and node.tag in WRAPPERS and node not in commented:
                node.out = False
                node = node.parent
        if comments:
            commented.add(new)
        if tag in RAW and not found[3].rstrip().endswith("/"):
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(page, pos)
            pos = page.find(">", end.start()) + 1 if end else 0
            if not pos:
                break
        elif tag not in VOID:
            top = new
            opened[tag] += 1
    return nodes


def weigh(nodes: list[Node]) -> None:
    """Characters, tags and links of every node, then density and sum of the children's densities."""
    for node in nodes:  # page order: parents come first
        node.out = node.out or bool(node.parent and node.parent.out)
    for node in reversed(nodes):
        if node.out:
            continue
        own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own
        if node.tag == "a":
            node.links, node.link_tags = node.chars, node.link_tags + 1
        if node.parent:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.links += node.links
            up.link_tags += node.link_tags
    body = nodes[0]
    share = body.links / max(body.chars, 1)
    for node in reversed(nodes):
        if node.out or not node.chars:
            continue
        tags, links, link_tags = max(node.tags, 1), max(node.links, 1), max(node.link_tags, 1)
        base = math.log(node.chars / max(node.chars - node.links, 1) * links + share * node.chars + math.e)
        ratio = node.chars / links * tags / link_tags
        node.density = node.chars / tags * math.log(max(ratio, 1.0) + 1e-9) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else 0.0
        if node.density < 0:
            node.density = 0.0
    for node in nodes:
        parts = [c for c in node.children if isinstance(c, Node) and not c.out and c.tag in BLOCK]
        node.sum = sum(c.density for c in parts) if parts else node.density


def choose(nodes: list[Node]) -> None:
    """Mark the maximum-sum subtree, and what reaches the threshold of its path to the body."""
    whole = [n for n in nodes if not n.out and n.chars and (n.tag in BLOCK or n.parent is None)]
    if not whole:
        return
    for node in reversed(whole):  # the first of equals: the outermost
        up = node.parent
        if node.sum >= node.best.sum:
            node.best = node
        while up and up.tag not in BLOCK:
            up = up.parent
        if up and node.best.sum >= up.best.sum:
            up.best = node.best
    best = nodes[0].best
    path, node = [], best
    while node:
        path.append(node)
        node = node.parent
    best.kept = True
    threshold = min(n.density for n in path)
    work = [nodes[0]]
    while work:
        node = work.pop()
        if node.density >= threshold:
            if node.tag in BLOCK:
                node.best.kept = True
            work += [c for c in node.children if isinstance(c, Node) and not c.out and c.chars]


def main_text(page: str | None) -> str:
    """The article's blocks joined by line feeds; empty if there is none."""
    nodes = parse(page or "")
    weigh(nodes)
    choose(nodes)
    blocks: list[str] = []
    open_block: list[str] = []

    def close():
        text = " ".join("".join(open_block).split())
        if text:
            blocks.append(text)
        open_block.clear()

    work: list[tuple[object, bool]] = [(nodes[0], nodes[0].kept)]
    while work:
        item, inside = work.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            if inside:
                open_block.append(item)
        elif not item.out:
            inside = inside or item.kept
            edge = item.tag in BLOCK
            if edge:
                close()
                work.append((None, False))
            elif item.tag == "br" and inside:
                open_block.append(" ")
            work.extend((c, inside) for c in reversed(item.children))
    close()
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages (page_id, url, html)``.

    Null and empty pages and pages without an article have the empty text; repeated
    rows, missing ids and missing addresses give a row each; an empty table gives
    none; further columns are not looked at.
    """

    def read(batches):
        for batch in slices(batches, 32):
            texts = [main_text(p) for p in column(batch, "html")]
            yield pa.RecordBatch.from_pydict(
                {"page_id": column(batch, "page_id"), "url": column(batch, "url"), "text": texts, "n_chars": [len(t) for t in texts]}, PAGES
            )

    return first_column(pages, "page_id", "url", "html").mapInArrow(read, "page_id long, url string, text string, n_chars long")
