"""Main text of web pages by tree scoring.

A page is parsed into a tree (unclosed paragraphs and list items are closed as browsers do). Every
block of text passes points for its length and commas to its ancestors, half as many with each container
on the way; a container's points are discounted by the share of its text that is link text. The container
with the most points and all of its siblings whose text is not mostly links are kept. Menus, page headers,
footers, side columns, notices, adverts, forms, scripts, styles and reader comments are cut out first
and never score; what a class or id alone calls so is not cut if it holds nearly all of the page's text. Sums run
once over the tree, so a page costs time in proportion to its size, however deep it nests.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr
ul""".split())
#: Elements that never hold article text.
CUT = frozenset("""aside audio button canvas dialog embed footer form head iframe input label map menu nav noscript object option
script select style svg template textarea title video""".split())
#: Words of class, id or role that mark what is not article text.
MARKS = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs combx comment comments community
complementary consent contentinfo cookie cookies disclaimer disqus footer gdpr header legal login masthead menu modal nav navbar
navigation newsletter notice notices overlay pager pagination popup promo promoted promotion related replies respond share sharing
sidebar signup skyscraper social sponsor sponsored subscribe subscription toolbar widget""".split())
#: Of these the ones that also mark by ending a compound name, as in ``site-footer``; the others are often about the article.
ENDINGS = MARKS - frozenset("header legal menu related replies respond share sharing social community consent alert notices".split())
#: First parts of a compound name that deny or describe what follows.
DENIED = frozenset("has hide is no non not off with without".split())
#: An element that starts closes open elements of these kinds, unless one of the stops lies between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
          "option": ({"option"}, {"select"})}
CONTAINER = frozenset("article body blockquote center details div dl figure main ol section table td ul".split())
WORD = re.compile(r"[A-Za-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "marks", "up", "kids", "points")

    def __init__(self, tag: str, marks: str, up: "Node | None") -> None:
        self.tag, self.marks, self.up, self.kids, self.points = tag, marks, up, [], 0.0


class Tree(HTMLParser):
    """Builds the tree; ``root`` is above ``html``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", "", None)
        self.nodes = [self.root]  # parents before children

    def close(self) -> None:
        # An unfinished tag or reference at the end counts as text unless it is a tag.
        super().close()

    def _leave(self, kinds: set, stops: set) -> None:
        n = self.now
        while n.up is not None and n.tag not in stops:
            if n.tag in kinds:
                self.now = n.up
                return
            n = n.up

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self._leave({"p"}, CONTAINER)
        if tag in CLOSES:
            self._leave(*CLOSES[tag])
        new = Node(tag, " ".join(v for k, v in attrs if k in ("class", "id", "role") and v), self.now)
        self.now.kids.append(new)
        self.nodes.append(new)
        if tag not in VOID:
            self.now = new

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._leave({tag}, set())

    def handle_data(self, data: str) -> None:
        self.now.kids.append(data)


def marked(names: str) -> bool:
    """Whether a name in class, id or role says that the element is not article text.

    A name does if it is one of ``MARKS`` as a whole, or is compound and ends with one of ``ENDINGS``,
    unless its first part denies it: ``sidebar`` and ``left-sidebar`` do, ``no-sidebar`` and ``related-work`` do not.
    """
    for name in names.split():
        if name.lower() in MARKS:
            return True
        parts = [w.lower() for w in WORD.findall(CAMEL.sub(" ", name))]
        if len(parts) > 1 and parts[-1] in ENDINGS and parts[0] not in DENIED:
            return True
    return False


def unwanted(tree: Tree) -> set[Node]:
    """The elements to cut out: by their kind, or by their names unless nearly all of the page's text is in them."""
    size = dict.fromkeys(tree.nodes, 0)
    for n in reversed(tree.nodes):
        if n.tag not in CUT:
            size[n] += sum(len(k.strip()) for k in n.kids if isinstance(k, str))
            if n.up is not None:
                size[n.up] += size[n]
    whole = size[tree.root]
    return {n for n in tree.nodes if n.tag in CUT or n.marks and n.tag not in ("html", "body", "article", "main") and 10 * size[n] <= 9 * whole and marked(n.marks)}


class Block:
    __slots__ = ("parts", "up", "linked")

    def __init__(self, up: Node) -> None:
        self.parts, self.up, self.linked = [], up, 0


def blocks(root: Node, cut: set[Node]) -> list[Block]:
    """The blocks of text in page order, without the parts that are cut out. Not recursive: pages may nest deeply."""
    out, todo = [], [(root, False, False)]
    now = Block(root)
    while todo:
        n, in_article, in_link = todo.pop()
        if isinstance(n, str):
            now.parts.append(n)
            if in_link:
                now.linked += len(n)
            continue
        if isinstance(n, Block):  # after a block element: what follows is a block of its own
            out.append(now)
            now = Block(n.up)
            continue
        if n in cut or n.tag == "header" and not in_article:
            if n.tag in BLOCK:
                out.append(now)
                now = Block(now.up)
            continue
        if n.tag == "br":
            now.parts.append("\n")
            continue
        if n.tag in BLOCK:
            out.append(now)
            todo.append((Block(now.up), False, False))
            now = Block(n)
        inside = in_article or n.tag in ("article", "main")
        todo.extend((k, inside, in_link or n.tag == "a") for k in reversed(n.kids))
    out.append(now)
    return out


def main_text(html: str | None) -> str:
    """The main text of one page: its blocks, white space within a block as one space, joined by line feeds."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    found = []
    for b in blocks(tree.root, unwanted(tree)):
        if text := " ".join("".join(b.parts).split()):
            found.append((b, text))
    length, linked, whole, passed = ({} for _ in range(4))
    for b, text in found:
        points = 1 + text.count(",") + min(len(text) / 100, 3.0)
        for sums, x in ((length, len(text)), (linked, min(b.linked, len(text))), (whole, points), (passed, points)):
            sums[b.up] = sums.get(b.up, 0) + x
    scored = []
    for n in reversed(tree.nodes):  # children before parents
        if n not in length:
            continue
        if n.tag in CONTAINER:
            # A whole article element gets all of its blocks' points, however deep they lie.
            n.points = whole[n] if n.tag in ("article", "main") else passed[n]
            passed[n] /= 2
            scored.append((n.points * (1 - linked[n] / length[n]), n))
        if n.up is not None:
            for sums in (length, linked, whole, passed):
                sums[n.up] = sums.get(n.up, 0) + sums[n]
    if not scored:
        return "\n".join(t for _, t in found)
    scored.reverse()
    # Ties: the last one met in page order, which is the inner one.
    top = max(score for score, _ in scored)
    best = next(n for score, n in reversed(scored) if score == top)
    keep = {best}
    for k in best.up.kids if best.up is not None and best.tag != "body" else ():
        if isinstance(k, Node) and k in length and 4 * linked[k] < length[k]:
            keep.add(k)
    if best.tag != "body" and best.up is not None and best.up.tag in ("article", "main", "section"):
        keep.add(best.up)
    inside = set()
    for n in tree.nodes:  # parents before children
        if n in keep or n.up in inside:
            inside.add(n)
    return "\n".join(text for b, text in found if b.up in inside)


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages (page_id, url, html)``.

    Null or empty html, or html without text, gives an empty text. Null ids and urls stay null, repeated
    rows stay repeated, an empty table gives no rows, other columns are ignored. Each page is parsed on
    its own inside a task; nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", F.col("html")).mapInArrow(run, f"{kinds}, text string, n_chars long")
