"""Main text of web pages by composite text density.

A page becomes a small tree. Every node gets its link-adjusted characters per tag; the node with the
largest sum over its children leads; what stands beside its path to the body stays where its density
reaches the least density on that path.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.common import sent_whole, table

sent_whole(__name__)

MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*+(?:=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key ends an open element of the set.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "tbody", "thead"},
}
#: Where the search for such an open element stops.
BARRIERS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
    "option": {"select"}, "optgroup": {"select"}, "tbody": {"table"},
}

#: Never part of an article, unless they are the wrapper of the page's main part.
DROPPED = frozenset(
    "head nav footer aside form button select input svg canvas audio video object embed dialog menu search map".split()
) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Never text at all, so that they do not count in the text of a page and are never opened.
CONTROLS = RAW | frozenset("head select button svg canvas audio video object embed map".split())
#: Words of class and id that mark menus, adverts, notices and comments.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner"
    " nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidenav aside footer masthead toolbar pagination pager"
    " cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup signin login paywall"
    " share sharing social related recommended recommendations widget widgets"
    " comment comments commentlist disqus replies respond".split()
)
#: Tag of text and inline elements that stand directly beside blocks.
RUN = "#run"
#: As a whole class or id they name an advert, beside a page's landmark whatever its size.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored".split())
ADVERT = "#advert"
HEADERS = frozenset(("header",))
LANDMARKS = frozenset(("article", "main"))
#: Beside the path, what is not mostly links counts so many times inside a landmark that the path runs through; headings there stay.
LANDMARK_WEIGHT = 50
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
#: Blocks of text: beside the path they stay, at any density, where the path meets no landmark and few links.
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure table".split()) | {RUN}
TITLES = frozenset("h1 h2".split())
#: An ancestor is of one kind with the densest node if its share of text outside links is at least so much of that node's.
NEAR = 0.9
#: A landmark beside the path's landmark stays if it has at least so much of its text.
LEAST_SIBLING = 0.25


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "landmark", "chars", "tags", "link_chars", "link_tags", "density", "total", "structure", "words", "main")

    def __init__(
        self, tag: str, parent: Node | None, dropped: bool = False, landmark: bool = False, words: frozenset[str] = frozenset(), main: bool = False
    ) -> None:
        self.tag, self.parent, self.dropped, self.landmark = tag, parent, dropped, landmark
        #: Words of class and id that speak against it; whether it is, or holds, the one main part that a page names.
        self.words, self.main = words, main
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        #: A block, holds one, or is a run of text and inline elements beside blocks.
        self.structure = tag in BLOCKS or tag == RUN


def _kind(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, frozenset[str], bool]:
    """Whether an element is left out, whether it is a landmark, the words against it, and whether it is marked as the page's main part.

    ``inside`` says whether it stands in a landmark.
    """
    if tag in DROPPED:
        return True, False, frozenset(), False
    landmark = tag in LANDMARKS
    main = tag == "main"
    words: frozenset[str] = frozenset()
    header = False
    if attributes and not attributes.isspace():
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
        role = found.get("role", "").lower()
        said = set(re.split(r"[^a-z0-9]+", f"{found.get('class', '')} {found.get('id', '')}".lower()))
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
            return True, False, frozenset(), False
        if role in DROPPED_ROLES and tag not in ("html", "body", "main"):
            return True, False, frozenset(), False
        main = main or role == "main" or found.get("itemprop", "") == "articleBody"
        landmark = landmark or main or role == "article"
        words = DROPPED_WORDS & said
        if words and not ADVERTS.isdisjoint(f"{found.get('class', '')} {found.get('id', '')}".lower().split()):
            words |= {ADVERT}
        header = "header" in said
    if not landmark and (tag in HEADERS or header) and not inside:
        if tag in HEADERS:
            return True, False, frozenset(), False
        words |= {"header"}
    return False, landmark, words, main


def _plain(root: Node) -> int:
    """Characters outside links, of all text but that of what is never text; the text of navigation, footers and the like counts."""
    total, stack = 0, [root]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, str):
                total += len("".join(child.split()))
            elif child.tag != "a" and child.tag not in CONTROLS:
                stack.append(child)
    return total


def _open_wrappers(root: Node) -> None:
    """Open the elements left out by tag, role or hiding that wrap the main part: forms around whole pages and the like.

    Such an element holds more than half of the text outside links, and no landmark outside of it has text.
    What is left out inside it is judged in the same way; controls, scripts and styles are never opened.
    """
    order, stack, any_dropped = [], [root], False
    while stack:
        node = stack.pop()
        order.append(node)
        any_dropped |= node.dropped
        stack += [c for c in node.children if isinstance(c, Node) and c.tag != "a" and c.tag not in CONTROLS]
    if not any_dropped:
        return
    plain: dict[int, int] = {}
    named: dict[int, int] = {}
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, Node) and id(c) in plain]
        plain[id(node)] = sum(plain[id(c)] for c in inner) + sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        named[id(node)] = plain[id(node)] if node.landmark else sum(named[id(c)] for c in inner)
    stack = [root]
    while stack:
        node = stack.pop()
        if node.dropped and 2 * plain[id(node)] > plain[id(root)] and named[id(node)] == named[id(root)]:
            node.dropped = False
        if not node.dropped:
            stack += [c for c in node.children if isinstance(c, Node) and id(c) in plain]


def _drop_marked(root: Node) -> None:
    """Leave out the elements that a word of class or id speaks against.

    Landmarks and what holds the page's main part stay, and so do elements whose word covers the larger
    part of the text outside links: there the word tells nothing. Only an advert by its whole class or id
    goes at any size, on a page that has a landmark not within it. Words never take all text of a page.
    """
    marked, order, stack = [], [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        if node.words and not node.landmark:
            marked.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
    if not marked:
        return
    holders: set[int] = set()
    for node in reversed(order):
        if node.parent is not None:
            node.parent.main |= node.main
            if node.landmark or id(node) in holders:
                holders.add(id(node.parent))
    marked = [n for n in marked if not n.main]
    all_text = _plain(root)
    covered: dict[str, int] = {}
    seen: dict[int, frozenset[str]] = {}
    at_mark = {id(n) for n in marked}
    for node in order:
        above = seen[id(node.parent)] if node.parent is not None else frozenset()
        if id(node) in at_mark and (new := node.words - above):
            size = _plain(node)
            for word in new:
                covered[word] = covered.get(word, 0) + size
            above |= new
        seen[id(node)] = above
    marked = [
        n for n in marked
        if any(2 * covered[w] <= all_text for w in n.words) or (ADVERT in n.words and id(root) in holders and id(n) not in holders)
    ]
    for node in marked:
        node.dropped = True
    if not any(not c.isspace() for n in _page_order(root) for c in n.children if isinstance(c, str)):
        for node in marked:
            node.dropped = False


class Open:
    """The open elements while a page is read, with the depths of each tag, so that no search walks through them."""

    LANDMARK = "#landmark"

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.depths: dict[str, list[int]] = {}

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        for name in (node.tag, self.LANDMARK) if node.landmark else (node.tag,):
            self.depths.setdefault(name, []).append(len(self.nodes))
        self.nodes.append(node)

    def deepest(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element of these tags; 0 if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _cut(self, depth: int) -> None:
        while len(self.nodes) > depth:
            node = self.nodes.pop()
            for name in (node.tag, self.LANDMARK) if node.landmark else (node.tag,):
                self.depths[name].pop()

    def close(self, tag: str) -> None:
        """An end tag: closes the innermost open element of the tag and all inside it, if there is one."""
        if depth := self.deepest((tag,)):
            self._cut(depth)

    def end(self, tags: Iterable[str], barriers: Iterable[str]) -> None:
        """A start tag that ends an open element of ``tags`` inside the innermost barrier."""
        while (depth := self.deepest(tags)) > self.deepest(barriers):
            self._cut(depth)
            # A cell or row that ends takes the others of its set along.
            if self.top.tag not in tags:
                return


def parse(html: str) -> Node:
    """The tree of a page, without elements that are never content; ends of elements are implied as browsers do."""
    root = Node("html", None)
    at, opened = 0, Open(root)
    scan, end = MARKUP.search, len(html)
    last = html.rfind(">")
    while at < end:
        if at > last:
            # Nothing but a comment without end can be markup here.
            opened.top.children.append(html[at:].partition("<!--")[0])
            break
        found = scan(html, at)
        text = html[at : found.start()] if found else html[at:]
        if text:
            opened.top.children.append(text)
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            opened.close(tag)
            continue
        if tag == "body" or tag in BLOCKS:
            opened.close("head")
        if tag in ("html", "body"):
            continue
        if tag in BLOCKS:
            opened.end(("p",), ("table", "td", "th", "button"))
        if tag in ENDS:
            opened.end(ENDS[tag], BARRIERS[tag])
        attributes = found[3] or found[6] or ""
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = stop.end() if stop else end
            continue
        if tag == "br":
            opened.top.children.append(" ")
            continue
        child = Node(tag, opened.top, *_kind(tag, attributes, opened.deepest((Open.LANDMARK,)) > 0))
        opened.top.children.append(child)
        if tag not in VOID and not (attributes.endswith("/") and tag not in BLOCKS):
            opened.push(child)
    _open_wrappers(root)
    _drop_marked(root)
    return root


def _runs(order: list[Node]) -> None:
    """Make every run of text and inline elements that stands beside blocks a node of its own; what is dropped ends no run."""
    for node in reversed(order):
        if node.parent is not None and node.structure:
            node.parent.structure = True
    for node in order:
        parts: list[Node | str] = []
        run: list[Node | str] = []
        blocks = [isinstance(c, Node) and not c.dropped and c.structure for c in node.children]
        if True not in blocks or False not in blocks:
            continue
        for child, block in zip([*node.children, None], [*blocks, True], strict=True):
            if not block:
                run.append(child)
                continue
            if any(isinstance(c, Node) or not c.isspace() for c in run):
                held = Node(RUN, node)
                held.children = run
                for c in run:
                    if isinstance(c, Node):
                        c.parent = held
                run = [held]
            parts += run
            run = []
            if child is not None:
                parts.append(child)
        node.children = parts


def _page_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
    return order


def weigh(root: Node) -> list[Node]:
    """Fill in counts and densities; the nodes in page order, dropped subtrees left out.

    A run is a leaf, and so is a block without blocks, as it holds one run: inline elements are no tags of theirs.
    """
    _runs(_page_order(root))
    order = _page_order(root)
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + (child.tag != RUN)
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars = node.chars
            node.link_tags += 1
    holders = {n.parent for n in order if n.structure and n.parent is not None}
    leaves = {n for n in order if (n.structure or n is root) and n not in holders}
    page_links = root.link_chars / max(1, root.chars)
    for node in order:
        if node.chars:
            plain = max(1, node.chars - node.link_chars)
            base = math.log(node.chars / plain * node.link_chars + page_links * node.chars + math.e)
            tags = 1 if node in leaves else max(1, node.tags)
            ratio = node.chars / max(1, node.link_chars) * tags / max(1, min(node.link_tags, tags))
            # The base is at least e: without links it would be 1, which is no base.
            node.density = node.chars / tags * math.log(max(1.0, ratio)) / math.log(max(base, math.e))
    for node in order:
        if node in leaves:
            node.total = node.density
        elif node.structure or node is root:
            node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.dropped)
    return order


def _plain_share(node: Node) -> float:
    """Share of text outside links, children that are mostly links left aside."""
    held = [c for c in node.children if isinstance(c, Node) and not c.dropped and 2 * c.link_chars > c.chars]
    chars = node.chars - sum(c.chars for c in held)
    return (chars - node.link_chars + sum(c.link_chars for c in held)) / max(1, chars)


def chosen(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order.

    The densest node, and beside its path what reaches the least density on it. Where the path meets no
    landmark, titles stay, and so do paragraphs, lists and bare text in ancestors with as few links as
    the densest node: leads and closing words are short. Beside a landmark on the path, another
    of some size stays that is not mostly links, and none of whose class or id a word speaks against alone.
    """
    order = weigh(root)
    best = max(order, key=lambda n: n.total) if any(n.total for n in order) else root
    if best is root:
        return [root]
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    least = min(n.density for n in path)
    marked = max((at for at, n in enumerate(path) if n.landmark), default=0)
    on_path, keep = {id(n) for n in path}, {id(best)}
    bare = not any(n.landmark for n in path)
    near = 0
    while bare and near + 2 < len(path) and _plain_share(path[near + 1]) >= NEAR * _plain_share(best):
        near += 1
    for at, node in enumerate(path[1:], 1):
        along = path[at - 1]
        for child in node.children:
            if isinstance(child, Node) and not child.dropped and child.chars and id(child) not in on_path:
                inside = at <= marked and 2 * child.link_chars <= child.chars
                weight = LANDMARK_WEIGHT if inside else 1
                texty = 2 * child.link_chars <= child.chars
                if bare and texty and (child.tag in TITLES or (at <= near and child.tag in TEXTS)):
                    keep.add(id(child))
                if along.landmark and child.landmark:
                    if child.words - along.words:
                        continue
                    if texty and child.chars - child.link_chars >= LEAST_SIBLING * (along.chars - along.link_chars):
                        keep.add(id(child))
                if (inside and child.tag in HEADINGS) or child.density * weight >= least:
                    keep.add(id(child))
    return [n for n in order if id(n) in keep]


def text_of(nodes: list[Node]) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if line := " ".join(unescape("".join(run)).split()):
            blocks.append(line)
        run.clear()

    for top in nodes:
        flush()
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                run.append(item)
            elif not item.dropped:
                if item.tag in BLOCKS:
                    flush()
                    stack.append(None)
                stack += reversed(item.children)
    flush()
    return "\n".join(blocks)


def main_text(html: str | None) -> str:
    """The main text of a page; empty for null, empty and text-free pages."""
    return text_of(chosen(parse(html))) if html else ""


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every row, row by row: nothing is shuffled, nothing is cut.

    Null ids and urls pass through; repeated rows give repeated results; extra columns are ignored;
    an empty table gives no rows. A page is held whole in one task, and its time grows with its length alone,
    also for hundreds of thousands of elements that are never closed.
    """
    picked = df.select(id_col, url_col, html_col)
    schema = f"{id_col} {picked.schema[0].dataType.simpleString()}, {url_col} string, text string, n_chars bigint"

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    return picked.mapInArrow(pages, schema)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
