"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import decoded, text_bytes

# A comment, a declaration, or a tag with its attributes; quotes may hold ">".
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_NAMES = re.compile(r"[a-z]+")

# Elements whose content is no markup.
_RAW = frozenset("script style textarea title noscript noembed noframes iframe xmp template svg math".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that an opening tag of the same group closes, up to one of the borders.
_CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "option": ("option", "select"), "tbody": ("tbody thead tfoot tr td th", "table"),
    "thead": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table"),
}
_CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _CLOSES.items()}

# Elements and words of class, id and role that never belong to an article's text.
_DROPPED = frozenset("nav aside footer form button select dialog search menu input object".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar status tablist".split()
)
_STRONG = frozenset(
    "ad ads advert advertisement adverts adsbygoogle adbox sponsor sponsored promo promotion "
    "comment comments commentlist disqus replies respond cookie cookies consent gdpr "
    "breadcrumb breadcrumbs newsletter".split()
)
_WEAK = frozenset(
    "nav navbar navigation menu menubar topbar sidebar aside rail footer masthead banner notice "
    "notices alert popup modal overlay subscribe subscription signup login share sharing social "
    "related recommended recommendations widget toolbar pagination pager skip outbrain taboola "
    "disclaimer discussion reply paywall".split()
)
# Readers' own texts; a page without other paragraphs may be all of these.
_READERS = frozenset("comment comments commentlist disqus replies reply respond discussion".split())
_POSITIVE = frozenset("article body content entry main page post story text".split())
# Words that say nothing about what an element holds. A name with any other word besides
# the listed ones, such as share-price or ad-free-story, is not one of theirs.
_PLAIN = frozenset(
    "area bar block bottom box btn button buttons col column container content count footer form "
    "group header holder icon icons inline inner item items left link links list module outer panel "
    "right row section site slot small thread title top unit wrap wrapper".split()
)

# Levels of nesting, as in browsers; deeper elements stand beside each other.
DEPTH = 512
# A real paragraph has so many characters, a quarter of them in links at most.
_PARAGRAPH = 80
# Lists and the like that belong to the text beside them unless they are made of links.
_BESIDE = frozenset("ul ol dl table blockquote pre figure".split())


class Node:
    __slots__ = ("tag", "parent", "depth", "names", "role", "children", "texts", "links", "score", "hidden", "points")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "") -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []
        self.score = self.points = 0.0
        self.texts = self.links = 0
        self.role, self.hidden = "", False
        # The words of each class and of the id.
        self.names: list[frozenset[str]] = []
        if attributes:
            named = {
                m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "")
                for m in _ATTRIBUTE.finditer(attributes)
            }
            self.role = named.get("role", "").strip().lower()
            style = named.get("style", "").replace(" ", "").lower()
            self.hidden = (
                "hidden" in named
                or named.get("aria-hidden", "").lower() == "true"
                or "display:none" in style
                or "visibility:hidden" in style
            )
            label = f"{named.get('class', '')} {named.get('id', '')}"
            self.names = [
                frozenset(_NAMES.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
                for name in label.split()
            ]


def parse(page: str) -> Node:
    """Blocks, links and dropped elements of a page as a tree; other inline tags fall away."""
    root = here = Node("html", None)
    # Elements too deep to be nested, by tag: their end tags end nothing.
    flat: Counter[str] = Counter()
    at = 0
    while True:
        match = _TOKEN.search(page, at)
        if not match:
            here.children.append(html.unescape(page[at:]))
            return root
        if match.start() > at:
            here.children.append(html.unescape(page[at : match.start()]))
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        if not closing and tag in _RAW:
            if not attributes.endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            here.children.append(" ")
        elif tag == "hr":
            here.children.append(Node("hr", here))
        elif tag in _VOID or tag in ("html", "body"):
            continue
        elif closing and flat[tag]:
            flat[tag] -= 1
            here.children.append(Node("hr", here) if tag in _BLOCKS else " ")
        elif closing:
            here = _closed(here, tag)
        elif tag in _BLOCKS or tag in _DROPPED or tag == "a":
            here = _opened(here, tag)
            node = Node(tag, here, attributes)
            if node.depth > DEPTH:
                flat[tag] += 1
                here.children.append(Node("hr", here) if tag in _BLOCKS else " ")
                continue
            here.children.append(node)
            here = node
        elif attributes and (inline := Node(tag, here, attributes)) and (_is_dropped(inline) or _is_named(inline)):
            if inline.depth <= DEPTH:
                here.children.append(inline)
                here = inline


def _closed(here: Node, tag: str) -> Node:
    """Where the end tag leads: out of the nearest such element, if one is open."""
    node: Node | None = here
    while node and node.tag != tag:
        # A stray end tag of an inline element does not close blocks around it.
        if tag not in _BLOCKS and node.tag in _BLOCKS:
            return here
        node = node.parent
    return node.parent if node and node.parent else here


def _opened(here: Node, tag: str) -> Node:
    """Where a start tag goes, after the elements that it ends."""
    if tag in _CLOSES:
        ended, borders = _CLOSES[tag]
        node: Node | None = here
        while node and node.tag not in borders:
            if node.tag in ended and node.parent:
                here = node.parent
            node = node.parent
    if tag in _BLOCKS:
        node = here
        while node and node.tag not in ("td", "th", "table", "button"):
            if node.tag == "p" and node.parent:
                return node.parent
            if node.tag in _BLOCKS:
                break
            node = node.parent
    return here


def _is_dropped(node: Node) -> bool:
    """Not seen, or by its element or role no part of a text."""
    return node.hidden or node.tag in _DROPPED or node.role in _ROLES


def _is_named(node: Node) -> bool:
    """Some class or id is made of words for what surrounds a text, and of no others."""
    if node.tag in ("html", "article", "main") or node.role in ("main", "article"):
        return False
    for words in node.names:
        if words & _STRONG and words <= _STRONG | _WEAK | _PLAIN | _POSITIVE:
            return True
        if words & _WEAK and words <= _STRONG | _WEAK | _PLAIN and not any(n & _POSITIVE for n in node.names):
            return True
    return False


def _readers(node: Node) -> bool:
    return any(words & _READERS for words in node.names)


def _is_header(node: Node) -> bool:
    return node.tag == "header" or any(
        "header" in words and words <= _PLAIN | _WEAK and not words & _POSITIVE for words in node.names
    )


def _own_text(node: Node) -> int:
    return sum(len(child.strip()) for child in node.children if isinstance(child, str))


def _in_order(root: Node) -> list[Node]:
    order = [root]
    for node in order:
        order += [child for child in node.children if isinstance(child, Node)]
    return order


def _pruned(root: Node) -> None:
    """Takes unwanted elements out, except those that hold the article itself.

    What is hidden, or by element or role no text, goes. An element with a name for
    surroundings goes too, unless that is only how the page calls its whole text: where
    no article element tells, one that holds more than half of the paragraph points
    stays, and one of readers' comments if no paragraph is left outside of it.
    """
    holds = set()
    for node in _in_order(root):
        if node.tag in ("article", "main") or node.role == "main":
            up = node.parent
            while up and id(up) not in holds:
                holds.add(id(up))
                up = up.parent
    for node in _in_order(root):
        kept = []
        for child in node.children:
            if isinstance(child, Node) and id(child) not in holds:
                if _is_dropped(child):
                    kept.append(_gap(child))
                    continue
                if _is_header(child) and not _is_named(child):
                    # A page's header goes; an article's leaves its headings.
                    kept += _headings(child) if _inside_article(node) else [_gap(child)]
                    continue
            kept.append(child)
        node.children = kept
    order = _in_order(root)
    for node in reversed(order):
        own = _own_text(node)
        if own and node.tag != "a" and node.tag not in _HEADINGS:
            node.points += _points(node, own)
        if node.parent:
            node.parent.points += node.points
    named = [node for node in order if id(node) not in holds and _is_named(node)]
    if not named:
        return
    inside = set(map(id, named))
    for node in order:
        if node.parent and id(node.parent) in inside:
            inside.add(id(node))
    left = [node for node in order if id(node) not in inside and _own_text(node) >= _PARAGRAPH and node.tag != "a"]
    gone = {id(node) for node in named if holds or not _is_whole_text(node, root, bool(left))}
    for node in order:
        if any(id(child) in gone for child in node.children):
            node.children = [_gap(child) if id(child) in gone else child for child in node.children]


def _is_whole_text(node: Node, root: Node, others: bool) -> bool:
    if _readers(node):
        return not others and node.points > root.points / 2
    return node.points > root.points / 2


def _gap(node: Node) -> Node | str:
    """What an element leaves behind: the end of a block, or of a word."""
    return Node("hr", node.parent) if node.tag in _BLOCKS else " "


def _inside_article(node: Node | None) -> bool:
    while node:
        if node.tag in ("article", "main"):
            return True
        node = node.parent
    return False


def _headings(header: Node) -> list[Node | str]:
    found: list[Node | str] = []
    waiting = [header]
    while waiting:
        node = waiting.pop()
        if node.tag in _HEADINGS:
            node.parent = header.parent
            found.append(node)
        else:
            waiting += [
                c for c in reversed(node.children) if isinstance(c, Node) and not (_is_dropped(c) or _is_named(c))
            ]
    return found


def _scored(root: Node) -> Node:
    """Scores ancestors by their paragraphs; gives the best container.

    A paragraph is an element with text of its own. Its points are one, one for each
    comma and one for each hundred characters, up to three. The parent gets all, the next
    ancestors a half, a sixth, a ninth and so on up to five levels. A container's score is
    discounted by the share of its text that is in links.
    """
    order = _in_order(root)
    for node in reversed(order):
        text = _own_text(node)
        node.texts += text
        if node.tag == "a":
            node.links = node.texts
        if node.parent:
            node.parent.texts += node.texts
            node.parent.links += node.links
        if text and node.tag != "a" and node.tag not in _HEADINGS:
            points = _points(node, text)
            up, level = node.parent or node, 0
            while up and level < 5:
                up.score += points / (1, 2, 6, 9, 12)[level]
                up, level = up.parent, level + 1
    best = root
    for node in order:
        if node.tag in ("p", "a", "hr") or node.tag in _HEADINGS:
            continue
        node.score *= 1 - node.links / max(node.texts, 1)
        if node.score > best.score or best is root and node.score:
            best = node
    return best


def _points(node: Node, text: int) -> float:
    own = [child for child in node.children if isinstance(child, str)]
    commas = sum(part.count(",") + part.count("、") + part.count("，") for part in own)
    return 1 + commas + min(text / 100, 3)


def _blocks(nodes: list[Node | str]) -> list[str]:
    """Texts of the blocks in page order, white space as one space, empty ones left out."""
    blocks, current = [], []

    def end() -> None:
        text = _SPACES.sub(" ", "".join(current)).strip(" ")
        current.clear()
        if text:
            blocks.append(text)

    waiting: list[Node | str | None] = list(reversed(nodes))
    while waiting:
        node = waiting.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            current.append(node)
        elif node.tag in _BLOCKS:
            end()
            waiting.append(None)
            waiting += reversed(node.children)
        else:
            waiting += reversed(node.children)
    end()
    return blocks


def main_text(page: str) -> str:
    """The article of a page, one line per block.

    The best container is kept with the siblings that score a fifth of it, and with the
    headings, lists and tables beside it; a title above the container that stands beside
    it or one that holds it is kept too. Inside an article element, the whole article is.
    """
    root = parse(page)
    _pruned(root)
    best = _scored(root)
    up: Node | None = best
    while up:
        if up.tag == "article":
            best = up
            break
        up = up.parent
    kept: list[Node | str] = [best]
    if best.parent and best.tag != "main":
        kept = [node for node in best.parent.children if isinstance(node, Node) and _belongs(node, best)]
    if best.tag != "article" and not any(node.tag == "h1" for node in _under(kept)):
        kept = _titles_above(best) + kept
    return "\n".join(_blocks(kept))


def _belongs(node: Node, best: Node) -> bool:
    """Whether a sibling of the best container is part of its text."""
    linked = node.links >= 0.25 * max(node.texts, 1)
    return (
        node is best
        or node.tag in _HEADINGS
        or node.score >= max(0.2 * best.score, 3)
        or node.tag == "p" and node.texts > _PARAGRAPH and not linked
        or node.tag in _BESIDE and node.texts > 0 and not linked
    )


def _under(nodes: list[Node | str]) -> Iterator[Node]:
    for node in nodes:
        if isinstance(node, Node):
            yield from _in_order(node)


def _titles_above(best: Node) -> list[Node | str]:
    """Top headings before the elements that hold the best container, nearest level first."""
    inner, outer = best.parent, best.parent.parent if best.parent else None
    while inner and outer:
        before = outer.children[: next(i for i, child in enumerate(outer.children) if child is inner)]
        titles: list[Node | str] = [child for child in before if isinstance(child, Node) and child.tag == "h1"]
        if titles:
            return titles
        inner, outer = outer, outer.parent
    return []


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for every row of ``page_id, url, html``.

    A null page counts as empty and has the empty text, as does a page without text.
    Bytes that are no UTF-8 become U+FFFD. Nothing is cut or left out otherwise. No shuffle; repeated rows are extracted each. An
    empty table gives no rows. Other columns are not read.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (main_text(decoded(page)) for page in batch.column(2))
            columns = [*batch.columns[:2], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    rows = pages.select("page_id", "url", text_bytes("html").alias("html"))
    schema = rows.select("page_id", "url", F.lit("").alias("text")).schema
    return rows.mapInArrow(per_batch, schema)
