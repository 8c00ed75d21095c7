"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Each block of text gives points for its length and commas to its parent
and, less, to its grandparent; an element's points are cut by its link density, the share of its text that
stands in links. The best element is the main container; siblings of it that score near it, or are plain
paragraphs of prose, are kept beside it. Elements that seldom hold the article (menus, headers and footers of
the page, sidebars, forms, and whatever has a class, id or role with a word for an advert, a notice or comments
in it, as in ``cookie-notice`` but not in ``no-comments``) are read only if most of the page's prose, the text
outside links, stands in them; scripts and the like never.

Text of one block has its white space, also that of line breaks, turned into single spaces, and blocks stand
one to a line in page order. Character references are decoded. Nothing is shortened or left out beyond that.

A null or empty page has an empty text, as has one without text. Broken markup (tags left open, crossed or
cut off) is read as browsers do in the common cases: paragraphs close before blocks, the rest closes with
its parent. Repeated rows get a row each; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator, Set
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.ship import ship_package

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

#: A comment or declaration, or a tag with its name and attributes. Quantifiers do not give back.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
BLANK = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; it ends where their name stands in an end tag, in letters of any case.
RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
#: Never part of the article.
NEVER = RAW | frozenset("head button select option object canvas audio video".split())
#: Part of it only where they hold most of the page's prose.
DROPPED = NEVER | frozenset("nav footer aside form dialog menu".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: An open paragraph ends before these.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: An open element of the key's kind ends where one of these begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: How far such an implied end reaches.
SCOPE = frozenset("ul ol dl table body html article section div".split())
#: Words of a class, id or role that mark what is not the article, and those that mark the article.
UNLIKELY = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer header masthead menu nav navbar navigation newsletter notice pagination "
    "popup promo related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
LIKELY = frozenset("article body content entry main post story text".split())
#: Parts of a class, id or role; a word after one of ``NEGATED`` says what else the page has.
PART = re.compile(r"[-_:]+|(?<=[a-z])(?=[A-Z])")
NEGATED = frozenset("has no not with without".split())
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE | re.ASCII) for name in RAW}


@dataclass(frozen=True)
class Scoring:
    """``min_chars``: shorter blocks give no points. ``per_chars``: characters of one point, at most
    ``most_points``. ``sibling``: share of the best element's score from which a sibling is kept."""

    min_chars: int = 25
    per_chars: int = 100
    most_points: int = 3
    sibling: float = 0.2


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None
    #: Whether a class, id or role says that it is not the article.
    marked: bool = False
    children: list[Node | str] = field(default_factory=list)
    points: float = 0.0
    chars: int = 0
    linked: int = 0
    #: Whether most of the page's prose stands in it.
    most: bool = False
    #: The next element above that is no inline one, and whether one above is an article.
    block_parent: Node | None = field(init=False, default=None)
    in_article: bool = field(init=False, default=False)

    def __post_init__(self) -> None:
        above = self.parent
        if above is not None:
            self.block_parent = above.block_parent if above.tag in INLINE else above
            self.in_article = above.in_article or above.tag in ("article", "main")


def _marked(attributes: str) -> bool:
    if "=" not in attributes:
        return False
    tokens = [token for groups in MARKS.findall(attributes) for token in "".join(groups).split()]
    return not any(token.lower() in LIKELY for token in tokens) and any(map(_unlikely_name, tokens))


def _unlikely_name(token: str) -> bool:
    if token.lower() in UNLIKELY:
        return True
    parts = [part.lower() for part in PART.split(token)]
    found = {part for before, part in zip(["", *parts], parts) if part in UNLIKELY and before not in NEGATED}
    # The header of an article or a post holds its headline.
    return bool(found - {"header"}) or bool(found) and not LIKELY.intersection(parts)


def _unlikely(node: Node) -> bool:
    if node.tag in NEVER:
        return True
    if node.most:
        return False
    if node.tag in DROPPED:
        return True
    if node.tag == "header":
        return not node.in_article
    return node.marked and node.tag not in ("html", "body", "article", "main")


def _in_order(root: Node) -> list[Node]:
    """All elements, each after those it stands in."""
    found, left = [], [root]
    while left:
        node = left.pop()
        found.append(node)
        left.extend(child for child in reversed(node.children) if not isinstance(child, str))
    return found


def _mark_most(root: Node) -> None:
    """Sets ``most`` of the elements that hold over half of the prose: text outside links and ``NEVER``."""
    prose: dict[int, int] = {}
    stack: list[tuple[Node, Iterator]] = [(root, iter(root.children))]
    nodes: list[Node] = [root]
    prose[id(root)] = 0
    while stack:
        node, rest = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if stack:
                prose[id(stack[-1][0])] += prose[id(node)]
        elif isinstance(child, str):
            prose[id(node)] += len(child.strip())
        elif child.tag not in NEVER and child.tag != "a":
            prose[id(child)] = 0
            nodes.append(child)
            stack.append((child, iter(child.children)))
    for node in nodes:
        node.most = 2 * prose[id(node)] > prose[id(root)]


def tree(source: str) -> Node:
    """The elements of a page; text nodes are decoded strings."""
    root = here = Node("", None)
    # Open elements by name: what is not open is not looked for.
    open_names: Counter[str] = Counter([""])
    at = 0
    while at < len(source):
        begin = source.find("<", at)
        if begin < 0:
            begin = len(source)
        token = TOKEN.match(source, begin) if begin < len(source) else None
        if token is None:
            # A lone sign is text; a tag cut off at the end is not.
            end = min(begin + 1, len(source))
            if re.match(r"</?[a-zA-Z]", source[begin : begin + 3]):
                end = len(source)
                here.children.append(html.unescape(source[at:begin]))
            else:
                here.children.append(html.unescape(source[at:end]))
            at = end
            continue
        if begin > at:
            here.children.append(html.unescape(source[at:begin]))
        at = token.end()
        name = token[2] or token[5]
        if not name:
            continue
        name = name.lower()
        if token[1] or token[4]:
            if open_names[name]:
                here = _up(here, _nearest(here, {name}).parent, open_names)
            continue
        attributes = token[3] or token[6] or ""
        if name in VOID:
            here.children.append(" ")
            continue
        here = _up(here, _implied(here, name, open_names), open_names)
        node = Node(name, here, _marked(attributes))
        here.children.append(node)
        if name in ("svg", "math") and attributes.rstrip().endswith("/"):
            continue
        if name in RAW:
            end = RAW_END[name].search(source, at)
            at = end.start() if end else len(source)
        here = node
        open_names[name] += 1
    return root


def _up(here: Node, to: Node, open_names: Counter[str]) -> Node:
    """Closes the elements from ``here`` up to ``to``, which stays open."""
    while here is not to:
        open_names[here.tag] -= 1
        here = here.parent
    return to


def _nearest(here: Node, names: Set[str], within: Set[str] | None = None, until: Set[str] = frozenset()) -> Node | None:
    """The element of one of the ``names`` around ``here``; it is looked for through elements ``within`` only,
    and not beyond those of ``until``."""
    node = here
    while node.parent is not None and node.tag not in names:
        if node.tag in until or within is not None and node.tag not in within:
            return None
        node = node.parent
    return node if node.tag in names else None


def _implied(here: Node, name: str, open_names: Counter[str]) -> Node:
    """Where an element of this name goes, after the ends it implies."""
    if name in CLOSES_P and open_names["p"]:
        paragraph = _nearest(here, {"p"}, within=INLINE)
        here = paragraph.parent if paragraph else here
    ends = CLOSES.get(name)
    if ends and any(open_names[end] for end in ends):
        open_one = _nearest(here, ends, until=SCOPE)
        here = open_one.parent if open_one else here
    return here


def _blocks(top: Node) -> list[tuple[Node, str, int]]:
    """Blocks below ``top`` in order: the element that holds the text, the text, its characters in links."""
    found: list[tuple[Node, str, int]] = []
    parts: list[str] = []
    state = {"owner": top, "linked": 0}

    def flush() -> None:
        text = BLANK.sub(" ", "".join(parts)).strip()
        if text:
            found.append((state["owner"], text, state["linked"]))
        parts.clear()
        state["linked"] = 0

    # Depth first without recursion: trees of broken pages can be deep.
    stack: list[tuple[Node, Iterator, bool, Node]] = [(top, iter(top.children), top.tag == "a", top)]
    while stack:
        node, rest, in_link, owner = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if node.tag not in INLINE:
                flush()
            continue
        if isinstance(child, str):
            if not parts:
                state["owner"] = owner
            parts.append(child)
            if in_link:
                state["linked"] += len(child.strip())
            continue
        if _unlikely(child):
            continue
        if child.tag in INLINE:
            stack.append((child, iter(child.children), in_link or child.tag == "a", owner))
        else:
            flush()
            stack.append((child, iter(child.children), in_link or child.tag == "a", child))
    flush()
    return found


def main_text(source: str, how: Scoring = Scoring()) -> str:
    """The main text of one page, in time that grows with its length however deep its elements stand."""
    root = tree(source)
    _mark_most(root)
    blocks = _blocks(root)
    nodes = _in_order(root)
    scored: dict[int, Node] = {}
    for owner, text, linked in blocks:
        owner.chars += len(text)
        owner.linked += min(linked, len(text))
        if len(text) < how.min_chars:
            continue
        points = 1 + text.count(",") + min(len(text) // how.per_chars, how.most_points)
        parent = owner.block_parent if owner.tag not in ("td", "div", "article", "section", "main", "body") else owner
        share = 1.0
        for _ in range(2):
            if parent is None:
                break
            parent.points += points * share
            scored[id(parent)] = parent
            parent, share = parent.block_parent, share / 2
    if not scored:
        return "\n".join(text for _, text, linked in blocks if linked * 2 <= len(text))
    for node in reversed(nodes[1:]):
        node.parent.chars += node.chars
        node.parent.linked += node.linked
    value = lambda n: n.points * (1 - n.linked / max(1, n.chars)) * (1.25 if n.tag in ("article", "main") else 1)
    best = max(scored.values(), key=value)
    # An article that holds the container is the whole of it.
    around = best.parent
    while around is not None:
        if around.tag in ("article", "main"):
            best = around
            break
        around = around.parent
    kept = {id(best)} | _kept_siblings(best, blocks, nodes, scored, value, how)
    for node in nodes[1:]:
        if id(node.parent) in kept:
            kept.add(id(node))
    return "\n".join(text for owner, text, _ in blocks if id(owner) in kept)


def _kept_siblings(
    best: Node, blocks: list, nodes: list[Node], scored: dict[int, Node], value: Callable[[Node], float], how: Scoring
) -> set[int]:
    """Siblings of the best element that score near it, are paragraphs of prose, or articles beside an article."""
    around = best.parent
    if around is None:
        return set()
    paragraphs: dict[int, int] = {}
    for node in nodes[1:]:
        if node.parent is around and node.tag == "p":
            paragraphs[id(node)] = id(node)
        elif id(node.parent) in paragraphs:
            paragraphs[id(node)] = paragraphs[id(node.parent)]
    prose = {
        paragraphs[id(owner)]
        for owner, text, linked in blocks
        if id(owner) in paragraphs and len(text) >= how.min_chars and linked * 4 < len(text)
    }
    limit = value(best) * how.sibling
    return {
        id(node)
        for node in around.children
        if not isinstance(node, str)
        and (
            id(node) in prose
            or id(node) in scored and value(node) >= limit
            or node.tag == "article" and best.tag == "article" and not _unlikely(node)
        )
    }


def extract(pages: DataFrame, how: Scoring = Scoring()) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` and ``n_chars``, its code points."""

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.arrow import batch_of
        from millrace.llm.html_text import SCHEMA, main_text

        for batch in batches:
            texts = [main_text(x, how) if x else "" for x in batch.column("html").to_pylist()]
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            yield batch_of([(i, u, t, len(t)) for i, u, t in zip(ids, urls, texts)], SCHEMA)

    ship_package(pages.sparkSession)
    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(run, SCHEMA)
