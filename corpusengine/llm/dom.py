"""A page as a tree of nodes, its blocks of text, and the alignment of two such trees."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import xxhash

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"']+)""")
_CUE_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NUMBERS = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "# a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PLAIN = INLINE | HEADINGS | frozenset("p ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption hr".split())
# What an opening tag ends, up to the elements that hold it in.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES_P = HEADINGS | frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form header hr main menu nav"
    " ol p pre section table ul".split()
)
HOLDS_P = frozenset("article aside body button div footer form header li main nav section table td th".split())

# Elements, roles and words of class or id that name what is no part of an article.
NO_TEXT = frozenset(
    "head script style noscript template nav aside footer form button select option textarea input iframe svg object"
    " dialog menu datalist title audio video canvas map noembed noframes".split()
)
NO_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu toolbar".split())
NO_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar aside widget ad ads advert adverts"
    " advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal"
    " overlay newsletter subscribe subscription signup signin login comment comments commentlist disqus respond reply"
    " replies related recommended recommendations share sharing social toolbar pagination pager skip copyright".split()
)
# Ids inside of an article are often made of its titles ("related-work"). There an id tells only if all of its words do,
# but for those that name boxes.
BOXES = frozenset(
    "area bar block body box col column container content group inner item items link links list main outer panel post"
    " posts row section sections story stories wrap wrapper zone article articles page the top bottom left right".split()
)
# These are no part of an article only when they stand outside of it.
NO_OUTSIDE = frozenset("header masthead".split())
CONTENT = frozenset("article main".split())
# Below this many levels a tree is no longer told apart by its parts.
LEVELS = 64
# So many unnamed containers in a row are one list.
LIST = 8


class Node:
    __slots__ = ("attributes", "children", "parent", "slot", "tag", "text")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "", text: str = ""):
        self.tag, self.parent, self.attributes, self.text = tag, parent, attributes, text
        self.children: list[Node] = []
        self.slot: int | None = None

    def get(self, *names: str) -> list[str]:
        """The values of attributes; a name without a value has an empty one."""
        if not self.attributes:
            return []
        found = _ATTRIBUTE.findall(self.attributes)
        return [a or b or c for key, a, b, c, alone in found if (key or alone).lower() in names]


def parse(page: str) -> Node:
    """The tree of a page of any quality: missing end tags are supplied, stray ones are passed over."""
    root = Node("#root", None)
    at, place = 0, root
    while True:
        token = _TOKEN.search(page, at)
        text = page[at : token.start()] if token else page[at:]
        if text:
            place.children.append(Node("#", place, text=text))
        if not token:
            return root
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        if token[1]:
            holder = place
            while holder is not root and holder.tag != tag:
                holder = holder.parent
            if holder is not root:
                place = holder.parent
            continue
        if tag in CLOSES_P:
            place = _ended(place, {"p"}, HOLDS_P)
        if tag in ENDS:
            place = _ended(place, *ENDS[tag])
        node = Node(tag, place, token[3])
        place.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else len(page)
            node.children.append(Node("#", node, text=page[at:stop]))
            at = page.find(">", stop) + 1 if end else len(page)
            if at == 0:
                return root
        elif tag not in VOID and not token[3].endswith("/"):
            place = node


def _ended(place: Node, tags: set[str], held: set[str] | frozenset[str]) -> Node:
    """The place after the nearest of ``tags`` is ended, if none of ``held`` stands between."""
    node = place
    while node.parent is not None and node.tag not in held:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return place


def outside(node: Node, in_content: bool) -> bool:
    """Whether the node's own name says that it is no part of an article."""
    if node.tag in INLINE and not node.attributes:
        return False
    if node.tag in NO_TEXT or (node.tag in NO_OUTSIDE and not in_content):
        return True
    if not node.attributes or node.tag in ("html", "body", "article", "main"):
        return False
    if any(role in NO_ROLE for role in node.get("role")) or node.get("hidden"):
        return True
    if any("display:none" in style.replace(" ", "").lower() for style in node.get("style")):
        return True
    if node.tag in HEADINGS:
        return False
    words = {word.lower() for value in node.get("class") for word in _CUE_WORD.findall(value)}
    ids = {word.lower() for value in node.get("id") for word in _CUE_WORD.findall(value)}
    if not in_content or ids <= NO_WORDS | BOXES:
        words |= ids
    return bool(words & NO_WORDS) or (not in_content and bool(words & NO_OUTSIDE))


def blocks(root: Node) -> list[tuple[str, list[int]]]:
    """The blocks of text of a page's articles in page order, each with the slots it stands in.

    A page without an article, or a main part, is looked at as a whole.
    """
    found: list[list[tuple[str, list[int]]]] = [[], []]
    parts: list[str] = []
    around: list[int] = []  # slots of the blocks around
    within: list[int] = []  # slot of the text at hand, if it stands beside blocks
    inside, seen_content = 0, False

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found[inside > 0].append((text, around + within))
        parts.clear()
        within.clear()

    stack: list[tuple[Node, bool]] = [(root, True)]
    while stack:
        node, enter = stack.pop()
        if enter and outside(node, inside > 0):
            continue
        if node.tag in INLINE:
            if node.slot is not None and not within:
                within.append(node.slot)
            parts.append(" " if node.tag == "br" else node.text)
            stack.extend((child, True) for child in reversed(node.children))
            continue
        flush()
        content = node.tag in CONTENT or (bool(node.attributes) and "main" in node.get("role"))
        if enter:
            inside, seen_content = inside + content, seen_content or content
            if node.slot is not None:
                around.append(node.slot)
            stack.append((node, False))
            stack.extend((child, True) for child in reversed(node.children))
        else:
            inside -= content
            if node.slot is not None:
                around.pop()
    flush()
    return found[1] if seen_content else found[0]


class Part:
    """A part of a page's layout: a container, a list of like ones, or a run of text."""

    __slots__ = ("content", "label", "nodes", "parts", "size")

    def __init__(self, label: str, nodes: list[Node]):
        self.label, self.nodes = label, nodes
        self.parts: list[Part] = []
        # A hash of all text, and the characters of a run of text (0 for a container).
        self.content = self.size = 0


def label(node: Node) -> str:
    names = sorted(_NUMBERS.sub("", word) for value in node.get("class", "id") for word in value.split())
    return ".".join([node.tag, *dict.fromkeys(names)])


def layout(nodes: list[Node], name: str = "#root", level: int = 0) -> Part:
    """The layout below some nodes: containers by name and order, with all plain text between two of them as one run."""
    whole = Part(name, nodes)
    groups: list[tuple[str, list[Node]]] = []
    for node in nodes:
        for child in node.children:
            if child.tag in ("script", "style", "head") or (child.tag == "#" and not child.text.strip()):
                continue
            named = label(child) if child.attributes else child.tag
            plain = child.tag in PLAIN and "." not in named
            if plain or level >= LEVELS:
                named = "#text"
            if groups and groups[-1][0] == named and (plain or "." in named or _listed(groups, named)):
                groups[-1][1].append(child)
            else:
                groups.append((named, [child]))
    for named, members in groups:
        if named == "#text":
            part = Part(named, members)
            text = "".join(_texts(members))
            part.content, part.size = xxhash.xxh64_intdigest(text) >> 1, len(text)
        else:
            part = layout(members, named, level + 1)
        whole.parts.append(part)
    whole.content = xxhash.xxh64_intdigest(repr([part.content for part in whole.parts])) >> 1
    return whole


def _listed(groups: list[tuple[str, list[Node]]], name: str) -> bool:
    return len(groups) > LIST and all(named == name for named, _ in groups[-LIST:])


def _texts(nodes: list[Node]) -> Iterator[str]:
    stack = nodes[::-1]
    while stack:
        node = stack.pop()
        if node.tag == "#":
            yield node.text
        elif node.tag not in RAW:
            stack.extend(reversed(node.children))


def skeleton(part: Part) -> str:
    """A layout's names alone, as text that ``from_skeleton`` reads."""
    return part.label.translate({40: None, 41: None, 44: None}) + (
        f"({','.join(map(skeleton, part.parts))})" if part.parts else ""
    )


def from_skeleton(text: str) -> Part:
    root = Part("", [])
    place, stack = root, [root]
    for token in re.findall(r"[(),]|[^(),]+", text):
        if token == "(":
            stack.append(place)
        elif token == ")":
            stack.pop()
        elif token != ",":
            place = Part(token, [])
            stack[-1].parts.append(place)
    return root.parts[0]


def numbered(part: Part) -> dict[int, int]:
    """The number of each part of a layout, in page order, by its identity."""
    out: dict[int, int] = {}
    stack = [part]
    while stack:
        place = stack.pop()
        out[id(place)] = len(out)
        stack.extend(reversed(place.parts))
    return out


def align(ours: Part, theirs: Part) -> list[tuple[Part, Part]]:
    """The pairs of the largest matching of two layouts: equal names, same order, parts of matched parts (simple tree
    matching).
    """
    if ours.label.translate({40: None, 41: None, 44: None}) != theirs.label:
        return []
    m, n = len(ours.parts), len(theirs.parts)
    pairs = [[align(a, b) for b in theirs.parts] for a in ours.parts]
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m):
        for j in range(n):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + len(pairs[i][j]))
    matched, i, j = [], m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            matched.append(pairs[i - 1][j - 1])
            i, j = i - 1, j - 1
    return [(ours, theirs), *(pair for part in reversed(matched) for pair in part)]
