"""A small page tree: parse, blocks, shapes and simple tree matching.

The parser keeps what extraction needs: elements, text with character
references decoded, and the usual implied end tags.  A *shape* is the tree of
block elements with repeated siblings merged into one, so pages that differ
only in how many paragraphs or links they have share a shape; its text leaves
are numbered as *slots*.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from functools import lru_cache

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
#: Block elements that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split())
#: A start tag of the key ends an open element of these, up to the scope.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("article aside body button div footer form header html li main nav section table td th ul ol dl blockquote".split())
#: In a shape, deeper elements are read as text of the element at this depth.
MAX_DEPTH = 150
#: More runs of siblings than this are merged by label.
MAX_RUNS = 16


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str) -> None:
        self.tag, self.attrs, self.kids = tag, attrs, []


class Text:
    __slots__ = ("text", "slot")

    def __init__(self, text: str) -> None:
        self.text, self.slot = text, -1


@lru_cache(4096)
def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


class _Open:
    """The open elements, and by tag where in the stack they are."""

    def __init__(self, root: Node) -> None:
        self.stack, self.places = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def innermost(self, names) -> int:
        """Place of the innermost open element of ``names``, 0 without one."""
        return max((self.places[t][-1] for t in names if self.places.get(t)), default=0)

    def cut(self, at: int) -> None:
        """Close the element at a place and all inside it; 0 closes none."""
        while 0 < at < len(self.stack):
            self.places[self.stack.pop().tag].pop()

    def close(self, names, scope) -> None:
        """Close the innermost open element of ``names`` that the scope allows."""
        at = self.innermost(names)
        if at and at > self.innermost(scope):
            self.cut(at)


def parse(page: str) -> Node:
    root = Node("#root", "")
    opened = _Open(root)
    stack = opened.stack
    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            stack[-1].kids.append(Text(html.unescape(page[at:end])))
        if not m:
            break
        at = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            opened.cut(opened.innermost((tag,)))
            continue
        if tag in ENDS_P:
            opened.close(("p",), P_SCOPE)
        if tag in ENDS:
            opened.close(*ENDS[tag])
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = close.start() if close else n
            node.kids.append(Text(html.unescape(page[at:stop]) if tag in ("title", "textarea") else page[at:stop]))
            past = page.find(">", stop) if close else -1
            at = past + 1 if past >= 0 else n
        elif tag not in VOID and not attrs.endswith("/"):
            opened.push(node)
    return root


def label(node: Node) -> str:
    """Tag, and the first class or else the id, as one word."""
    if not node.attrs:
        return node.tag
    a = attributes(node.attrs)
    name = (a.get("class") or a.get("id") or "").split()
    return f"{node.tag}.{re.sub(r'[^a-z0-9_-]', '', name[0].lower())}" if name else node.tag


def _flat(kids: list) -> list:
    """Children with inline elements replaced by their own children."""
    out, todo = [], kids[::-1]
    while todo:
        k = todo.pop()
        if isinstance(k, Node) and k.tag in INLINE:
            todo += reversed(k.kids)
        elif isinstance(k, Node) or k.text.strip():
            out.append(k)
    return out


def _texts(kids: list) -> list[Text]:
    """All texts below, in page order."""
    out, todo = [], kids[::-1]
    while todo:
        k = todo.pop()
        if isinstance(k, Node):
            todo += reversed(k.kids)
        elif k.text.strip():
            out.append(k)
    return out


def shape(root: Node) -> tuple[str, list[list[Text]]]:
    """The page's shape as text, and the texts of each slot; each text is
    told its slot."""
    slots: list[list[Text]] = []

    def walk(kids: list, depth: int) -> str:
        runs: list[tuple[str, list]] = []
        for k in _flat(kids) if depth < MAX_DEPTH else _texts(kids):
            name = "#" if isinstance(k, Text) else label(k)
            if runs and runs[-1][0] == name:
                runs[-1][1].append(k)
            else:
                runs.append((name, [k]))
        if len(runs) > MAX_RUNS:
            merged: dict[str, list] = {}
            for name, members in runs:
                merged.setdefault(name, []).extend(members)
            runs = list(merged.items())
        parts = []
        for name, members in runs:
            if name == "#":
                for t in members:
                    t.slot = len(slots)
                slots.append(members)
                parts.append("#")
            else:
                inside = walk([x for m in members for x in m.kids], depth + 1)
                parts.append(f"{name}({inside})" if inside else name)
        return ",".join(parts)

    return walk(root.kids, 1), slots


def read_shape(text: str) -> tuple:
    """A shape as nested (label, children, slot of a text leaf or -1)."""
    slot = 0
    stack: list[list] = [[]]
    name = ""

    def leaf() -> None:
        nonlocal name, slot
        if name:
            stack[-1].append((name, (), slot if name == "#" else -1))
            slot += name == "#"
            name = ""

    names: list[str] = []
    for c in text:
        if c == "(":
            names.append(name)
            name = ""
            stack.append([])
        elif c == ")":
            leaf()
            kids = tuple(stack.pop())
            stack[-1].append((names.pop(), kids, -1))
        elif c == ",":
            leaf()
        else:
            name += c
    leaf()
    return ("#root", tuple(stack[0]), -1)


def match(a: tuple, b: tuple) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the size of the largest order-keeping matching
    of two trees with equal labels at the roots, and the matched slots."""
    if a[0] != b[0]:
        return 0, []
    pairs = [(a[2], b[2])] if a[2] >= 0 else []
    m, n = len(a[1]), len(b[1])
    if not m or not n:
        return 1, pairs
    inner = {(i, j): match(x, y) for i, x in enumerate(a[1]) for j, y in enumerate(b[1]) if x[0] == y[0]}
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            w = inner.get((i - 1, j - 1), (0, None))[0]
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w)
    i, j = m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += inner[i - 1, j - 1][1]
            i, j = i - 1, j - 1
    return 1 + best[m][n], pairs
