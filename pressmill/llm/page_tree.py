"""A page as flat columns of nodes in document order: tag, parent, where the subtree ends, text and names.

Elements that HTML lets end without an end tag (paragraphs, list items, cells) end where they must, an inline end tag never closes a
block, and what is cut off at the end of a page is closed there. Nothing here is recursive, so pages may be nested to any depth.
"""

import re
from html import unescape

# HTML's own element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li listing main menu nav ol optgroup option p pre search section summary table tbody td template tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - frozenset("html head body caption legend li dd dt option optgroup tbody td tfoot th thead tr template".split())
SCOPE = frozenset("html table td th caption template button object".split())
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th".split())
#: What a start tag ends: the names, and where the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}

#: A comment, a tag (quotes count behind an equals sign), what browsers take for a comment, and a tag that the page's end cuts off.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+)>|<[!?/][^>]*+>|<[a-zA-Z!?/][^>]*+\Z""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Tree:
    """Node 0 is the root. tags: None for text; ends: the first node behind the subtree."""

    __slots__ = ("attributes", "ends", "parents", "tags", "texts")

    def __init__(self):
        self.tags, self.parents, self.ends, self.texts, self.attributes = [""], [-1], [0], [""], [""]

    def add(self, tag, parent: int, text: str = "", attributes: str = "") -> int:
        at = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.ends.append(at + 1)
        self.texts.append(text)
        self.attributes.append(attributes)
        return at

    def named(self, at: int) -> dict[str, str]:
        """An element's attributes; the first of equal names counts."""
        found: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(self.attributes[at]):
            found.setdefault(name.lower(), unescape(values[0] or values[1] or values[2]))
        return found


def parse(page: str) -> Tree:
    """The nodes of a page."""
    tree = Tree()
    stack, open_ = [0], {}
    tags = tree.tags

    def close(depth: int) -> None:
        end = len(tags)
        while len(stack) > depth:
            at = stack.pop()
            tree.ends[at] = end
            open_[tags[at]] -= 1

    def find(names, stops) -> int:
        """The depth of the nearest open element of these names, or 0."""
        if not any(open_.get(n) for n in names):
            return 0
        for depth in range(len(stack) - 1, 0, -1):
            tag = tags[stack[depth]]
            if tag in names:
                return depth
            if tag in stops:
                return 0
        return 0

    def text(data: str) -> None:
        if data:
            tree.add(None, stack[-1], unescape(data) if "&" in data else data)

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        slash, tag, rest = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if tag in ("html", "body") or tag in VOID:
                if tag == "br":
                    tree.add("br", stack[-1])
                continue
            stops = {"table", "html"} - {tag} if tag in TABLE_PARTS else SCOPE if tag in BLOCK else BLOCK
            depth = find((tag,), stops)
            if depth:
                close(depth)
            continue
        if tag in ENDS_PARAGRAPH and (depth := find(("p",), SCOPE)):
            close(depth)
        if tag in ENDS and (depth := find(*ENDS[tag])):
            close(depth)
        if tag in ("html", "body") and open_.get(tag):
            continue
        node = tree.add(tag, stack[-1], attributes=rest)
        if tag in VOID or rest.endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            inner = page[at : end.start() if end else size]
            if tag in ("title", "textarea", "noscript") and inner:
                tree.add(None, node, unescape(inner))
            tree.ends[node] = len(tags)
            at = end.end() if end else size
            continue
        stack.append(node)
        open_[tag] = open_.get(tag, 0) + 1
    open_[""] = 1
    close(0)
    return tree
