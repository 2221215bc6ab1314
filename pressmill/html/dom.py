"""A page as a tree, with the few CSS selectors that rules use. Made on the standard library's tokeniser.

Void elements close at once, an end tag closes up to its nearest open match, other end tags are
ignored; script and style hold raw text. An element that is never closed takes the rest of its parent.
"""

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = ("script", "style", "template")  # their text does not count as the text of what is around them


class Comment(str):
    """Also declarations and processing instructions; shown as it was, never part of a text."""


class Element:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict, parent: "Element | None"):
        self.name, self.attrs, self.children, self.parent = name, attrs, [], parent

    def elements(self) -> Iterator["Element"]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            e = stack.pop()
            yield e
            stack.extend([c for c in reversed(e.children) if isinstance(c, Element)])

    def find_all(self, *names: str) -> list["Element"]:
        return [e for e in self.elements() if e.name in names]

    def strings(self) -> Iterator[str]:
        own = self.name not in HIDDEN or self.parent is not None
        stack = [c for c in reversed(self.children) if own or isinstance(c, Element)]
        while stack:
            child = stack.pop()
            if isinstance(child, Element):
                if child.name not in HIDDEN:
                    stack.extend(reversed(child.children))
            elif not isinstance(child, Comment):
                yield child

    def has_text(self) -> bool:
        """Whether text(strip=True) is not empty; reads no further than the first string that tells."""
        return any(s.strip() for s in self.strings())

    def text(self, strip: bool = False, between: str = "") -> str:
        if strip:
            return between.join(s for s in (x.strip() for x in self.strings()) if s)
        return between.join(self.strings())

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def replace(self, new: list) -> None:
        siblings = self.parent.children
        at = next(i for i, c in enumerate(siblings) if c is self)
        for n in new:
            if isinstance(n, Element):
                n.parent = self.parent
        siblings[at : at + 1] = new
        self.parent = None

    def attached(self, root: "Element") -> bool:
        e = self
        while e is not None and e is not root:
            e = e.parent
        return e is root

    def __str__(self) -> str:
        # elements that are to be shown and what is shown already; unclosed elements nest deeper than calls may
        out, stack = [], [self]
        while stack:
            e = stack.pop()
            if not isinstance(e, Element):
                out.append(e)
                continue
            if e.name:
                attrs = "".join([f' {k}="{_escaped(v).replace(chr(34), "&quot;")}"' if v is not None else f' {k}=""' for k, v in e.attrs.items()])
                if e.name in VOID:
                    out.append(f"<{e.name}{attrs}/>")
                    continue
                out.append(f"<{e.name}{attrs}>")
                stack.append(f"</{e.name}>")
            stack.extend([c if isinstance(c, Element) else _shown(c, e.name) for c in reversed(e.children)])
        return "".join(out)


def _escaped(text: str) -> str:
    if "&" in text:
        text = re.sub(r"&(?!#\d+;|#x[0-9a-fA-F]+;|\w+;)", "&amp;", text)
    return text.replace("<", "&lt;").replace(">", "&gt;")


def _shown(child, inside: str) -> str:
    if isinstance(child, Comment):
        return str(child)
    return child if inside in ("script", "style") else child.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Element("", {}, None)

    def updatepos(self, i, j):
        """Lines are not counted."""
        return j

    def _text(self, text: str) -> None:
        siblings = self.open.children
        if siblings and type(siblings[-1]) is str:
            siblings[-1] += text
        else:
            siblings.append(text)

    def handle_starttag(self, tag, attrs):
        new = Element(tag, {}, self.open)
        if attrs:
            new.attrs = dict(reversed({k: v if v is not None else "" for k, v in reversed(attrs)}.items()))
        self.open.children.append(new)
        if tag not in VOID:
            self.open = new

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open = self.open.parent

    def handle_endtag(self, tag):
        e = self.open
        while e is not self.root and e.name != tag:
            e = e.parent
        if e is not self.root:
            self.open = e.parent

    def handle_data(self, data):
        self._text(data)

    def handle_comment(self, data):
        self.open.children.append(Comment(f"<!--{data}-->"))

    def handle_decl(self, decl):
        self.open.children.append(Comment(f"<!{decl}>"))

    def handle_pi(self, data):
        self.open.children.append(Comment(f"<?{data}>"))


def parse(html: str) -> Element:
    """The page under a nameless root."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


_TEST = re.compile(r"""\s*(?:([a-zA-Z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([*^$~]?=)\s*["']?([^"'\]]*)["']?\s*)?\])""")


@lru_cache(maxsize=1024)
def _compiled(selector: str):
    """Alternatives, each a chain of compound tests, outermost first."""
    out = []
    for chain in selector.split(","):
        steps = []
        for compound in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", chain.strip()):
            tests, at = [], 0
            while at < len(compound):
                m = _TEST.match(compound, at)
                if not m or m.end() == at:
                    raise ValueError(f"selector not understood: {selector}")
                tests.append(m.groups())
                at = m.end()
            steps.append(tests)
        out.append(steps)
    return out


def _fits(e: Element, tests) -> bool:
    for name, cls, ident, attr, op, value in tests:
        if name and name != "*" and e.name != name.lower():
            return False
        if cls and cls not in e.classes or ident and e.attrs.get("id") != ident:
            return False
        if attr:
            own = e.attrs.get(attr)
            if own is None:
                return False
            if op and not {"=": own == value, "*=": bool(value) and value in own, "^=": own.startswith(value), "$=": own.endswith(value), "~=": value in own.split()}[op]:
                return False
    return True


def _matches(e: Element, steps) -> bool:
    if not _fits(e, steps[-1]):
        return False
    left, up = len(steps) - 1, e.parent
    while left and up is not None:
        if _fits(up, steps[left - 1]):
            left -= 1
        up = up.parent
    return not left


def select(root: Element, selector: str) -> list[Element]:
    """Elements that a selector matches: tag, .class, #id, [attr], [attr=v], [attr*=v], descendants, alternatives."""
    chains = _compiled(selector)
    return [e for e in root.elements() if any(_matches(e, steps) for steps in chains)]


def index(elements: list[Element]) -> dict[str, list[Element]]:
    """Elements by tag, .class and [attribute, in their order, for many selectors on one page."""
    found: dict[str, list[Element]] = {}
    for e in elements:
        for key in {e.name, *("." + c for c in e.classes), *("[" + a for a in e.attrs)}:
            found.setdefault(key, []).append(e)
    return found


def select_indexed(found: dict[str, list[Element]], selector: str) -> list[Element]:
    """The same as select for a selector of one alternative: only elements with what its last step asks for are tried."""
    (steps,) = _compiled(selector)
    name, cls, ident, attr, *_ = steps[-1][0]
    key = f".{cls}" if cls else "[id" if ident else f"[{attr}" if attr else name.lower()
    return [e for e in found.get(key, []) if _matches(e, steps)]
