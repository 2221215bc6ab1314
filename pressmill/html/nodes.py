"""A page's elements and strings as rows numbered in document order, which selectors become joins over."""

from . import dom

ELEMENTS = "array<struct<pre:int,last:int,parent:int,name:string,id:string,classes:array<string>,attrs:map<string,string>>>"
STRINGS = "array<struct<at:int,hidden:int,block:int,linked:boolean,text:string>>"
#: Elements that text does not run on across.
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section table tbody td "
    "tfoot th thead title tr ul".split()
)


def rows(html: str) -> tuple[list[dict], list[dict]]:
    """Elements with their number, that of the last node they hold and that of their parent; strings with that of the innermost hidden element around them,
    a number that strings of one block share, and whether they are part of a link.

    The root is 0. Comments have no row; a line break is an element and a string of its own.
    """
    root = dom.parse(html)
    elements, strings, number, block = [], [], 0, 0
    stack = [(None, 0, 0, False, iter(root.children))]
    while stack:
        own, pre, hidden, linked, children = stack[-1]
        for child in children:
            if isinstance(child, dom.Element):
                number += 1
                row = {"pre": number, "last": number, "parent": pre, "name": child.name, "id": child.attrs.get("id") or None, "classes": child.classes, "attrs": child.attrs}
                elements.append(row)
                block += child.name in BLOCKS
                if child.name == "br":
                    strings.append({"at": number, "hidden": hidden, "block": block, "linked": linked, "text": "\n"})
                stack.append((row, number, number if child.name in dom.HIDDEN else hidden, linked or child.name == "a", iter(child.children)))
                break
            if not isinstance(child, dom.Comment):
                number += 1
                strings.append({"at": number, "hidden": hidden, "block": block, "linked": linked, "text": child})
        else:
            stack.pop()
            if own is not None:
                own["last"] = number
                block += own["name"] in BLOCKS
    return elements, strings
