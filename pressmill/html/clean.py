"""Cleaning pages before their text is read, and emphasis as Markdown."""

import re

from . import dom

# What each cleaning removes and keeps.
IRRELEVANT = ("script", "style", "noscript", "iframe")
NO_CONTENT = ("script", "style", "nav", "footer", "aside", "iframe", "embed", "object", "applet", "form", "button", "input", "textarea", "select", "option", "noscript", "meta", "link", "title")
NO_CONTENT_LIGHT = ("script", "style", "nav", "footer", "aside", "iframe", "embed", "object", "applet", "noscript", "meta", "link", "title")
UNWANTED_CLASSES = ("advertisement", "ad-", "ads", "sidebar", "widget", "menu", "nav", "header", "footer", "social", "share", "comment")
UNWANTED_IDS = ("advertisement", "ad-", "ads", "sidebar", "widget", "menu", "nav", "header", "footer")
UNWANTED_LIGHT = ("advertisement", "ads")
KEPT_ATTRIBUTES = ("href", "src", "alt", "title")
MARKS = ((("b", "strong"), "**", "**"), (("i", "em"), "*", "*"), (("u",), "<u>", "</u>"), (("code", "tt"), "`", "`"))
SPACED_MARKS = ((r"\*\*\s+", "**"), (r"\s+\*\*", "**"), (r"(?<!\*)\*\s+", "*"), (r"\s+\*(?!\*)", "*"), (r"`\s+", "`"), (r"\s+`", "`"))


def _without(root: dom.Element, drop) -> None:
    for e in list(root.elements()):
        if drop(e):
            e.remove()


def strip_irrelevant(html: str) -> str:
    """Without scripts, styles and frames; only id and class stay of the attributes; bare empty tags go."""
    root = dom.parse(html)
    _without(root, lambda e: e.name in IRRELEVANT)
    for e in root.elements():
        e.attrs = {k: v for k, v in e.attrs.items() if k in ("id", "class")}
    _without(root, lambda e: not e.children and not e.attrs)
    return str(root)


def _without_comments(root: dom.Element) -> None:
    for e in [root, *root.elements()]:
        if any(isinstance(c, dom.Comment) for c in e.children):
            e.children = [c for c in e.children if not (isinstance(c, dom.Comment) and c.startswith("<!--"))]


def _page_header(e: dom.Element) -> bool:
    """A header that heads the page and not an article."""
    if e.name != "header":
        return False
    classes = str(e.classes if "class" in e.attrs else "").lower()
    return not (e.find_all("h1", "h2", "h3") or "article" in classes or "title" in classes or len(e.text(strip=True)) > 30)


def clean(html: str) -> str:
    return cleaned(dom.parse(html))


def cleaned(root: dom.Element) -> str:
    """Only what belongs to the content: no navigation, forms, advertisements, empty elements or layout attributes. Changes the tree."""
    _without_comments(root)
    _without(root, lambda e: e.name in NO_CONTENT)
    _without(root, _page_header)
    _without(root, lambda e: e.attrs and (any(x in e.attrs.get("class", "") for x in UNWANTED_CLASSES) or any(x in e.attrs.get("id", "") for x in UNWANTED_IDS)))
    for e in root.elements():
        if e.attrs:
            e.attrs = {k: v for k, v in e.attrs.items() if k in KEPT_ATTRIBUTES}
    _without(root, lambda e: e.name not in ("br", "hr", "img") and not e.has_text())
    out = re.sub(r"\n\s*\n\s*\n+", "\n\n", str(root))
    out = re.sub(r">\s{3,}<", ">\n<", out)
    return re.sub(r"^[ \t]+", "", out, flags=re.MULTILINE)


def clean_lightly(html: str) -> str:
    return lightly_cleaned(dom.parse(html))


def lightly_cleaned(root: dom.Element) -> str:
    """Without what is surely no content; attributes stay but for style. Changes the tree."""
    _without_comments(root)
    _without(root, lambda e: e.name in NO_CONTENT_LIGHT)
    _without(root, lambda e: e.attrs and any(x in e.attrs.get(a, "") for x in UNWANTED_LIGHT for a in ("class", "id")))
    for e in root.elements():
        e.attrs.pop("style", None)
    return re.sub(r"\n\s*\n\s*\n+", "\n\n", str(root))


def marked(html: str) -> str:
    """Bold, italic, underlined and code text and quotations as Markdown; links inside them keep their text only."""
    root = dom.parse(html)
    elements, changed = list(root.elements()), False
    for names, left, right in (*MARKS, (("blockquote",), "", "")):
        if changed:
            elements, changed = list(root.elements()), False
        for e in [e for e in elements if e.name in names]:
            text = e.text()
            if names == ("blockquote",):
                lines = [f"> {line.strip()}" for line in text.strip().split("\n") if line.strip()]
                text = "\n".join(lines) + "\n" if lines else ""
            if text.strip() and e.attached(root):
                e.replace(dom.parse(f"{left}{text}{right}").children)
                changed = True
    out = str(root)
    for pattern, to in SPACED_MARKS:
        if to in out:
            out = re.sub(pattern, to, out)
    return out
