"""A page's main text, and headers in it.

The main text is our own choice, as its rule lies in no public document: the article element with most text, else the
parent whose paragraphs hold most text that is no link; its blocks are joined with blank lines.
"""

import re
import unicodedata

from . import dom

BLOCKS = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "figcaption", "dd", "dt")
# Openings that are no headers or that tell content, and words in secondary headers.
NO_HEADER_STARTS = ("În ", "De ", "Cu ", "Pentru ", "Prin ", "Astfel", "Așa", "Dar", "Și")
CONTENT_STARTS = ("În ", "De ", "Cu ", "Pentru ", "Prin ", "Acest", "Potrivit", "După")


def _weight(e: dom.Element) -> int:
    """Characters of its own paragraphs outside links."""
    own = [c for c in e.children if isinstance(c, dom.Element) and c.name == "p"]
    return sum(len(p.text(strip=True)) - sum(len(a.text(strip=True)) for a in p.find_all("a")) for p in own)


def _blocks(e: dom.Element, out: list[str], line: list[str]) -> None:
    stack = [(iter(e.children), False)]
    while stack:
        children, block = stack[-1]
        for child in children:
            if not isinstance(child, dom.Element):
                if not isinstance(child, dom.Comment):
                    line.append(child)
            elif child.name == "br":
                line.append("\n")
            elif child.name not in dom.HIDDEN:
                inner = child.name in BLOCKS or child.name in ("div", "section", "article", "header", "table", "tr", "ul", "ol", "figure")
                if inner:
                    _flush(out, line)
                stack.append((iter(child.children), inner))
                break
        else:
            stack.pop()
            if block:
                _flush(out, line)


def _flush(out: list[str], line: list[str]) -> None:
    text = "\n".join(x for x in (" ".join(part.split()) for part in "".join(line).split("\n")) if x)
    line.clear()
    if text:
        out.append(text)


def main_text(html: str) -> str:
    return main_text_of(dom.parse(html))


def main_text_of(root: dom.Element) -> str:
    chars, best = max(((len(e.text(strip=True)), e) for e in root.find_all("article")), key=lambda x: x[0], default=(0, None))
    if best is None or chars < 100:
        weight, heavy = max(((_weight(e), e) for e in root.elements()), key=lambda x: x[0], default=(0, None))
        best = heavy if weight else root
    out, line = [], []
    _blocks(best, out, line)
    _flush(out, line)
    return "\n\n".join(out)


def headers_of(html: str) -> dict[str, int]:
    return headers_in(dom.parse(html))


def headers_in(root: dom.Element) -> dict[str, int]:
    """Text of each header over three characters, as it is and normalised, with its level; deeper levels win."""
    found, every = {}, root.find_all("h1", "h2", "h3", "h4", "h5", "h6")
    for level in range(1, 7):
        for e in (e for e in every if e.name == f"h{level}"):
            text = e.text(strip=True)
            if len(text) > 3:
                found[unicodedata.normalize("NFKC", text)] = level
                found[text] = level
    return found


def _content_follows(lines: list[str], i: int) -> bool:
    after = next((s for s in (x.strip() for x in lines[i + 1 : i + 3]) if s), None)
    return after is not None and (len(after) > 50 or after.endswith((".", "!", "?", ":", ";")) or after.startswith(CONTENT_STARTS))


def _looks_like_header(line: str, lines: list[str], i: int) -> bool:
    return 5 < len(line) < 80 and not line.endswith((".", "!", ":", ";", ",")) and not line.startswith(NO_HEADER_STARTS) and _content_follows(lines, i)


def with_headers(text: str, known: dict[str, int]) -> str:
    """Lines that are headers of the page, or look like headers, as Markdown headers, underlined on the first two levels."""
    lines, out = text.split("\n"), []
    for i, line in enumerate(lines):
        bare = line.strip()
        level = known.get(bare) or known.get(unicodedata.normalize("NFKC", bare)) if bare else None
        if bare and level is None and _looks_like_header(bare, lines, i):
            level = 1 if i == 0 or (i < 3 and not any(out[-3:])) else 2
        if level is None:
            out.append(line)
            continue
        if i > 0 and out and out[-1].strip() and not out[-1].startswith("#"):
            out.append("")
        header = f"{'#' * level} {bare}"
        out.append(header)
        if level <= 2:
            out.append(("=" if level == 1 else "-") * len(header))
    return "\n".join(out) if text else text


def paragraph_spaced(text: str) -> str:
    """Lines stripped, blank ones dropped at the start, and a blank line before every other line."""
    kept: list[str] = []
    for line in (x.strip() for x in text.split("\n")):
        if line or (kept and kept[-1]):
            kept.append(line)
    return re.sub(r"\n(?=\S)", "\n\n", "\n".join(kept))
