"""What a sample page holds that its site's rules are made from; operators/pages.py scores it in Spark."""

from . import dom

# Selectors with their weights, and words that tell parts to remove and languages.
TITLES = [("h1", 2.0), ('h1[class*="title"]', 3.0), ('h1[class*="headline"]', 3.0), (".title h1", 2.5), (".headline h1", 2.5), (".article-title", 2.0), (".post-title", 2.0), ('[class*="article"] h1', 2.0)]
SUBTITLES = [
    ("h2", 1.5), (".subtitle", 2.0), (".deck", 2.0), (".lead", 1.8), (".article-subtitle", 2.0), (".post-subtitle", 2.0), ('h2[class*="subtitle"]', 2.5), (".article-lead", 1.8),
    ('meta[name="description"]', 1.0),
]
AUTHORS = [(".author", 2.0), (".byline", 2.0), (".by-author", 2.0), (".article-author", 2.0), (".post-author", 2.0), ('[class*="author"]', 1.5), (".meta-author", 1.8), ('[rel="author"]', 1.5)]
CONTENTS = [
    (".content", 1.5), (".article-content", 2.0), (".post-content", 2.0), (".entry-content", 1.8), ('[class*="content"]', 1.0), ("article", 1.5), ("main", 1.5), (".article-body", 2.0), (".post-body", 2.0),
]
REMOVABLE = [
    "advertisement", "ads", "ad-", "advert", "navigation", "nav", "menu", "sidebar", "side-bar", "footer", "header", "social", "share", "sharing", "comment", "comments", "related", "recommended",
    "newsletter", "subscribe", "popup", "modal", "breadcrumb", "breadcrumbs",
]
LANGUAGES = ("en", "fr", "ro", "es", "de", "it")
LANGUAGE_WORDS = (("fr", ("le ", "la ", "les ", "des ", "une ", "par ")), ("ro", ("și ", "în ", "de ", "cu ", "pe ", "sau ")))
KINDS = {"titles": TITLES, "subtitles": SUBTITLES, "authors": AUTHORS, "contents": CONTENTS}
MOST, MOST_REMOVED, MOST_REPEATED, SHOWN = 5, 20, 10, 150


def selector_of(e: dom.Element) -> str:
    """The id, else the classes that are no numbers, else the tag."""
    if e.attrs.get("id"):
        return f"#{e.attrs['id']}"
    classes = [c for c in e.classes if not c.isdigit()]
    return "." + ".".join(classes) if classes else e.name


def parts(elements: list[dom.Element]) -> list[dict]:
    """Every element that a selector of a kind finds, in the order of the selectors and the page; what it is worth is for the plan to say."""
    out, found, shown = [], dom.index(elements), {}
    for kind, weights in KINDS.items():
        for nth, (selector, _) in enumerate(weights):
            for e in dom.select_indexed(found, selector):
                meta = e.name == "meta"
                # several selectors find the same element
                if id(e) not in shown:
                    text = e.attrs.get("content", "") if meta else e.text(strip=True)
                    shown[id(e)] = {"name": e.name, "classes": " ".join(e.classes).lower(), "chars": len(text), "words": len(text.split()), "text": text[:SHOWN]}
                out.append({"kind": kind, "nth": nth, "selector": selector if meta else selector_of(e), **shown[id(e)]})
    return out


def _bare(string: str) -> str:
    """A text node's or a comment's own words."""
    return (string[4:-3] if isinstance(string, dom.Comment) and string.startswith("<!--") else string).strip()


def page(html: str) -> dict:
    """What rules are made from, from one parse: candidates, named elements, strings (comments included), language attribute, text."""
    root = dom.parse(html)
    elements = list(root.elements())
    top = next((e for e in elements if e.name == "html"), None)
    named = [{"selector": selector_of(e), "names": f"{' '.join(e.classes).lower()} {e.attrs.get('id', '').lower()}"} for e in elements if e.classes or e.attrs.get("id")]
    return {
        "parts": parts(elements), "named": named, "strings": [t for e in [root, *elements] for c in e.children if isinstance(c, str) and (t := _bare(c))], "lang": top.attrs.get("lang", "") if top else "",
        "page_text": root.text(), "classes": [c for e in elements for c in e.classes], "ids": [e.attrs["id"] for e in elements if e.attrs.get("id")],
    }
