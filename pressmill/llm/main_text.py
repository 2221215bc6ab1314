"""Main text of pages by scoring the tree.

1. Parts that are no article by what they are (menus, headers and footers of the page, sidebars, forms, scripts) or are named (notices, adverts,
   comments, what is related) go with all they hold.
2. Every paragraph of LEAST characters has a point, one more for each comma and up to three for its length, less the share of its
   text that is linked. Its container gets them, the next ancestor half, those beyond a third, a fourth and so on of a half.
3. The container with the most points, less the share of its text that is linked, is the best. Within an article element the whole article is
   taken. Otherwise siblings with a good part of the points, plain paragraphs and headings beside it come with it, and further up the
   elements that look like the one they stand beside.
4. The blocks of what is kept, white space made single, one a line.

Each page is worked out on its own in Arrow batches where it lies: no shuffle, no cap on length or depth.

Edge cases: a null or empty page has an empty text. A page without scored paragraphs gives what is left of its article, main part or body.
A page cut off anywhere is read up to there; an unfinished tag is no text. Repeated rows stay. Extra columns are kept
unless they carry the name of a result. A line break is a space, two in a row end a block.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .page_tree import BLOCK, Tree, parse

# Kinds, roles and names of parts that are no article.
NO_ARTICLE = frozenset(
    "script style noscript template head title meta link nav footer aside form button input select textarea option datalist iframe object embed applet svg canvas video audio dialog menu search noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog status menu menubar toolbar form tablist".split())
NAMES = frozenset(
    "ad ads adbox adslot adunit adsense adsbygoogle adwrap alert alerts announcement banner banners breadcrumb breadcrumbs byad comment comments consent cookie cookies discussion disqus "
    "footer foot gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification notifications outbrain overlay pager pagination paywall popup "
    "privacy promo promos promotion recommended recommendations related reply replies respond search share sharebar sharing sidebar sidebars signup skip social sponsor sponsored subscribe "
    "subscription taboola teaser teasers toast toolbar topbar trending widget widgets".split()
)
STEMS = ("advert", "sponsor", "comment", "cookie", "consent", "newsletter", "sidebar", "navbar", "breadcrumb", "disqus", "popup", "footer", "gdpr", "subscri", "masthead")
NOT_STEMS = frozenset(["commentary", "commentaries", "commented", "subscript"])
COMMENTS = ("comment", "disqus", "respond", "repl", "discussion")
NEGATIONS = frozenset(["no", "has", "with", "without", "not", "hide"])
GOOD = frozenset("article body content entry main post story text blog column".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
NO_PARAGRAPH = HEADINGS | {"dt", "legend", "caption", "summary"}
COMMAS = ",،、，"
#: A paragraph's least characters, what a name adds, what a sibling needs, and from where a list of links is a menu.
LEAST, NAMED_WELL, SIBLING, AT_LEAST, MENU = 25, 25.0, 0.2, 10.0, 0.6
#: So many ancestors of a paragraph have a share in its points.
LEVELS = 64
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
ROWS = 256


def name_tokens(names: str) -> list[str]:
    return [t.lower() for t in _TOKENS.findall(names)]


def _telling(token: str) -> bool:
    return token in NAMES or token not in NOT_STEMS and token.startswith(STEMS) or token.endswith(STEMS) and token not in NOT_STEMS


class Page:
    """What a page's nodes hold: characters, linked characters, and which parts are gone."""

    def __init__(self, tree: Tree):
        self.tree = tree
        n = len(tree.tags)
        self.gone = bytearray(n)
        self.chars, self.linked, self.links = [0] * n, [0] * n, [0] * n
        self.tokens: dict[int, list[str]] = {}
        self._drop()
        self._add_up()

    def _inside(self, at: int, *tags: str) -> bool:
        """Whether an element stands in one of these; each asks only for few elements of a page."""
        tree, at = self.tree, self.tree.parents[at]
        while at > 0:
            if tree.tags[at] in tags:
                return True
            at = tree.parents[at]
        return False

    def _holds(self, at: int, tags) -> bool:
        return any(self.tree.tags[i] in tags for i in range(at + 1, self.tree.ends[at]))

    def _no_article(self, at: int) -> bool:
        tree, tag = self.tree, self.tree.tags[at]
        if tag in NO_ARTICLE:
            return True
        if tag == "header" and not self._inside(at, "article") and not (self._inside(at, "main") and self._holds(at, HEADINGS)):
            return True
        if not tree.attributes[at] or tag in ("html", "body", "main", "br"):
            return False
        named = tree.named(at)
        if "hidden" in named or named.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", named.get("style", ""), re.I):
            return True
        if any(role in ROLES for role in named.get("role", "").lower().split()):
            return True
        told = False
        for name in f"{named.get('class', '')} {named.get('id', '')}".split():
            tokens = name_tokens(name)
            self.tokens.setdefault(at, []).extend(tokens)
            if not told and not NEGATIONS & set(tokens):
                told = any(_telling(t) for t in tokens) and (tag != "article" or any(t.startswith(COMMENTS) for t in tokens))
                if not told and "header" in tokens:
                    told = not (self._inside(at, "article") or GOOD & set(tokens) and self._holds(at, HEADINGS))
        if told and self._holds(at, ("article", "main")) and not any(t.startswith(COMMENTS) for t in self.tokens[at]):
            return False
        return told

    def _drop(self) -> None:
        tree, at, n = self.tree, 1, len(self.tree.tags)
        while at < n:
            if tree.tags[at] is not None and self._no_article(at):
                end = tree.ends[at]
                self.gone[at:end] = b"\1" * (end - at)
                at = end
            else:
                at += 1

    def _add_up(self) -> None:
        """Characters and linked characters of each subtree."""
        tree = self.tree
        for at in range(len(tree.tags) - 1, 0, -1):
            if self.gone[at]:
                continue
            if tree.tags[at] is None:
                self.chars[at] = sum(map(len, tree.texts[at].split()))
            elif tree.tags[at] == "a":
                self.linked[at] = self.chars[at]
                self.links[at] = 1
            up = tree.parents[at]
            self.chars[up] += self.chars[at]
            self.linked[up] += self.linked[at]
            self.links[up] += self.links[at]

    def density(self, at: int) -> float:
        return self.linked[at] / self.chars[at] if self.chars[at] else 0.0


def scores(page: Page) -> tuple[dict[int, float], list[float]]:
    """The points of each container, and the points of all paragraphs in each element."""
    tree = page.tree
    tags, parents, gone = tree.tags, tree.parents, page.gone
    n = len(tags)
    # each text belongs to the nearest block around it
    block, chars, linked, commas = [0] * n, [0] * n, [0] * n, [0] * n
    nested, in_link = bytearray(n), bytearray(n)
    for at in range(1, n):
        if gone[at]:
            continue
        up = parents[at]
        block[at] = outer = up if not up or tags[up] in BLOCK else block[up]
        in_link[at] = in_link[up] or tags[at] == "a"
        if tags[at] is None:
            size = len(" ".join(tree.texts[at].split()))
            chars[outer] += size
            linked[outer] += size * in_link[at]
            commas[outer] += sum(map(tree.texts[at].count, COMMAS))
        elif tags[at] in BLOCK:
            nested[outer] = 1
    points, held = {}, [0.0] * n
    for at in range(n - 1, -1, -1):
        if chars[at] >= LEAST and tags[at] not in NO_PARAGRAPH:
            worth = (1 + commas[at] + min(chars[at] // 100, 3)) * (1 - linked[at] / chars[at])
            held[at] += worth
            # text between blocks is a paragraph of the element it stands in
            up, level = at if nested[at] or not at else parents[at], 0
            while up >= 0 and level < LEVELS:
                points[up] = points.get(up, 0.0) + worth / (3 * level if level > 1 else level + 1)
                up, level = parents[up], level + 1
        if at:
            held[parents[at]] += held[at]
    final = {}
    for at, worth in points.items():
        base = 5.0 if tags[at] in ("div", "article", "section", "main") else -3.0 if tags[at] in ("ul", "ol", "dl", "table", "tr") else 0.0
        good = NAMED_WELL if GOOD & set(page.tokens.get(at, ())) else 0.0
        final[at] = (worth + base + good) * (1 - page.density(at))
    return final, held


def _children(tree: Tree, at: int):
    child = at + 1
    while child < tree.ends[at]:
        yield child
        child = tree.ends[child]


def _plain_paragraph(page: Page, at: int) -> bool:
    """A paragraph that reads like text: long with few links, or short without any and with the end of a sentence."""
    if page.tree.tags[at] not in ("p", "pre", "blockquote"):
        return False
    text = " ".join(t for i in range(at, page.tree.ends[at]) if page.tree.tags[i] is None and not page.gone[i] for t in page.tree.texts[i].split())
    return page.density(at) < 0.25 if len(text) > 80 else not page.links[at] and bool(re.search(r"[.!?…。]", text))


def kept_parts(page: Page) -> list[int]:
    """The elements whose text is the article, in the order of the page."""
    tree = page.tree
    tags, parents = tree.tags, tree.parents
    final, held = scores(page)
    if not final:
        whole = next((i for tag in ("article", "main", "body") for i in range(1, len(tags)) if tags[i] == tag and not page.gone[i] and page.chars[i]), 0)
        return [whole]
    best = max(final, key=lambda at: (final[at], -at))
    up = best
    while up > 0 and tags[up] != "article":
        up = parents[up]
    article = up > 0
    if article:
        best = up
    kept, least = {best}, max(AT_LEAST, SIBLING * final.get(best, held[best]))
    at, level = best, 0
    while at > 0 and tags[at] not in ("body", "main"):
        up = parents[at]
        like = (tags[at], tree.named(at).get("class"))
        for other in _children(tree, up):
            if other == at or page.gone[other] or tags[other] is None:
                continue
            alike = (tags[other], tree.named(other).get("class")) == like
            if article or level:
                take = alike and held[other] >= SIBLING * held[best] and page.density(other) < 0.5
            else:
                heading = tags[other] in HEADINGS and other < at
                take = heading or _plain_paragraph(page, other) or final.get(other, 0.0) + (SIBLING * final[best] if alike else 0.0) >= least and page.density(other) < 0.5
            if take:
                kept.add(other)
        at, level = up, level + 1
    return sorted(kept)


def _menu(page: Page, at: int) -> bool:
    """A list or box of three links or more that holds little else."""
    return page.tree.tags[at] in ("ul", "ol", "div", "section", "table", "dl") and page.links[at] >= 3 and page.density(at) > MENU


def blocks(page: Page, parts: list[int]) -> list[str]:
    """The texts of the blocks in these parts."""
    tree, out, line = page.tree, [], []

    def flush():
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    for part in parts:
        closing: list[int] = []
        at, end, breaks = part, tree.ends[part], 0
        while at < end:
            while closing and closing[-1] <= at:
                closing.pop()
                flush()
            tag = tree.tags[at]
            if page.gone[at] or tag is not None and at != part and _menu(page, at):
                at = tree.ends[at]
                continue
            if tag is None:
                line.append(tree.texts[at])
                breaks = breaks if not tree.texts[at].strip() else 0
            elif tag == "br":
                breaks += 1
                line.append(" ")
                if breaks > 1:
                    flush()
            elif tag in BLOCK:
                flush()
                closing.append(tree.ends[at])
            at += 1
        flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Page(parse(html))
    return "\n".join(blocks(page, kept_parts(page)))


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without html, with text and n_chars."""
    keep = [c for c in pages.columns if c.lower() not in {html.lower(), "text", "n_chars"}]
    source = "_" * (1 + max(map(len, keep), default=0))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = [main_text(x.as_py()) for x in part.column(source)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*keep, "text", "n_chars"])

    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*keep, F.col(html).alias(source)).mapInArrow(run, schema)


def op13_main_text(spark, sf_dir):
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
