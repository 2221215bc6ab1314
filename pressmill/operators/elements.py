"""Selectors as joins: pages become rows of elements once, and everything that selects among them is a Spark plan.

An element has a number in document order (pre), that of the last node below it (last) and its parent's, so that "inside" is an interval of the
same page and "child of" an equality. The steps of all selectors are tested in one pass over the rows; each further step of a chain is
one semi join for all selectors together. The text of a chosen element is the strings of its interval.
"""

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rx import contains_any, strip, word_count
from ..html import candidates, nodes
from .pages import per_page

_COMPOUND = re.compile(r"""([a-zA-Z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([*^$~]?=)\s*(?:"([^"]*)"|'([^']*)'|([^"'\]\s]*))\s*)?\]""")
_STEP = re.compile(r"""\s*(>?)\s*((?:\[[^\]]*\]|[^\s>\[])+)""")


def parsed(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, elements, strings: one parse of each page, in its task. Store it where several plans follow."""

    def make(page):
        return nodes.rows(page or "")

    return per_page(pages.select(key, html), make, [html], f"elements {nodes.ELEMENTS}, strings {nodes.STRINGS}").select(key, "elements", "strings")


def element_rows(trees: DataFrame, key: str = "page_id") -> DataFrame:
    return trees.select(key, F.inline("elements"))


def string_rows(trees: DataFrame, key: str = "page_id") -> DataFrame:
    return trees.select(key, F.inline("strings"))


def chains(selector: str) -> list[list[tuple[bool, str]]]:
    """The alternatives of a selector as steps, outermost first: whether the step is a child of the one before, and its compound."""
    out = []
    for alternative in selector.split(","):
        steps, at = [], 0
        while at < len(alternative.rstrip()):
            found = _STEP.match(alternative, at)
            if not found:
                raise ValueError(f"selector not understood: {selector}")
            steps.append((bool(found[1]), found[2]))
            at = found.end()
        if not steps or steps[0][0]:
            raise ValueError(f"selector not understood: {selector}")
        out.append(steps)
    return out


def compound_test(compound: str) -> Column:
    """Whether an element row fits a tag, .class, #id, [attribute] or [attribute=value] (also *= ^= $= ~=), or several of them at once."""
    tests, at = [], 0
    while at < len(compound):
        found = _COMPOUND.match(compound, at)
        if not found:
            raise ValueError(f"selector not understood: {compound}")
        name, cls, ident, attribute, op, *values = found.groups()
        value = next((v for v in values if v is not None), "")
        own = F.col("attrs")[attribute] if attribute else None
        if name and name != "*":
            tests.append(F.col("name") == name.lower())
        elif cls:
            tests.append(F.array_contains("classes", cls))
        elif ident:
            tests.append(F.col("id").eqNullSafe(ident))
        elif attribute and not op:
            tests.append(own.isNotNull())
        elif attribute:
            some = F.lit(bool(value))
            fits = {"=": own == value, "*=": F.contains(own, F.lit(value)) & some, "^=": F.startswith(own, F.lit(value)) & some, "$=": F.endswith(own, F.lit(value)) & some}
            tests.append(F.coalesce(fits[op] if op in fits else F.array_contains(F.split(own, r"\s+"), value), F.lit(False)))
        at = found.end()
    whole = F.lit(True)
    for test in tests:
        whole = whole & test
    return whole


def matches(elements: DataFrame, selectors: list[str], key: str = "page_id") -> DataFrame:
    """The element rows that a selector matches, with its number in the list as `nth`; one row for each selector that does."""
    alternatives = [(nth, steps) for nth, selector in enumerate(selectors) for steps in chains(selector)]

    def fitting(step: int) -> DataFrame:
        fits = [F.when(compound_test(steps[step][1]), F.lit(a)) for a, (_, steps) in enumerate(alternatives) if len(steps) > step]
        return elements.withColumn("_alt", F.explode(F.array_compact(F.array(*fits))))

    done, reached = [], None
    for step in range(max(len(steps) for _, steps in alternatives)):
        rows = fitting(step)
        if reached is not None:
            outer = reached.select(F.col(key).alias("_key"), F.col("_alt").alias("_outer"), F.col("pre").alias("_pre"), F.col("last").alias("_last"))
            child = F.get(F.array(*(F.lit(len(s) > step and s[step][0]) for _, s in alternatives)), F.col("_alt"))
            below = F.when(child, F.col("parent") == F.col("_pre")).otherwise((F.col("pre") > F.col("_pre")) & (F.col("pre") <= F.col("_last")))
            rows = rows.join(outer, (F.col(key) == F.col("_key")) & (F.col("_alt") == F.col("_outer")) & below, "left_semi")
        ends = [a for a, (_, s) in enumerate(alternatives) if len(s) == step + 1]
        if ends:
            done.append(rows.where(F.col("_alt").isin(ends)))
        reached = rows.where(~F.col("_alt").isin(ends)) if ends else rows
    nth = F.get(F.array(*(F.lit(n) for n, _ in alternatives)), F.col("_alt"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    whole = whole.withColumn("nth", nth).drop("_alt")
    several = len(alternatives) > len(selectors)
    return whole.dropDuplicates([key, "nth", "pre"]) if several else whole


def texts(chosen: DataFrame, strings: DataFrame, key: str = "page_id", between: str = "") -> DataFrame:
    """key, pre, text for the distinct elements chosen: their strings stripped and joined, without those of hidden elements below them."""
    spans = chosen.select(F.col(key).alias("_key"), "pre", "last").distinct()
    inside = (F.col(key) == F.col("_key")) & (F.col("at") > F.col("pre")) & (F.col("at") <= F.col("last")) & (F.col("hidden") <= F.col("pre"))
    bare = strings.select(key, "at", "hidden", strip(F.col("text")).alias("text")).where("text <> ''")
    found = spans.join(bare, inside).groupBy(key, "pre").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("texts"))
    return found.select(key, "pre", F.array_join(F.transform("texts", lambda t: t["text"]), between).alias("text"))


def synthesised() -> Column:
    """An element's own selector: its id, else its classes that are no numbers, else its tag."""
    classes = F.filter("classes", lambda c: ~c.rlike(r"(?U)\A\d+\z"))
    return F.when(F.coalesce("id", F.lit("")) != "", F.concat(F.lit("#"), "id")).when(F.size(classes) > 0, F.concat(F.lit("."), F.array_join(classes, "."))).otherwise(F.col("name"))


def ranked_candidates(elements: DataFrame, strings: DataFrame, key: str = "page_id") -> DataFrame:
    """key, kind, rank, selector, score, text: the best candidates of each kind on each page; of equal ones in the order of the selectors and the page."""
    every = [(kind, css, float(weight)) for kind, weights in candidates.KINDS.items() for css, weight in weights]
    of = lambda values: F.get(F.array(*map(F.lit, values)), F.col("nth"))
    found = matches(elements, [css for _, css, _ in every], key).select(
        key, "nth", "pre", "last", "name", synthesised().alias("own"), F.lower(F.array_join("classes", " ")).alias("names"), F.coalesce(F.col("attrs")["content"], F.lit("")).alias("content")
    )
    meta = F.col("name") == "meta"
    read = found.join(texts(found.where(~meta), strings, key), [key, "pre"], "left")
    read = read.withColumns({"kind": of([k for k, _, _ in every]), "weight": of([w for _, _, w in every]), "css": of([c for _, c, _ in every]), "text": F.when(meta, F.col("content")).otherwise(F.coalesce("text", F.lit("")))})
    chars, holds = F.char_length("text"), lambda word: F.contains("names", F.lit(word)).cast("int") * F.lit(0.5)
    case = lambda **by: F.coalesce(*(F.when(F.col("kind") == k, v) for k, v in by.items()))
    fits = case(titles=chars > 10, subtitles=F.when(meta, chars > 20).otherwise(chars.between(20, 300)), authors=chars.between(3, 100), contents=chars > 200)
    bonus = case(
        titles=holds("title") + (F.col("name") == "h1").cast("int") * F.lit(0.3), subtitles=holds("subtitle"), authors=F.lit(0.0), contents=F.least(word_count(F.col("text")) / F.lit(1000), F.lit(2.0))
    )
    scored = read.where(fits).withColumns({"score": F.col("weight") + F.when(meta, F.lit(0.0)).otherwise(bonus), "selector": F.when(meta, F.col("css")).otherwise(F.col("own"))})
    order = Window.partitionBy(key, "kind").orderBy(F.desc("score"), "nth", "pre")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= candidates.MOST)
    return best.select(key, "kind", "rank", "selector", "score", F.substring("text", 1, candidates.SHOWN).alias("text"))


def removable(elements: DataFrame, key: str = "page_id") -> DataFrame:
    """key, rank, selector: elements whose classes or id tell that they are no content, in the order of the page, the first twenty."""
    names = F.concat_ws(" ", F.lower(F.array_join("classes", " ")), F.lower(F.coalesce("id", F.lit(""))))
    found = elements.where(contains_any(names, candidates.REMOVABLE)).groupBy(key, synthesised().alias("selector")).agg(F.min("pre").alias("first"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("first"))).where(F.col("rank") <= candidates.MOST_REMOVED).select(key, "rank", "selector")


def first_texts(elements: DataFrame, strings: DataFrame, wanted: dict[str, list[str]], key: str = "page_id", least: int = 4) -> DataFrame:
    """key, name, text: for each name the text of the first selector, and there of the first element, that has `least` characters; a meta tag's is its content."""
    every = [(name, css) for name, selectors in wanted.items() for css in selectors]
    found = matches(elements, [css for _, css in every], key).select(key, "nth", "pre", "last", "name", F.col("attrs")["content"].alias("content"))
    own = (F.col("name") == "meta") & F.col("content").isNotNull()
    read = found.join(texts(found.where(~own), strings, key), [key, "pre"], "left")
    read = read.withColumn("text", F.when(own, strip(F.col("content"))).otherwise(F.col("text"))).where(F.char_length("text") >= least)
    name = F.get(F.array(*(F.lit(n) for n, _ in every)), F.col("nth"))
    return read.groupBy(key, name.alias("name")).agg(F.min_by("text", F.struct("nth", "pre")).alias("text"))


def totals(ranked: DataFrame, sites: DataFrame, key: str = "page_id", site: str = "site", most: int = 10) -> DataFrame:
    """site, kind, selector, score, rank: the candidates' scores added up over the pages of a site; ties in order of the selector."""
    each = ranked.join(sites.select(key, site), key)
    total = each.groupBy(site, "kind", "selector").agg(F.sum(F.col("score").cast("decimal(20,6)")).cast("double").alias("score"))
    order = Window.partitionBy(site, "kind").orderBy(F.desc("score"), "selector")
    return total.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
