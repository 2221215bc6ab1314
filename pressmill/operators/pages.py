"""Pages as tables: one parse per page in an Arrow task, everything around it in Spark's own functions."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as texts
from ..functions import urls
from ..functions.rx import contains_any, let, strip, word_count
from ..html import article, candidates, clean, dom, sections
from ..scratch import stored

PARSED = (
    "parts array<struct<kind:string,nth:int,selector:string,name:string,classes:string,chars:int,words:int,text:string>>, named array<struct<selector:string,names:string>>, strings array<string>, "
    "lang string, page_text string, classes array<string>, ids array<string>"
)
EXTRACTION = "cleaned_html string, extracted string, sections string, headers map<string,int>, title string, author string, date string"
#: html.parser trees and texts of so many pages are in a task's memory at once.
ROWS = 64


def per_page(pages: DataFrame, make: Callable[..., tuple], inputs: list[str], added: str, without: tuple[str, ...] = ()) -> DataFrame:
    """pages with the columns that make(*inputs) gives for each row, but without those that only it needs; rows stay in their partitions."""
    from pyspark.sql.pandas.types import to_arrow_schema

    new = T._parse_datatype_string(added)
    keep = [c for c in pages.columns if c not in new.names and c not in without]
    # a column that is kept is sent once
    sent = [c if c in keep else f"_in{i}" for i, c in enumerate(inputs)]
    kinds = to_arrow_schema(new)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                rows = [make(*x) for x in zip(*(part.column(c).to_pylist() for c in sent))]
                made = [pa.array(list(column), kinds.field(k).type) for k, column in enumerate(zip(*rows))] if rows else [pa.array([], f.type) for f in kinds]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=[*keep, *new.names])

    schema = T.StructType([*(pages.schema[c] for c in keep), *new.fields])
    return pages.select(*keep, *(F.col(c).alias(s) for c, s in zip(inputs, sent) if s not in keep)).mapInArrow(run, schema)


def rewritten(pages: DataFrame, how: str) -> DataFrame:
    """pages with html rewritten: `strip`, `clean`, `light` or `marked`. Pages that cannot be parsed stay as they are."""
    work = {"strip": clean.strip_irrelevant, "clean": clean.clean, "light": clean.clean_lightly, "marked": clean.marked}[how]

    def make(html):
        try:
            return (work(html) if html is not None else None,)
        except RecursionError:
            return (html,)

    return per_page(pages, make, ["html"], "html string")


def _scored(kind: str) -> Column:
    """The best candidates of a kind: selector, score, text; of equal ones in the order of the selectors and the page."""
    n, meta = (lambda p: p["chars"]), (lambda p: p["name"] == "meta")
    fits = {
        "titles": lambda p: n(p) > 10,
        "subtitles": lambda p: F.when(meta(p), n(p) > 20).otherwise(n(p).between(20, 300)),
        "authors": lambda p: n(p).between(3, 100),
        "contents": lambda p: n(p) > 200,
    }[kind]
    holds = lambda p, word: F.contains(p["classes"], F.lit(word)).cast("int") * F.lit(0.5)
    bonus = {
        "titles": lambda p: holds(p, "title") + (p["name"] == "h1").cast("int") * F.lit(0.3),
        "subtitles": lambda p: holds(p, "subtitle"),
        "authors": lambda p: F.lit(0.0),
        "contents": lambda p: F.least(p["words"] / F.lit(1000), F.lit(2.0)),
    }[kind]
    weights = F.array(*(F.lit(float(w)) for _, w in candidates.KINDS[kind]))
    own = F.filter("parts", lambda p: (p["kind"] == kind) & fits(p))
    score = lambda p: F.element_at(weights, p["nth"] + 1) + F.when(meta(p), F.lit(0.0)).otherwise(bonus(p))
    ranked = F.array_sort(F.transform(own, lambda p, i: F.struct((-score(p)).alias("minus"), i.alias("i"), p["selector"].alias("selector"), p["text"].alias("text"))))
    return F.transform(F.slice(ranked, 1, candidates.MOST), lambda c: F.struct(c["selector"].alias("selector"), (-c["minus"]).alias("score"), c["text"].alias("text")))


def _removable() -> Column:
    """Selectors of elements whose classes or id tell that they are no content, in the order of the page."""
    own = F.filter("named", lambda e: contains_any(e["names"], candidates.REMOVABLE))
    return F.slice(F.array_distinct(F.transform(own, lambda e: e["selector"])), 1, candidates.MOST_REMOVED)


def _page_language() -> Column:
    """By the page's own attribute, else by common words near its top, else English."""
    own, text = F.lower(F.substring("lang", 1, 2)), F.lower(F.substring("page_text", 1, 1000))
    by_words = F.coalesce(*(F.when(contains_any(text, list(words)), F.lit(name)) for name, words in candidates.LANGUAGE_WORDS), F.lit("en"))
    return F.when(own.isin(*candidates.LANGUAGES), own).otherwise(by_words)


def _repeated() -> Column:
    """Short strings that stand in a page more than once, the most frequent first, then in the order of the page."""
    short = F.array_sort(F.transform(F.filter("strings", lambda s: F.char_length(s).between(5, 100)), lambda s, i: F.struct(s.alias("s"), i.alias("i"))))

    def starts(all_short):
        each = F.transform(all_short, lambda x, i: F.struct(x["s"].alias("s"), x["i"].alias("first"), i.alias("at"), ((i == 0) | (F.get(all_short, i - 1)["s"] != x["s"])).alias("new")))
        return let(F.filter(each, lambda x: x["new"]), lambda found: counted(found, F.size(all_short)))

    def counted(found, n):
        return F.transform(found, lambda x, i: F.struct((x["at"] - F.coalesce(F.get(found, i + 1)["at"], n)).alias("minus"), x["first"].alias("first"), x["s"].alias("s")))

    # arrays are bound once: named inside a lambda they would be sorted anew for each string
    return F.transform(F.slice(F.array_sort(F.filter(let(short, starts), lambda c: c["minus"] < -1)), 1, candidates.MOST_REPEATED), lambda c: c["s"])


def analysed(pages: DataFrame) -> DataFrame:
    """pages with selector candidates of each kind, parts to remove, language, repeated texts, classes and ids.

    A page is parsed once, in its task, to candidates and strings; thresholds, scores and ranks are Spark's.
    """

    def make(html):
        try:
            found = candidates.page(html or "")
        except RecursionError:
            found = candidates.page("")
        return tuple(found[k] for k in ("parts", "named", "strings", "lang", "page_text", "classes", "ids"))

    rows = per_page(pages, make, ["html"], PARSED)
    scored = {kind: _scored(kind) for kind in candidates.KINDS}
    return rows.withColumns(
        scored | {"removable": _removable(), "language": _page_language(), "repeated": _repeated(), "text_chars": F.char_length("page_text"), "text_words": word_count(F.col("page_text"))}
    ).drop("parts", "named", "strings", "lang", "page_text")


def selector_scores(analysis: DataFrame, site: str) -> DataFrame:
    """site, kind, selector, score, rank: the ten selectors of each kind with the highest total; ties in order of the selector."""
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("found")) for k in ("titles", "subtitles", "authors", "contents"))))
    each = analysis.select(F.col(site), kinds.alias("k")).select(site, F.col("k.kind").alias("kind"), F.explode("k.found").alias("c"))
    total = each.groupBy(site, "kind", F.col("c.selector").alias("selector")).agg(F.sum(F.col("c.score").cast("decimal(20,6)")).cast("double").alias("score"))
    order = Window.partitionBy(site, "kind").orderBy(F.desc("score"), "selector")
    return total.withColumn("rank", F.row_number().over(order)).where("rank <= 10")


def most_common(analysis: DataFrame, site: str, column: str, most: int) -> DataFrame:
    """site, value, n, rank: the most frequent entries of an array column; ties in order of the value."""
    counts = analysis.select(site, F.explode(column).alias("value")).groupBy(site, "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy(site).orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def site_language(analysis: DataFrame, site: str, first: str) -> DataFrame:
    """site, language: the most frequent one; of equal ones that of the earliest page."""
    counts = analysis.groupBy(site, "language").agg(F.count("*").alias("n"), F.min(first).alias("first"))
    return counts.groupBy(site).agg(F.min_by("language", F.struct((-F.col("n")).alias("fewer"), "first")).alias("language"))


def validated(analysis: DataFrame, site: str) -> DataFrame:
    """site, pages, successful, failed, average_words: a page passes with over 500 characters of text."""
    ok = F.col("text_chars") > 500
    return analysis.groupBy(site).agg(
        F.count("*").alias("pages"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), F.coalesce(F.avg(F.when(ok, F.col("text_words"))), F.lit(0.0)).alias("average_words")
    )


def _meta(root, index, *selectors):
    return sections.first_text(root, list(selectors), index) or None


def _extraction(method: str, rules: dict):
    def make(html, domain, url_title):
        try:
            formatted = clean.marked(html or "")
            # one tree for all: sections, metadata and headers are read before it is cleaned
            root = dom.parse(formatted)
            own = sections.sections(root, rules.get(domain) or {}, url_title or "")
            index = dom.index(list(root.elements()))
            title = _meta(root, index, 'meta[property="og:title"]', "title", "h1")
            author = _meta(root, index, 'meta[name="author"]', ".author", ".byline", '[rel="author"]')
            date = _meta(root, index, 'meta[property="article:published_time"]', 'meta[name="date"]')
            headers = article.headers_in(root)
            cleaned = clean.cleaned(root) if method == "dense" else clean.lightly_cleaned(root)
            found = article.paragraph_spaced(article.main_text_of(root)) if method == "dense" else None
        except RecursionError:
            return html, None, "", {}, None, None, None
        return cleaned, found, own, headers, title, author, date

    return make


def _with_dense_runs(rows: DataFrame) -> DataFrame:
    """rows with `extracted`: the best run of blocks of the cleaned page. The rows are stored once, as their numbers must hold."""
    from . import blocks, elements

    numbered = stored(rows.drop("extracted").withColumn("_row", F.monotonically_increasing_id()))
    strings = elements.string_rows(elements.parsed(numbered, "_row", "cleaned_html"), "_row")
    # Spark cannot tell how long texts from a task are, and would send all of them through the driver
    found = blocks.main_texts(strings, "_row").select("_row", F.col("text").alias("extracted")).hint("merge")
    return numbered.drop("cleaned_html").join(found, "_row", "left").drop("_row")


def gated(pages: DataFrame, rules: dict | None = None, method: str = "dense") -> DataFrame:
    """Pages (domain, url, html) with what is extracted of each, and skip_type and reason of the first gate that stops it; without html."""
    # pages and what is left of them are measured where they are made, so that no later step carries them
    titled = pages.withColumns({"_title": urls.url_title(F.col("url"), F.col("domain")), "_raw": F.char_length(strip(F.col("html"))), "_chars": F.char_length("html")})
    rows = per_page(titled, _extraction(method, rules or {}), ["html", "domain", "_title"], EXTRACTION, without=("html", "_title"))
    rows = rows.withColumns({"_cut": F.char_length(strip(F.col("cleaned_html"))), "_cut_chars": F.char_length("cleaned_html")})
    rows = rows.drop("cleaned_html") if method == "dense" else _with_dense_runs(rows)
    rows = rows.withColumn("_got", strip(F.coalesce("extracted", F.lit(""))))
    raw, cut, got = F.col("_raw"), F.col("_cut"), F.col("_got")
    least, name = (100, "cleaned_html_too_small") if method == "dense" else (500, "light_cleaned_html_too_small")
    ratio = F.try_divide(texts.unique_words(got), word_count(got))
    tests = [
        (F.coalesce(raw, F.lit(0)) < 200, "html_too_small", F.format_string("HTML file too small (%d chars)", F.coalesce("_chars", F.lit(0)))),
        (cut < least, name, F.format_string("HTML cleaning left too little content (%d chars)", F.col("_cut_chars"))),
        (got == "", "extraction_failed_no_text", F.lit("Extraction returned no text")),
        (F.char_length(got) < 100, "extracted_text_too_short", F.format_string("Extracted text too short (%d chars)", F.char_length(got))),
        (texts.is_repetitive(got), "repetitive_content", F.format_string("Extracted text appears repetitive (unique word ratio: %.2f%%)", ratio * 100)),
    ]
    verdict = F.coalesce(*(F.when(hit, F.struct(F.lit(kind).alias("skip_type"), reason.alias("reason"))) for hit, kind, reason in tests))
    found = rows.withColumn("_verdict", verdict).withColumns({"skip_type": F.col("_verdict.skip_type"), "reason": F.col("_verdict.reason")})
    return found.drop("_verdict", "_raw", "_chars", "_cut", "_cut_chars", "_got")


def extracted(pages: DataFrame, rules: dict | None = None, method: str = "dense", now: Column | None = None) -> DataFrame:
    """Articles of pages (domain, url, html): markdown and metadata, or skip_type and reason.

    method: `dense` cleans strictly and takes the heaviest element; `light` leaves more of the page and takes the best run of its blocks. rules: the rules of each domain, a small
    table in hand. The page passes the gates in order; one that fails keeps no markdown.
    """
    spaced = gated(pages, rules, method).withColumn("_text", F.when(F.col("skip_type").isNull(), texts.paragraphs(texts.markdown_repaired(F.col("extracted"))))).drop("extracted")
    headed = per_page(spaced, lambda t, known: (article.with_headers(t, dict(known or {})) if t is not None else None,), ["_text", "headers"], "_text string", without=("headers",))
    # sections stand in front unless the text has most of their words already
    front = (F.col("sections") != "") & ~F.coalesce(texts.overlap(F.col("sections"), F.col("_text")) >= 0.8, F.lit(False))
    whole = F.when(front, F.concat("sections", F.lit("\n\n"), "_text")).otherwise(F.col("_text"))
    own = {d: r["cleanup_patterns"] for d, r in (rules or {}).items() if r.get("cleanup_patterns")}
    flat = {d: [p for group in groups.values() for p in group] for d, groups in own.items()}
    markdown = texts.cleaned_by_rules(whole, F.col("domain"), flat)
    at = F.current_timestamp() if now is None else now
    out = headed.withColumn("markdown", F.when(F.col("skip_type").isNull(), markdown))
    return out.withColumns(
        {"content_length": F.char_length("markdown"), "extraction_method": F.lit(method), "extracted_at": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), "custom_sections_found": F.col("sections") != ""}
    ).drop("_text")
