"""Queries over sections by rules, plugged-in models, link resolution, storage and type counts."""

from pyspark.sql import functions as F

from ..functions import models, scripts, text, urls
from ..html import dom, sections
from ..operators import monitor, pages
from .html_queries import _PAGES
from .html_queries import _pages as page_rows
from .tables import page_urls, sql_list, table
from .text_queries import _CLEAN, _D, _PROMPT, _TYPE, doc_content_type, documents, slug_path

#: Sections for every site: a title, the beginning of the article in front of it, and one that no page has.
SECTIONS = {
    "custom_content_sections": {
        "enabled": True,
        "sections": [
            {"name": "head", "selectors": ["h1"], "format": "# {content}", "order": 2},
            {"name": "start", "selectors": [".none"], "fallback_selectors": ["article"], "format": "*{content}*", "order": 1},
            {"name": "title", "selectors": [".none"]},
        ],
        "processing_options": {"max_section_length": 60},
    }
}


def page_sections(spark, sf_dir):
    """The sections of each page, in order, long ones cut at a word."""

    def make(html):
        return (sections.sections(dom.parse(html or ""), SECTIONS),)

    return pages.per_page(page_rows(spark, sf_dir).select("page_id", "html"), make, ["html"], "sections string").select("page_id", "sections")


#: Patterns whose matches go from the texts of a site, before the general cleaning.
OWN_PATTERNS = {"site0": ["^the .*$"], "site1": ["and|of", "ing$"]}


def doc_rules_cleaned(spark, sf_dir):
    """Documents dealt to three sites, cleaned by the sites' own patterns first."""
    docs = documents(spark, sf_dir).withColumn("domain", F.concat(F.lit("site"), (F.col("doc_id") % 3).cast("string")))
    return docs.select("doc_id", text.cleaned_by_rules(F.col("text"), F.col("domain"), OWN_PATTERNS).alias("cleaned"))


class LengthModel:
    """Stands in for a language model: answers depend on the length of what it is given."""

    def summarize(self, texts, max_length, min_length):
        return [f"{t[:max_length]}... {len(t)}" for t in texts]

    def classify(self, texts, labels):
        return [(labels[len(t) % len(labels)], 0.5) for t in texts]


def model_answers(spark, sf_dir):
    """Summary, topic and type of each document by a model."""
    url = F.concat(F.lit("https://"), F.col("source"))
    found = documents(spark, sf_dir).select(
        "doc_id", models.summary(F.col("text"), LengthModel).alias("summary"), models.topic(slug_path(F.col("text")), LengthModel).alias("topic"), models.content_type(F.col("text"), url, LengthModel).alias("kind")
    )
    return found.select("doc_id", "summary", F.col("topic.label").alias("topic"), F.col("kind.label").alias("content_type"), F.col("kind.score").alias("score"))


def doc_type_counts(spark, sf_dir):
    return doc_content_type(spark, sf_dir).groupBy("content_type").agg(F.count("*").alias("n"))


def url_sites(spark, sf_dir):
    """Hosts without and with www."""
    host = urls.part(F.col("url"), "netloc")
    return page_urls(spark, sf_dir).select("page_id", urls.bare_domain(F.upper(host)).alias("bare"), urls.full_domain(host).alias("full_domain"))


def url_resolved(spark, sf_dir):
    """A link of one of five forms on each page, made absolute."""
    forms = F.array(F.concat(F.lit("/a/"), F.col("page_id")), F.lit("//other.example/x"), F.lit("?q=1"), F.lit("#part"), F.lit("https://other.example/y?z"))
    return page_urls(spark, sf_dir).select("page_id", urls.resolved(F.get(forms, (F.col("page_id") % 5).cast("int")), F.col("url")).alias("resolved"))


def storage_alerts(spark, sf_dir):
    """Alerts for volumes, one per user and hour of events, by how full they are."""
    rows = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 500).alias("volume")).agg(F.sum(F.length("props")).alias("used"), F.count("*").alias("n"))
    return rows.select("volume", monitor.storage_alert_of(F.col("used"), F.col("n") * 60).alias("alert"))


#: What scripts of a page made from an event assign: the event as an object whose place, quoting and soundness vary.
_STATES = [
    'var state = {"article": {"id": ID, "kind": "KIND", "list": [PROPS, {"t": "&lt;b&gt;KIND&lt;/b&gt; &amp;amp; more&nbsp;&#233;"}]}};', 'window.state = {"article": {"kind": {"of": "KIND"}, "list": [{"t": 5}, {"t": "<i>a</i><p> KIND </p>"}]}};',
    'var state = {"article": {"kind": "broken};</script><script>window.state = {"article": {"kind": "second KIND", "list": []}};', 'other = {"article": {"kind": "not this"}}; state = {"article": PROPS};',
]


def script_texts(spark, sf_dir):
    """Texts at three paths of the objects that scripts assign."""
    made = F.element_at(F.array(*map(F.lit, _STATES)), (F.pmod("event_id", F.lit(len(_STATES))) + 1).cast("int"))
    made = F.replace(F.replace(F.replace(made, F.lit("ID"), F.col("event_id").cast("string")), F.lit("KIND"), F.col("event_type")), F.lit("PROPS"), F.col("props"))
    html = F.concat(F.lit("<html><script>var a = 1;</script><script type='x'>"), made, F.lit("</script><p>state</p></html>"))
    return table(spark, sf_dir, "events").select("event_id", scripts.script_text(html, "state.article.kind").alias("kind"), scripts.script_text(html, "state.article.list[1].t").alias("t"), scripts.script_text(html, "state.article.k").alias("k"))


QUERIES = {f.__name__: f for f in (script_texts, page_sections, doc_rules_cleaned, model_answers, doc_type_counts, url_sites, url_resolved, storage_alerts)}


def _cut(x):
    return f"CASE WHEN length({x}) > 60 THEN regexp_replace(substr({x}, 1, 60), ' [^ ]*$', '') || '...' ELSE {x} END"


def _without(x, patterns):
    for pattern in patterns:
        x = f"regexp_replace({x}, '(?im){pattern}', '', 'g')"
    return x


_OWN = f"d AS (SELECT doc_id, source, CASE doc_id % 3 WHEN 0 THEN {_without('t', OWN_PATTERNS['site0'])} WHEN 1 THEN {_without('t', OWN_PATTERNS['site1'])} ELSE t END AS text FROM (SELECT *, coalesce(text, '') AS t FROM documents))"
_SHARE = "used::DOUBLE / (n * 60) * 100"
_HTML = "CASE event_id % 4 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_STATES)) + " END"
_OBJECT = r"""CASE event_id % 4 WHEN 2 THEN regexp_extract(html, 'window\.state\s*=\s*(\{.*?\});', 1) ELSE regexp_extract(html, '(?:^| |\.)state = (\{.*?\});', 1) END"""
SQL = {
    "script_texts": f"""WITH h AS (SELECT event_id, replace(replace(replace({_HTML}, 'ID', event_id::VARCHAR), 'KIND', event_type), 'PROPS', props) AS html FROM events), o AS (SELECT event_id, {_OBJECT}::JSON AS o FROM h),
        v AS (SELECT event_id, CASE WHEN json_type(o, '$.article.kind') = 'VARCHAR' THEN o ->> '$.article.kind' ELSE '' END AS kind, CASE WHEN json_type(o, '$.article.list[1].t') = 'VARCHAR' THEN o ->> '$.article.list[1].t' ELSE '' END AS t,
        CASE WHEN json_type(o, '$.article.k') = 'VARCHAR' THEN o ->> '$.article.k' ELSE '' END AS k FROM o)
        SELECT event_id, kind, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&amp;amp;', '&'), '&nbsp;', chr(160)), '&#233;', 'é'), '<[^>]*>', ' ', 'g'), ' +', ' ', 'g')) AS t, k FROM v""",
    "page_sections": f"WITH {_PAGES} SELECT page_id, concat_ws(chr(10) || chr(10), CASE WHEN length(body) > 3 THEN '*' || {_cut('body')} || '*' END, CASE WHEN length(h1) > 3 THEN '# ' || {_cut('h1')} END) AS sections FROM p",
    "doc_rules_cleaned": f"WITH {_CLEAN.replace(_D, _OWN)} SELECT doc_id, cleaned FROM c",
    "model_answers": f"""WITH {_D} SELECT doc_id, substr(text, 1, 100) || '... ' || length(substr(text, 1, 3000)) AS summary, {sql_list(models.TOPICS)}[length({_PROMPT}) % {len(models.TOPICS)} + 1] AS topic,
        {sql_list(models.TYPES)}[(length('This web content from URL  appears to be about: ') + coalesce(length('https://' || source), 0) + length(substr(text, 1, 500))) % {len(models.TYPES)} + 1] AS content_type, 0.5::DOUBLE AS score FROM d""",
    "doc_type_counts": f"WITH {_D} SELECT {_TYPE} AS content_type, count(*) AS n FROM d GROUP BY 1",
    "url_sites": "SELECT page_id, regexp_replace(h, '^www\\.', '') AS bare, CASE WHEN starts_with(h, 'www.') THEN h ELSE 'www.' || h END AS full_domain FROM (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS h FROM pages)",
    "url_resolved": """SELECT page_id, CASE page_id % 5 WHEN 0 THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || '/a/' || page_id WHEN 1 THEN regexp_extract(url, '^[a-z]+:') || '//other.example/x'
        WHEN 2 THEN regexp_extract(url, '^[^?#]*') || '?q=1' WHEN 3 THEN regexp_extract(url, '^[^#]*') || '#part' ELSE 'https://other.example/y?z' END AS resolved FROM pages""",
    "storage_alerts": f"""WITH v AS (SELECT user_id % 500 AS volume, sum(length(props))::BIGINT AS used, count(*) AS n FROM events GROUP BY 1)
        SELECT volume, CASE WHEN {_SHARE} >= 90 THEN printf('CRITICAL: Disk usage at %.1f%%', {_SHARE}) WHEN {_SHARE} >= 80 THEN printf('WARNING: Disk usage at %.1f%%', {_SHARE}) END AS alert FROM v""",
}
