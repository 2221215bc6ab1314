"""Rules of a new site, from what its sample pages suggest: one small document per site."""

import json
import re

import pandas as pd
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pages

# Parts of rules that do not depend on the site.
CONTENT_FILTERS = {
    "require_article_id": True,
    "article_id_pattern": r"-(\d{4,})(?:\.html?)?$",
    "min_word_count": 150,
    "additional_skip_patterns": ["/tag/", "/category/", "/author/", "/contact", "/about", "/privacy", "/search/", "/page/"],
}
ARTICLE_FALLBACKS = [".article-content", ".post-content", ".entry-content", "article", "main"]
COMMON_REMOVED = [".advertisement", ".ads", ".social-share", ".navigation", ".header", ".footer", ".comments", ".sidebar", ".related"]
DATE_SELECTOR = ".date, .post-date, time, [datetime]"
AUTHOR_SELECTOR = ".author, .byline, .by-author"
CLEANUP = {
    "fr": {
        "subscription_walls": [r"Il vous reste \d+[.,]\d*% de cet article à lire.*", "La suite est réservée aux abonnés.*", "Article réservé à nos abonnés.*"],
        "navigation_elements": ["Lire aussi.*", "Voir aussi.*"],
        "social_sharing": ["Partager cet article.*", "Suivez.*?sur.*"],
    },
    "ro": {
        "subscription_walls": ["Restul articolului este rezervat abonaților.*", "Pentru a citi restul articolului.*abonează-te.*"],
        "navigation_elements": ["Citește și:.*", "Vezi și:.*"],
        "social_sharing": ["Distribuie acest articol.*", "Urmărește.*?pe.*"],
    },
    "en": {
        "subscription_walls": ["Read more.*subscription.*", "Subscribe to continue.*", "This article is for subscribers.*"],
        "navigation_elements": ["Read more.*", "See also.*"],
        "social_sharing": ["Share this article.*", "Follow.*?on.*"],
    },
}
AUTHOR_FORMATS = {"fr": "*{content}*", "ro": "*De {content}*", "en": "*By {content}*"}
SECTION_OPTIONS = {"trim_whitespace": True, "remove_empty_sections": True, "add_separator_between_sections": True, "separator": "\n\n", "max_section_length": 500, "skip_duplicates": True}


def _custom_sections(language: str, best: dict[str, list[str]]) -> dict:
    named = [
        ("title", f"Main article title in {language}", best["titles"], ["h1", "title"], "# {content}"),
        ("subtitle", f"Article subtitle or lead in {language}", best["subtitles"], ["h2", ".lead", 'meta[name="description"]'], "## {content}"),
        ("author_details", f"Enhanced author information in {language}", best["authors"], None, AUTHOR_FORMATS.get(language, "*{content}*")),
    ]
    out = []
    for order, (name, about, own, fallback, form) in enumerate(named, 1):
        rule = {"name": name, "description": about, "selectors": own[:5], "fallback_selectors": fallback, "format": form, "required": False, "order": order}
        out.append({k: v for k, v in rule.items() if v is not None})
    return {"enabled": True, "sections": out, "processing_options": SECTION_OPTIONS}


def rules_of(domain: str, language: str, best: dict[str, list[str]], removed: list[str], boilerplate: list[str]) -> dict:
    """The rules document of a site. best: selectors of each kind, best first."""
    cleanup = {**CLEANUP.get(language, CLEANUP["en"]), "newsletter_promotional": [], "boilerplate_removal": [re.escape(t) for t in boilerplate]}
    order = ("subscription_walls", "navigation_elements", "social_sharing", "newsletter_promotional", "boilerplate_removal")
    return {
        "domain": domain if domain.startswith("www.") else f"www.{domain}",
        "language": language,
        "content_filters": CONTENT_FILTERS,
        "article_selectors": list(dict.fromkeys([*best["contents"][:5], *ARTICLE_FALLBACKS]))[:10],
        "remove_selectors": list(dict.fromkeys([*removed[:15], *COMMON_REMOVED])),
        "title_selector": (best["titles"] or ["h1"])[0],
        "date_selector": DATE_SELECTOR,
        "author_selector": (best["authors"] or [AUTHOR_SELECTOR])[0],
        "cleanup_patterns": {k: cleanup[k] for k in order},
        "custom_content_sections": _custom_sections(language, best),
    }


def as_yaml(rules: dict) -> str:
    return yaml.dump(rules, default_flow_style=False, allow_unicode=True, sort_keys=False)


def report(sites: DataFrame, found: DataFrame, analysis: DataFrame, rules: DataFrame, now) -> DataFrame:
    """site, found, successful, failed, average_words, language, created_at and whether the site has rules; a row for each site."""
    n = found.groupBy("site").agg(F.count("*").alias("found"))
    checked = pages.validated(analysis, "site").drop("pages")
    rows = sites.select("site").distinct().join(n, "site", "left").join(checked, "site", "left").join(rules.select("site", "language"), "site", "left")
    zero = {"found": 0, "successful": 0, "failed": 0, "average_words": 0.0}
    return rows.fillna(zero).withColumns({"has_rules": F.col("language").isNotNull(), "created_at": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss")})


def save(rules: DataFrame, found: DataFrame, folder: str) -> None:
    """The rules as one text file per site below {folder}/rules/file=<site>, and the report as JSON lines."""
    named = rules.select(F.regexp_replace("site", r"^www\.", "").alias("file"), "config")
    named.repartition("file").write.mode("overwrite").partitionBy("file").text(f"{folder}/rules")
    found.write.mode("overwrite").json(f"{folder}/report")


def saved_rules(spark, folder: str) -> DataFrame:
    """site, config as saved."""
    return spark.read.text(f"{folder}/rules", wholetext=True).select(F.col("file").alias("site"), F.rtrim("value").alias("config"))


def site_rules(analysis: DataFrame, site: str, first: str) -> DataFrame:
    """site, language, config (YAML) from analysed sample pages; first orders pages where languages tie."""
    scores = pages.selector_scores(analysis, site)
    lists = scores.groupBy(site).agg(*(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("rank", "selector")))).alias(k) for k in ("titles", "subtitles", "authors", "contents")))
    removed = analysis.select(site, F.explode("removable").alias("value")).distinct()
    from pyspark.sql import Window

    ranked = removed.withColumn("rank", F.row_number().over(Window.partitionBy(site).orderBy("value"))).where("rank <= 20")
    gone = ranked.groupBy(site).agg(F.array_sort(F.collect_list("value")).alias("removed"))
    repeated = pages.most_common(analysis, site, "repeated", 5).where("n > 1").groupBy(site).agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("boilerplate"))
    rows = pages.site_language(analysis, site, first).join(lists, site, "left").join(gone, site, "left").join(repeated, site, "left")

    @F.pandas_udf("string")
    def render(domain: pd.Series, language: pd.Series, best: pd.Series, removed: pd.Series, boilerplate: pd.Series) -> pd.Series:
        made = []
        for d, lang, b, r, t in zip(domain, language, best, removed, boilerplate):
            made.append(as_yaml(rules_of(d, lang, json.loads(b), list(r) if r is not None else [], list(t) if t is not None else [])))
        return pd.Series(made)

    best = F.to_json(F.struct(*(F.coalesce(F.col(f"{k}.selector"), F.array().cast("array<string>")).alias(k) for k in ("titles", "subtitles", "authors", "contents"))))
    return rows.select(site, "language", render(F.col(site), F.col("language"), best, F.col("removed"), F.col("boilerplate.value")).alias("config"))
