"""Queries over document texts: cleaning, statistics, enrichment and feeds."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.rx import any_of, strip, word_count, words
from ..operators import articles
from .tables import spread_out, sql_list, table


def documents(spark, sf_dir):
    """All documents; one without text has an empty one."""
    return spread_out(table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text")))


def doc_language(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.text_language(F.col("text")).alias("language"))


def _cleaned(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("language", text.text_language(F.col("text")))
    return docs.withColumn("cleaned", text.cleaned(F.col("text"), F.col("language")))


def doc_clean(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("doc_id", "language", "cleaned")


def doc_clean_stats(spark, sf_dir):
    docs = _cleaned(spark, sf_dir)
    counted = docs.select(
        "doc_id",
        word_count(F.col("text")).alias("original_words"),
        word_count(F.col("cleaned")).alias("cleaned_words"),
        text.filled_lines(F.col("text")).alias("original_lines"),
        text.filled_lines(F.col("cleaned")).alias("cleaned_lines"),
    )
    removed = F.col("original_words") - F.col("cleaned_words")
    return counted.withColumns(
        {"words_removed": removed, "lines_removed": F.col("original_lines") - F.col("cleaned_lines"), "reduction_percentage": F.coalesce(F.try_divide(removed, F.col("original_words")) * 100, F.lit(0.0))}
    )


def doc_paywall_cut(spark, sf_dir):
    """Where each document would be cut by a notice, after one is put before every fifth line."""
    notice = "Subscribe to continue reading"
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 5 == 4, F.concat(x, F.lit(f" {notice}"))).otherwise(x))
    docs = documents(spark, sf_dir).withColumn("text", F.array_join(lines, "\n"))
    return docs.select("doc_id", text.paywall_line(F.col("text"), F.lit("english")).alias("line"))


def doc_word_stats(spark, sf_dir):
    t = F.col("text")
    return documents(spark, sf_dir).select("doc_id", word_count(t).alias("words"), text.unique_words(t).alias("unique_words"), text.is_repetitive(t).alias("repetitive"))


def doc_complexity(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.complexity(F.col("text")).alias("complexity"))


def doc_entities(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.persons(F.col("text")).alias("persons"), text.locations(F.col("text")).alias("locations"), text.organizations(F.col("text")).alias("organizations"))


def doc_entity_counts(spark, sf_dir):
    """How many documents name each person."""
    docs = documents(spark, sf_dir).select(F.explode(text.persons(F.col("text"))).alias("person"))
    return docs.groupBy("person").agg(F.count("*").alias("documents"))


def doc_sentiment(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.sentiment(F.col("text")).alias("sentiment"))


def first_line(col):
    return strip(F.substring_index(col, "\n", 1))


def doc_importance(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.round(text.importance(F.col("text"), first_line(F.col("text"))), 2).alias("importance"))


def doc_scope(spark, sf_dir):
    n = F.size(text.locations(F.col("text")))
    return documents(spark, sf_dir).select("doc_id", text.geographic_scope(F.col("text"), n).alias("scope"))


def doc_content_type(spark, sf_dir):
    kind = text.content_type(F.substring("text", 1, 1000))
    return documents(spark, sf_dir).select("doc_id", kind.alias("content_type"), text.content_confidence(kind).alias("confidence"), kind.isin(fixed.KEPT_TYPES).alias("kept"))


def slug_path(col):
    """The words of a text as a URL path."""
    return F.concat(F.lit("/"), F.array_join(words(F.lower(col)), "-"))


def doc_topic(spark, sf_dir):
    label = text.topic_label(text.topic(slug_path(F.col("text"))))
    return documents(spark, sf_dir).select("doc_id", label.alias("label"), text.category(label).alias("category"))


def doc_summary(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.summary(F.substring("text", 1, 3000)).alias("summary"))


def doc_repaired(spark, sf_dir):
    """Markdown repair and paragraph breaks of texts in which every third word is emphasised."""
    marked = F.array_join(F.transform(F.split("text", " "), lambda w, i: F.when(i % 3 == 2, F.concat(F.lit("**"), w, F.lit("**"))).otherwise(w)), " ")
    return documents(spark, sf_dir).select("doc_id", text.paragraphs(text.markdown_repaired(marked)).alias("text"))


def doc_section_overlap(spark, sf_dir):
    """How much of each turn's words the next turn of its conversation has."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    share = text.overlap(F.col("text"), F.col("next_text"))
    return turns.join(after, ["conv_id", "turn"]).select("conv_id", "turn", share.alias("overlap"), F.coalesce(share >= 0.8, F.lit(False)).alias("duplicate"))


def _articles(spark, sf_dir):
    """Documents as articles of their source: url from the first words, time from doc_id."""
    docs = documents(spark, sf_dir)
    return docs.select(
        "doc_id", F.col("source").alias("site"), F.col("text").alias("content"), first_line(F.col("text")).alias("title"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com"), F.regexp_replace(slug_path(F.col("text")), r"[;?#\t\r\n]", "")).alias("url"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")), "yyyy-MM-dd'T'00:00:00").alias("extracted_at"),
        F.lit(None).cast("string").alias("ai_processed_at"),
    )


def article_enriched(spark, sf_dir):
    """Analysis of all articles: those skipped and filtered keep their status and reason only."""
    done = articles.analysed(_articles(spark, sf_dir))
    flat = {"n_persons": F.size("entities.persons"), "n_locations": F.size("entities.locations"), "category": F.get("categories", F.lit(0))}
    ok = F.col("status") == "success"
    return done.select(
        "doc_id", "status", "reason", "content_type", "summary", "sentiment", "importance_score", "word_count", "complexity_score", "geographic_scope", *(F.when(ok, v).alias(k) for k, v in flat.items())
    )


def _scored(spark, sf_dir):
    """All articles as if they were news, so that feeds have more to choose from."""
    return articles.analysed(_articles(spark, sf_dir), F.lit("news_article")).where("status = 'success'")


def site_feed_top10(spark, sf_dir):
    return articles.feed_rows(_scored(spark, sf_dir), "site", "doc_id").select("site", "rank", "doc_id", "importance_score", "extracted_at")


def category_feed_top10(spark, sf_dir):
    rows = articles.by_category(_scored(spark, sf_dir))
    return articles.feed_rows(rows, "category", "doc_id").select("category", "rank", "doc_id", "importance_score", "extracted_at")


def boilerplate_lines(spark, sf_dir):
    """The five short lines that each source repeats most, with their counts."""
    found = documents(spark, sf_dir).select("source", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", strip(F.col("line")))
    counts = found.where(F.char_length("line").between(5, 100)).groupBy("source", "line").agg(F.count("*").alias("n")).where("n > 1")
    best = Window.partitionBy("source").orderBy(F.desc("n"), "line")
    return counts.withColumn("rank", F.row_number().over(best)).where("rank <= 5")


QUERIES = {
    f.__name__: f
    for f in (
        doc_language, doc_clean, doc_clean_stats, doc_paywall_cut, doc_word_stats, doc_complexity, doc_entities, doc_entity_counts, doc_sentiment, doc_importance, doc_scope, doc_content_type, doc_topic,
        doc_summary, doc_repaired, doc_section_overlap, article_enriched, site_feed_top10, category_feed_top10, boilerplate_lines,
    )
}

_D = "d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents)"
_STRIP = r"regexp_replace({0}, '^[\s\v\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}]+|[\s\v\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}]+$', '', 'g')"
_WORDS = r"regexp_extract_all({0}, '[^\s\v\x{{1c}}-\x{{1f}}\x{{85}}\x{{a0}}]+')"


def _strip(x):
    return _STRIP.format(x)


def _words(x):
    return _WORDS.format(x)


def _quoted(x):
    return x.replace("'", "''")


def _has(x, parts):
    return "(" + " OR ".join(f"contains({x}, '{_quoted(p)}')" for p in parts) + ")"


def _count(x, parts):
    return "(" + " + ".join(f"contains({x}, '{_quoted(p)}')::INT" for p in parts) + ")"


_LANGUAGE = "CASE " + " ".join(f"WHEN {_has('lower(text)', own)} THEN '{name}'" for name, own in fixed.LANGUAGE_WORDS) + " ELSE 'english' END"


def _case(patterns, x):
    return "CASE language " + " ".join(f"WHEN '{k}' THEN regexp_matches({x}, '(?i){_quoted(any_of(own))}')" for k, own in patterns.items()) + " ELSE false END"


_FINISH_1 = r"regexp_replace(regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), ' +\n', chr(10), 'g')"
_CLEAN = f"""
{_D},
e AS (SELECT doc_id, text, {_LANGUAGE} AS language FROM d),
l AS (SELECT doc_id, language, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM e),
s AS (SELECT doc_id, language, i, {_strip("line")} AS line FROM l),
w AS (SELECT doc_id, min(i) AS cut FROM s WHERE {_case(fixed.PAYWALL, "line")} GROUP BY doc_id),
k AS (SELECT s.doc_id, s.i, s.line FROM s LEFT JOIN w ON s.doc_id = w.doc_id WHERE (cut IS NULL OR i < cut)
        AND (line = '' OR NOT ({_case(fixed.DROPPED_LINES, "line")} OR regexp_matches(line, '(?i){_quoted(any_of(fixed.DROPPED_EVERYWHERE))}')))),
j AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM k GROUP BY doc_id),
f AS (SELECT doc_id, list_filter(list_transform(string_split({_FINISH_1}, chr(10)), lambda x: {_strip("x")}), lambda x: length(x) > 3 OR x = '') AS ls FROM j),
c AS (SELECT e.doc_id, e.language, e.text, coalesce({_strip("array_to_string(ls, chr(10))")}, '') AS cleaned FROM e LEFT JOIN f ON e.doc_id = f.doc_id)
"""
#: Word boundaries of SQL's engine know ASCII only: other letters become underscores first, which are word characters there as well.
_ASCII = r"regexp_replace(text, '[^\x00-\x7f]', '_', 'g')"
_PERSONS = "list_sort(list_distinct(list_concat(" + ", ".join(rf"regexp_extract_all({_ASCII}, '{p}')" for p in fixed.PERSONS) + ")))"
#: Each word between two marks, so that whole names can be told without word boundaries, which know ASCII only.
_WRAPPED = r"regexp_replace(text, '([\p{L}\p{N}_]+)', chr(1) || '\1' || chr(2), 'g')"


def _named(names, flags):
    """The names that stand in a text as whole words."""
    import re

    marked = "|".join(re.sub(r"\w+", lambda m: rf"\x01{m[0]}\x02", n) for n in names)
    return f"regexp_extract_all({_WRAPPED}, '{flags}(?:{_quoted(marked)})')"


_BARE = "replace(replace(x, chr(1), ''), chr(2), '')"
_PLACES = f"list_sort(list_distinct(list_transform(list_concat({', '.join(_named(n, '(?i)') for n in fixed.LOCATIONS)}), lambda x: upper(({_BARE})[1]) || lower(({_BARE})[2:]))))"
_COMPANIES = rf"regexp_extract_all({_WRAPPED}, '\x01[A-Z][A-Za-z]*\x02\s+\x01(?:SA|SAS|SARL|Inc|Corp|Ltd|AG|GmbH)\x02')"
_ORGS = f"list_sort(list_distinct(list_transform(list_concat({', '.join(_named(n, '') for n in fixed.ORGANIZATIONS)}, {_COMPANIES}), lambda x: {_BARE})))"
_N_PLACES = f"len({_PLACES})"


def _importance(x, title):
    n = f"len({_words(x)})"
    return (
        f"round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE + CASE WHEN {n} > 1000 THEN 0.2::DOUBLE WHEN {n} > 500 THEN 0.1::DOUBLE WHEN {n} < 100 THEN -0.3::DOUBLE ELSE 0.0::DOUBLE END"
        f" + least({_count(f'lower({x})', fixed.IMPORTANT)} * 0.05::DOUBLE, 0.3::DOUBLE) + CASE WHEN {_has(f'lower({x})', fixed.LOW_VALUE)} THEN -0.2::DOUBLE ELSE 0.0::DOUBLE END"
        f" + CASE WHEN {_has(f'lower({title})', fixed.URGENT)} THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END)), 2)"
    )


_TITLE = _strip("string_split(text, chr(10))[1]")
_SENTIMENT = f"CASE WHEN {_count('lower(text)', fixed.POSITIVE)} > {_count('lower(text)', fixed.NEGATIVE)} THEN 'positive' WHEN {_count('lower(text)', fixed.NEGATIVE)} > {_count('lower(text)', fixed.POSITIVE)} THEN 'negative' ELSE 'neutral' END"
_SCOPE = f"""CASE WHEN {_has("lower(text)", fixed.SCOPE_LOCAL)} THEN 'local' WHEN {_has("lower(text)", fixed.SCOPE_NATIONAL)} AND NOT contains(lower(text), 'international') THEN 'national'
 WHEN {_has("lower(text)", fixed.SCOPE_INTERNATIONAL)} OR {_N_PLACES} > 2 THEN 'international' ELSE 'regional' END"""
_TYPE = f"CASE WHEN {_has('lower(substr(text, 1, 1000))', fixed.SHOPPING)} THEN 'shopping_guide' WHEN {_has('lower(substr(text, 1, 1000))', fixed.ABOUT)} THEN 'about_page' ELSE 'news_article' END"
_COMPLEXITY = (
    r"least(1.0::DOUBLE, (len(regexp_extract_all(text, '[^\s\v\x{1c}-\x{1f}\x{85}\x{a0}.]+'))::DOUBLE / (len(regexp_extract_all(text, '[.]')) + 1) / 20"
    + f" + coalesce(len(list_distinct({_words('lower(text)')}))::DOUBLE / nullif(len({_words('text')}), 0), 0.0)) / 2)"
)
_SUMMARY = _strip("array_to_string(string_split(substr(text, 1, 3000), '.')[1:3], '. ')") + " || '.'"
_PROMPT = rf"array_to_string(list_filter(string_split(trim(array_to_string({_words('lower(text)')}, '-'), '/'), '-'), lambda x: x <> '' AND NOT regexp_matches(x, '^\d+$')), ' ')"
_TOPIC = "CASE " + " ".join(f"WHEN {_has('prompt', own)} THEN '{name}'" for name, own in fixed.TOPICS) + " ELSE 'general' END"
_CATEGORY = "CASE topic " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fixed.TOPIC_NAMES.items()) + " ELSE 'general' END"
_ARTICLES = f"""
{_D},
a AS MATERIALIZED (SELECT doc_id, source, text, length({_strip("text")}) >= 100 AS long_enough, {_TYPE} AS content_type, round({_importance("text", _TITLE)}, 2) AS importance_score,
        regexp_replace({_PROMPT}, '[;?#]', '', 'g') AS prompt, strftime(DATE '2024-01-01' + (doc_id % 30)::INT, '%Y-%m-%dT00:00:00') AS extracted_at FROM d),
b AS MATERIALIZED (SELECT *, {_TOPIC} AS topic FROM a),
g AS (SELECT *, {_CATEGORY} AS category FROM b)
"""

SQL = {
    "doc_language": f"WITH {_D} SELECT doc_id, {_LANGUAGE} AS language FROM d",
    "doc_clean": f"WITH {_CLEAN} SELECT doc_id, language, cleaned FROM c",
    "doc_clean_stats": f"""WITH {_CLEAN}, n AS (SELECT doc_id, len({_words("text")}) AS original_words, len({_words("cleaned")}) AS cleaned_words,
        len(list_filter(string_split(text, chr(10)), lambda x: {_strip("x")} <> ''))::INT AS original_lines, len(list_filter(string_split(cleaned, chr(10)), lambda x: {_strip("x")} <> ''))::INT AS cleaned_lines FROM c)
        SELECT *, original_words - cleaned_words AS words_removed, original_lines - cleaned_lines AS lines_removed, coalesce((original_words - cleaned_words)::DOUBLE / nullif(original_words, 0) * 100, 0.0) AS reduction_percentage FROM n""",
    "doc_paywall_cut": f"""WITH {_D}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
        m AS (SELECT doc_id, min(i) AS i FROM l WHERE i % 5 = 0 OR regexp_matches(line, '(?i){_quoted(any_of(fixed.PAYWALL["english"]))}') GROUP BY doc_id)
        SELECT d.doc_id, coalesce(i, 0)::INT AS line FROM d LEFT JOIN m ON d.doc_id = m.doc_id""",
    "doc_word_stats": f"WITH {_D}, n AS (SELECT doc_id, len({_words('text')}) AS words, len(list_distinct({_words('text')})) AS unique_words FROM d) SELECT *, coalesce(words > 20 AND unique_words::DOUBLE / nullif(words, 0) < 0.1, false) AS repetitive FROM n",
    "doc_complexity": f"WITH {_D} SELECT doc_id, {_COMPLEXITY} AS complexity FROM d",
    "doc_entities": f"WITH {_D} SELECT doc_id, {_PERSONS} AS persons, {_PLACES} AS locations, {_ORGS} AS organizations FROM d",
    "doc_entity_counts": f"WITH {_D}, p AS (SELECT doc_id, unnest({_PERSONS}) AS person FROM d) SELECT person, count(*) AS documents FROM p GROUP BY person",
    "doc_sentiment": f"WITH {_D} SELECT doc_id, {_SENTIMENT} AS sentiment FROM d",
    "doc_importance": f"WITH {_D} SELECT doc_id, {_importance('text', _TITLE)} AS importance FROM d",
    "doc_scope": f"WITH {_D} SELECT doc_id, {_SCOPE} AS scope FROM d",
    "doc_content_type": f"WITH {_D}, t AS MATERIALIZED (SELECT doc_id, {_TYPE} AS content_type FROM d) SELECT *, CASE content_type WHEN 'shopping_guide' THEN 0.7::DOUBLE WHEN 'about_page' THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END AS confidence, content_type = 'news_article' AS kept FROM t",
    "doc_topic": f"WITH {_D}, p AS MATERIALIZED (SELECT doc_id, {_PROMPT} AS prompt FROM d), t AS MATERIALIZED (SELECT doc_id, {_TOPIC} AS topic FROM p) SELECT doc_id, 'Domeniu: ' || topic || ' (scor: ' || CASE WHEN topic = 'general' THEN '0.50' ELSE '0.75' END || ')' AS label, {_CATEGORY} AS category FROM t",
    "doc_summary": f"WITH {_D} SELECT doc_id, {_SUMMARY} AS summary FROM d",
    "doc_section_overlap": f"""WITH t AS (SELECT conv_id, turn, text, list_distinct({_words("lower(text)")}) AS ws FROM conversations),
        o AS (SELECT a.conv_id, a.turn, CASE WHEN a.text <> '' AND b.text <> '' AND len(a.ws) >= 3 THEN len(list_intersect(a.ws, b.ws))::DOUBLE / len(a.ws) END AS overlap FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
        SELECT *, coalesce(overlap >= 0.8, false) AS duplicate FROM o""",
    "article_enriched": f"""WITH {_ARTICLES}, s AS (SELECT *, CASE WHEN NOT long_enough THEN 'skipped' WHEN content_type <> 'news_article' THEN 'filtered' ELSE 'success' END AS status FROM g)
        SELECT doc_id, status, CASE status WHEN 'skipped' THEN 'Content too short for AI analysis' WHEN 'filtered' THEN 'Content type: ' || content_type || ' (confidence: ' || CASE content_type WHEN 'shopping_guide' THEN '0.70' ELSE '0.80' END || ')' END AS reason,
        content_type, """
    + ", ".join(
        f"CASE WHEN status = 'success' THEN {v} END AS {k}"
        for k, v in {
            "summary": _SUMMARY, "sentiment": _SENTIMENT, "importance_score": "importance_score", "word_count": f"len({_words('text')})", "complexity_score": _COMPLEXITY, "geographic_scope": _SCOPE,
            "n_persons": f"len({_PERSONS})", "n_locations": _N_PLACES, "category": "category",
        }.items()
    )
    + " FROM s",
    "site_feed_top10": f"""WITH {_ARTICLES}, r AS (SELECT source AS site, row_number() OVER (PARTITION BY source ORDER BY importance_score, extracted_at DESC, doc_id) AS rank, doc_id, importance_score, extracted_at
        FROM g WHERE long_enough AND importance_score >= 0.4) SELECT * FROM r WHERE rank <= 10""",
    "category_feed_top10": f"""WITH {_ARTICLES}, r AS (SELECT category, row_number() OVER (PARTITION BY category ORDER BY importance_score, extracted_at DESC, doc_id) AS rank, doc_id, importance_score, extracted_at
        FROM g WHERE long_enough AND importance_score >= 0.4 AND category IN ({sql_list(fixed.FEED_CATEGORIES)[1:-1]})) SELECT * FROM r WHERE rank <= 10""",
    "boilerplate_lines": f"""WITH {_D}, l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM d), s AS (SELECT source, {_strip("line")} AS line FROM l),
        n AS (SELECT source, line, count(*) AS n FROM s WHERE length(line) BETWEEN 5 AND 100 GROUP BY source, line HAVING count(*) > 1),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, line) AS rank FROM n) SELECT * FROM r WHERE rank <= 5""",
}
