"""Analysed articles, and the feeds that select from them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text, urls
from ..functions.rx import strip, word_count


def analysed(articles: DataFrame, fallback_type: Column | None = None) -> DataFrame:
    """articles (content, title, url, ...) with what analysis adds, and a status for each.

    Articles of under 100 characters are `skipped` and other than news and opinion pieces `filtered`;
    for these the added columns are null. fallback_type replaces the keyword rule for content types,
    as a model would.
    """
    content = F.col("content")
    kind = text.content_type(F.substring(content, 1, 1000)) if fallback_type is None else fallback_type
    rows = articles.withColumn("content_type", kind)
    status = F.when(F.char_length(strip(content)) < fixed.MIN_ANALYSED, "skipped").when(~F.col("content_type").isin(fixed.KEPT_TYPES), "filtered").otherwise("success")
    rows = rows.withColumn("status", F.coalesce(status, F.lit("skipped")))
    confidence = text.content_confidence(F.col("content_type"))
    reason = F.when(F.col("status") == "skipped", "Content too short for AI analysis").when(
        F.col("status") == "filtered", F.concat(F.lit("Content type: "), F.col("content_type"), F.lit(" (confidence: "), F.format_string("%.2f", confidence), F.lit(")"))
    )
    ok = F.col("status") == "success"
    rows = rows.withColumns({"_lower": F.when(ok, F.lower(content)), "_total": F.when(ok, word_count(content))})
    lower, total = F.col("_lower"), F.col("_total")
    done = rows.withColumns({"reason": reason, "entities": F.when(ok, text.entities(content, lower)), "content_type_confidence": confidence})
    n_locations = F.size("entities.locations")
    added = {
        "summary": text.summary(F.substring(content, 1, 3000)),
        "entities": F.col("entities"),
        "sentiment": text.sentiment(content, lower),
        "importance_score": F.round(text.importance(content, F.col("title"), lower, total), 2),
        "categories": F.array(text.category(text.topic_label(text.topic(urls.part(F.col("url"), "path"))))),
        "content_type_confidence": F.col("content_type_confidence"),
        "language": F.lit("fr"),
        "word_count": total,
        "complexity_score": text.complexity(content, lower),
        "geographic_scope": text.geographic_scope(content, n_locations, lower),
        "extraction_confidence": F.lit(0.8),
    }
    return done.withColumns({name: F.when(ok, value) for name, value in added.items()}).drop("_lower", "_total")


def feed_rows(articles: DataFrame, feed: str, ties: str, size: int = fixed.FEED_SIZE, threshold: float = fixed.FEED_THRESHOLD, best_first: bool = False) -> DataFrame:
    """The articles of each feed with their rank: of those over the threshold the least important, newest first.

    best_first gives the most important ones instead, as the feeds' description says.
    """
    score = F.coalesce("importance_score", F.lit(0.0))
    newest = F.coalesce("ai_processed_at", "extracted_at", F.lit(""))
    # those under the threshold come last in the order: as a filter after the ranks, the threshold leaves scores to be computed once
    order = Window.partitionBy(feed).orderBy(score < threshold, score.desc() if best_first else score.asc(), newest.desc(), F.col(ties).asc())
    return articles.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= size) & (score >= threshold))


def by_category(articles: DataFrame, categories: list[str] = fixed.FEED_CATEGORIES) -> DataFrame:
    """A row for each article and category of its that has a feed; one pass over the articles for all feeds."""
    # the outer form keeps Spark from working out the categories once more to leave out empty ones
    return articles.withColumn("category", F.explode_outer("categories")).where(F.col("category").isin(categories))
