"""Language models as a plug: anything with summarize and classify can stand in for the keyword rules of text.py."""

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters a model sees of a text: for its summary and for its type.
SUMMARY_CHARS, TYPE_CHARS = 3000, 500
TYPES = ["news_article", "opinion_article", "shopping_guide", "category_page", "faq_page", "legal_page", "advertisement", "about_page"]
TOPICS = ["economic", "politic", "social", "sport", "tehnologie", "educatie", "sanatate", "cultural", "international"]


class TextModel(Protocol):
    def summarize(self, texts: list[str], max_length: int, min_length: int) -> list[str]: ...

    def classify(self, texts: list[str], labels: list[str]) -> list[tuple[str, float]]: ...


def summary(text: Column, load: Callable[[], TextModel], max_length: int = 100, min_length: int = 30) -> Column:
    """Summaries by a model that each Python worker loads once and calls with whole batches."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model.summarize(batch.fillna("").tolist(), max_length, min_length), dtype=object)

    return run(F.substring(text, 1, SUMMARY_CHARS))


def label(text: Column, load: Callable[[], TextModel], labels: list[str]) -> Column:
    """The likeliest label and its score, as a struct."""

    @F.pandas_udf("label string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            yield pd.DataFrame(model.classify(batch.fillna("").tolist(), labels), columns=["label", "score"])

    return run(text)


def content_type(text: Column, url: Column, load: Callable[[], TextModel]) -> Column:
    about = F.concat(F.lit("This web content from URL "), F.coalesce(url, F.lit("")), F.lit(" appears to be about: "), F.substring(text, 1, TYPE_CHARS))
    return label(about, load, TYPES)


def topic(path: Column, load: Callable[[], TextModel]) -> Column:
    words = F.filter(F.split(F.btrim(path, F.lit("/")), "-"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(r"(?U)^\d+\z")))
    return label(F.lower(F.array_join(words, " ")), load, TOPICS)
