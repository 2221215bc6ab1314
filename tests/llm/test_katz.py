"""The backoff model against a plain recursive one, its normalisation, and its gain on held-out text."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressmill.llm import katz
from pressmill.llm.language import fold

SHORT = [(i, " ".join(random.Random(i).choices("a b c d e f g h".split(), weights=range(8, 0, -1), k=i % 23))) for i in range(150)]


def plain(rows, order, held):
    """doc_id -> score, and the probability of a word after a history; all in Python floats."""
    texts = {i: (t or "").split() + ["</s>"] for i, t in rows}
    counts = {n: Counter() for n in range(1, order + 1)}
    for i, words in texts.items():
        if not held(i):
            padded = ["<s>"] * (order - 1) + words
            for at in range(order - 1, len(padded)):
                for n in counts:
                    counts[n][tuple(padded[at - n + 1 : at + 1])] += 1
    spread = {n: Counter(c.values()) for n, c in counts.items()}
    kept = {n: katz.discounts([spread[n][r] for r in range(1, katz.SMALL + 2)]) for n in counts}
    totals = {n: Counter() for n in counts}
    after = {n: {} for n in counts}
    for n, table in counts.items():
        for gram, c in table.items():
            totals[n][gram[:-1]] += c
            after[n].setdefault(gram[:-1], []).append(gram[-1])

    def reduced(n, c):
        return c * kept[n][c - 1] if c <= katz.SMALL else c - katz.TAIL

    def chance(word, history):
        n = len(history) + 1
        c, total = counts[n][(*history, word)], totals[n][history]
        if c:
            return reduced(n, c) / total
        if n == 1:
            return sum(x - reduced(1, x) for x in counts[1].values()) / total
        lower = chance(word, history[1:])
        if not total:
            return lower
        left = sum(counts[n][(*history, w)] - reduced(n, counts[n][(*history, w)]) for w in after[n][history]) / total
        return left / (1 - sum(chance(w, history[1:]) for w in after[n][history])) * lower

    def score(words):
        padded = ["<s>"] * (order - 1) + words
        return sum(math.log10(chance(padded[at], tuple(padded[at - order + 1 : at]))) for at in range(order - 1, len(padded)))

    return {i: score(w) for i, w in texts.items()}, chance, counts[1]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, monkeypatch, order):
    monkeypatch.setattr(katz, "CHUNK", 300)
    rows = [*SHORT, (900, "zz a zz"), (901, None), (903, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in katz.katz_scores(docs, F.col("doc_id") % 4 == 1, order).collect()}
    want, chance, counts = plain(rows, order, lambda i: i % 4 == 1)
    for doc_id, score in want.items():
        assert got[doc_id].score == pytest.approx(score, rel=1e-9)
        assert got[doc_id].held_out == (doc_id % 4 == 1)
    for history in ((), ("a",), ("h",), ("<s>",), ("b", "g"), ("<s>", "c")):
        if len(history) < order:
            assert sum(chance(w, history) for w in [*(w for (w,) in counts), "unknown"]) == pytest.approx(1)


def test_query(spark, small):
    got = katz.op4_katz_scores(spark, small).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = {i: [w.decode() for w in lower(t).encode().split()] for i, t in rows}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    tokens = Counter(w for i in words if not held(i) for w in [*words[i], None])
    n, v = sum(tokens.values()), len(tokens)
    scores, _, _ = plain([(i, " ".join(w)) for i, w in words.items()], katz.ORDER, held)
    for r in got:
        own = [*words[r.doc_id], None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(w in tokens for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
        assert r.score == pytest.approx(scores[r.doc_id], rel=1e-9)


def test_beats_the_base_on_held_out_text(spark, medium):
    r = katz.op4_katz_scores(spark, medium).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] / r[2] > r[1] / r[2] + 0.1


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None), (1, "a b")], "doc_id long, text string")
    rows = katz.katz_scores(docs.withColumn("row", F.lit("x")).withColumn("score", F.lit(1)), fold(docs["doc_id"], 5) == 1).collect()
    assert len(rows) == 4 and all(r.score <= 0 for r in rows)
    alone = katz.katz_scores(docs, F.lit(True)).collect()
    assert [r.n_known for r in alone] == [0] * 4 and all(r.score == 0 and r.train_tokens == 0 for r in alone)
    assert katz.katz_scores(docs.limit(0), F.lit(False)).count() == 0
