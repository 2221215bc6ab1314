"""Collocations against a plain version, SQL, and each step's own invariants."""

import random
import re
from collections import Counter

import numpy as np

from pressmill.llm import collocations, queries
from tests.oracle import agree


def plain(rows, longest=3, least=10, contained=50, most=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score) for (lang, text)."""
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", low):
            ws = re.findall("[^ \t]+", piece)
            words[lang] += len(ws)
            own.update(tuple(ws[i : i + k]) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        often = [p for p, a in f.items() if len(p) > 1 and a >= least]
        longer = {}
        for p in often:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer.get(p[i : i + k], 0), f[p])
        found = []
        for p in often:
            if 100 * longer.get(p, 0) >= contained * f[p]:
                continue
            score, k = min((1000000 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, lp, rp, words[lang], -s) for i, (s, a, p, lp, rp) in enumerate(sorted(found)[:most])]
    return sorted(out)


def ours(spark, rows, **how):
    table = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(tuple(r) for r in collocations.collocations(table, **how).collect())


def invented(seed, n=300):
    draw = random.Random(seed)
    words = ["a", "b", "New", "york", "Ünï", "ß", "x\x01", "x", "tail-word", " ", "9"]
    seps = [" ", " ", " ", "\t ", ". ", ",", "\n", "\r\n", "!", " \x0b"]
    texts = ["".join(draw.choice(words) + draw.choice(seps) for _ in range(draw.randint(0, 60))) for _ in range(n)]
    return [(draw.choice(["en", "de", None, "und"]), t) for t in texts] + [("en", None), ("fr", ""), (None, " .. "), ("es", "only once here")]


def test_sql(spark, medium):
    agree(spark, medium, queries.QUERIES["op12_collocations"], queries.SQL["op12_collocations"])


def test_plain(spark):
    rows = invented(1)
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, rows, least=3, contained=90, most=17) == plain(rows, least=3, contained=90, most=17)
    assert ours(spark, rows, longest=2) == plain(rows, longest=2)


def test_small_chunks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(collocations.frequent_phrases, "__defaults__", (3, 10, 500, 200))
    rows = invented(2) + [("en", "long text with many words in one piece " * 200), ("en", "one two. " * 300)]
    assert ours(spark, rows) == plain(rows)


def test_one_phrase_in_a_third_of_the_rows(spark):
    rows = invented(3, 100) + [("en", "the same old words again")] * 60
    assert ours(spark, rows) == plain(rows)


def test_empty_and_other_columns(spark):
    assert ours(spark, []) == []
    table = spark.createDataFrame([("en", "to be. " * 12, 1, "x")], "lang string, text string, word int, ids string")
    assert [tuple(r) for r in collocations.collocations(table).collect()] == [("en", 1, "to be", 12, 12, 12, 24, 1000000)]


def test_keys_keep_the_order_of_ids():
    ids = np.random.default_rng(2).integers(0, 1 << 48, (500, 3))
    ids[::7] = ids[3]
    keys = collocations.packed(ids)
    assert (collocations.unpacked(keys, 3) == ids).all()
    assert (ids[collocations.radix_order(keys)] == ids[np.lexsort(ids.T[::-1])]).all()


def test_portions_join_to_the_text():
    text = b"word " * 50 + b". " + b"x" * 300 + b"\n" + b"tail, end"
    parts = list(collocations._portions(text, 40))
    assert b"".join(parts) == text and all(p[-1:] in b".,;:!?\n" for p in parts[:-1])
