"""Language identification, decontamination and the corpus pipeline, against plain versions on small tables."""

import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pressmill.llm import decontaminate, language
from pressmill.llm.simhash import _bounds, across_pairs, mixed_members, near_copies
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def held(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_accuracy(spark, medium):
    got = {r.doc_id: r for r in language.op5_language_id(spark, medium).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    assert set(got) == set(docs)
    assert all(r.held_out == (held(i, 4) == 2) and 0 <= r.score <= 1 for i, r in got.items())
    judged = [i for i, r in got.items() if r.held_out and any(c.isalpha() for c in docs[i].text or "")]
    assert sum(got[i].lang_pred == docs[i].lang for i in judged) / len(judged) > 0.97


def phrases(text, corpus):
    """Greedy longest matches; a letter that the corpus lacks begins the phrase that follows it."""
    n, at = 0, 0
    while at < len(text):
        at += text[at] not in corpus
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in corpus:
            size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_against_plain_parsing():
    import numpy as np

    rnd = random.Random(4)
    sample = {k: ["".join(rnd.choices(a, k=300))] for k, a in (("aa", "abcd "), ("bb", "cdef "))}
    model = language._model(tuple((k, tuple(v)) for k, v in sample.items()))
    text = "".join(rnd.choices("abcdef ", k=200))
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    got = language.phrase_bits(data, np.array([0, len(data)]), model)[0]
    for i, (k, v) in enumerate(sample.items()):
        corpus, query = re.sub(" +", " ", v[0]), re.sub(" +", " ", text)
        assert abs(got[i] / model[2][i][1] - phrases(query, corpus)) <= 1


def plain_identification(docs, sample):
    """doc_id -> (language, score), symbol by symbol on strings."""
    bodies = {lang: "\n".join(texts).lower().encode() for lang, texts in sorted(sample.items())}
    seen = {b for body in bodies.values() for b in body if b >= 0x80}

    def symbols(data):
        out = ""
        for b in data:
            c = chr(b) if 0x61 <= b <= 0x7A or b in seen else "?" if b >= 0x80 else " "
            out += c if c != " " or not out.endswith(" ") else ""
        return out

    corpora = {lang: symbols(body) for lang, body in bodies.items()}
    found = {}
    for doc_id, text in docs:
        if not any(c.isalpha() for c in text or ""):
            found[doc_id] = "und", 0.0
            continue
        own, bits = symbols(text.lower().encode()), {}
        for lang, corpus in corpora.items():
            n = 0
            for lo in range(0, len(own), language.PIECE):
                n, match = n + 1, ""
                for c in own[lo : lo + language.PIECE]:
                    if match + c in corpus:
                        match += c
                    else:
                        n, match = n + 1, c if c in corpus else ""
            bits[lang] = n * math.log2(len(corpus))
        best = min(bits, key=lambda k: (bits[k], k))
        found[doc_id] = best, 1 / sum(2 ** -(b - bits[best]) for b in bits.values())
    return found


def test_language_query_against_plain_identification(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    sample = language.labelled_sample(docs.where(language.fold(docs["doc_id"], 4) != 2))
    want = plain_identification([(r.doc_id, r.text) for r in docs.collect()], sample)
    got = {r.doc_id: r for r in language.op5_language_id(spark, small).collect()}
    assert set(got) == set(want) and len({w for w, _ in want.values()}) > 3
    assert all(r.lang_pred == want[i][0] and abs(r.score - want[i][1]) < 1e-9 for i, r in got.items())
    assert all(r.held_out == (held(i, 4) == 2) for i, r in got.items())


def test_language_of_long_texts_only(spark):
    docs = spark.createDataFrame([(1, "kurze wörter hier " * 5000, "de", "a", 0), (2, "short words here", "en", "a", 0)], SCHEMA)
    sample = language.labelled_sample(docs)
    assert set(sample) == {"de", "en"} and len(sample["de"][0].encode()) <= language.LONGEST
    assert [r.lang_pred for r in language.detect_language(docs, sample).collect()] == ["de", "en"]


def test_language_edges(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "123 !?", "en", "a", 0), (4, "words of some text", "en", "a", 0), (5, "ein paar wörter text", "de", "a", 0), (None, "words", None, None, 0), (4, "words of some text", "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x"))
    sample = language.labelled_sample(docs)
    assert set(sample) == {"en", "de"}
    got = language.detect_language(docs, sample).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "en", "de", "en", "en"]
    assert [r.text for r in got] == [r[1] for r in rows]
    assert all(r.lang_pred == "und" and r.score == 0 for r in language.detect_language(docs, {}).collect())
    assert language.labelled_sample(docs.limit(0)) == {} and language.detect_language(docs.limit(0), sample).count() == 0


def distance(item, text):
    before = list(range(len(item) + 1))
    best = before[-1]
    for c in text:
        now = [0]
        for j, x in enumerate(item, 1):
            now.append(min(before[j - 1] + (x != c), before[j] + 1, now[-1] + 1))
        before, best = now, min(best, now[-1])
    return best


def test_edit_matching_against_dynamic_programming():
    rnd = random.Random(1)
    for _ in range(200):
        item = "".join(rnd.choices("abc ", k=rnd.randint(1, 30)))
        text = "".join(rnd.choices("abc ", k=rnd.randint(0, 60)))
        assert decontaminate.best_match(item, text)[0] == distance(item, text)
    items = tuple((i, decontaminate.normal("".join(rnd.choices("abcdefgh ", k=80)))) for i in range(30))
    for number, (_, item) in enumerate(items):
        noisy = list(item)
        for _ in range(rnd.randint(0, 9)):
            noisy[rnd.randrange(len(noisy))] = rnd.choice("xyz")
        text = decontaminate.normal("".join(rnd.choices("abcdefgh ", k=200)) + "".join(noisy) + "".join(rnd.choices("abcdefgh ", k=200)))
        found = {m[0]: m[1] for m in decontaminate.matches(text, items)}
        want = {n: d for n, (_, x) in enumerate(items) if (d := distance(x, text)) <= int(len(x) * decontaminate.ERROR_RATE)}
        assert found == want, number


def distances(items, text):
    """Least edit distance of each item to any substring of the text: the full table, a row per character, all items together."""
    import numpy as np

    width = max(len(i) for i in items)
    letters = np.array([[ord(c) for c in i.ljust(width, "\0")] for i in items])
    ends, steps = np.array([len(i) for i in items]), np.arange(width + 1)
    row = np.tile(steps, (len(items), 1))
    best = ends.copy()
    for c in text:
        new = np.zeros_like(row)
        new[:, 1:] = np.minimum(row[:, :-1] + (letters != ord(c)), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        best = np.minimum(best, row[np.arange(len(items)), ends])
    return best.tolist()


def test_decontamination_query_against_all_distances(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("text is not null").collect()
    items = [(r.item_id, decontaminate.normal(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.op3_decontaminate(spark, small).collect()}
    want = {}
    for d in docs:
        text = decontaminate.normal(d.text)
        for (item_id, item), apart in zip(items, distances([i for _, i in items], text)):
            if len(item) >= decontaminate.MIN_CHARS:
                if apart <= int(len(item) * decontaminate.ERROR_RATE):
                    want[d.doc_id, item_id] = apart
            elif re.search(rf"(?<![^\W_]){re.escape(item)}(?![^\W_])", text):
                want[d.doc_id, item_id] = 0
    assert got == want and len(want) > 2


def test_short_items_at_every_hit():
    items = ((0, "tiny"), (1, "a b"))
    found = lambda text: [m[0] for m in decontaminate.matches(text, items)]
    assert found("destiny and a tiny thing") == [0] and found("tiny") == [0] and found("destiny tinyest") == []
    assert found("ca bc a b") == [1] and found("xa ba bx") == []


def test_decontamination_query_and_edges(spark, small):
    got = {(r.doc_id, r.item_id) for r in decontaminate.op3_decontaminate(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if d.text and decontaminate.normal(i.text) in decontaminate.normal(d.text)}
    assert exact and exact <= got
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "tiny"), (3, "tiny"), (None, "long enough item " * 4)], "item_id long, text string")
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a tiny thing"), (4, "destiny"), (None, "x " * 100_000 + "long enough  item " * 4)], "doc_id long, text string").withColumn("item_id", F.lit(9))
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in decontaminate.contaminated(docs, bench).collect()) == [(0, 0), (3, 3), (3, 3)]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs, bench, block_chars=20).count() == 3


def similar_pairs(texts, size=5, least=0.8):
    sets = []
    for t in texts:
        words = t.lower().encode().split()
        sets.append({tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))})
    return [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]


def test_near_copies_recall(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").where("text is not null and text <> ''")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.component for r in near_copies(docs).collect()}
    ids = sorted(rows)
    groups = brute.classes(len(ids), similar_pairs([rows[i] for i in ids]))
    want = {i: ids[c] for i, c in zip(ids, groups)}
    found = [i for i in ids if want[i] != i and got[i] != i]
    extra = [i for i in ids if want[i] == i and got[i] != i]
    assert len(found) >= 0.95 * sum(want[i] != i for i in ids) and not extra


def recall(spark, texts, **options):
    """Share of the similar pairs that end in one component; no component may join what is not linked."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component for r in near_copies(docs, **options).collect()}
    pairs = similar_pairs(texts)
    label = brute.classes(len(texts), pairs)
    assert all(label[got[i]] == label[i] for i in got)
    return sum(got[i] == got[j] for i, j in pairs) / len(pairs)


def test_near_copies_just_over_the_threshold(spark):
    rnd, texts = random.Random(11), []
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    for i in range(150):
        base = words(120)
        copy = list(base)
        if i % 3 == 0:
            copy += words(28)  # a passage is added
        elif i % 3 == 1:
            at = rnd.randrange(100)
            copy[at : at + 8] = words(8)  # a passage is replaced
        else:
            for at in (30, 75):
                copy[at] = "changed"
        texts += [" ".join(base), " ".join(copy)]
    assert recall(spark, texts) == 1


def test_near_copies_in_a_family_of_one_template(spark):
    # pages of one template are alike in fewer than 0.8 of their shingles; each has one true copy among them
    rnd = random.Random(12)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    template, texts = words(200), []
    for _ in range(150):
        page = f"{template} {words(45)}"
        texts += [page, f"{page} {words(30)}"]
    assert recall(spark, texts) == 1


def test_across_pairs_leave_none_out(spark):
    members = spark.createDataFrame([(k, 40, i) for k in (1, 2) for i in range(40)] + [(3, 2, 0), (3, 2, 5)], "key long, n long, sig long")
    labels = spark.createDataFrame([(i, i % 5) for i in range(30)], "node long, component long")  # the rest are their own
    label = [i % 5 if i < 30 else i for i in range(40)]
    want = {(i, j) for j in range(40) for i in range(j) if label[i] != label[j]}
    mixed = mixed_members(members, labels)
    assert {r.sig for r in mixed.where("key = 3").collect()} == set()
    bounds = spark.createDataFrame([(i, 10, 10) for i in range(40)], "sig long, size long, common long")
    for crowded in (1000, 7):
        rows = across_pairs(mixed, bounds, 1000, crowded, 0.8).collect()
        assert {(r.a, r.b) for r in rows} == want and not any(r.cut for r in rows)
        rows = across_pairs(mixed, bounds, 2, crowded, 0.8).collect()
        assert {(r.a, r.b) for r in rows if r.a != r.b} < want and any(r.cut for r in rows)
    # a text that shares too few shingles with any other is in no pair; one that shares 9 of 10 is in those with texts of up to 10 or so
    tight = spark.createDataFrame([(i, 10, 8 if i == 3 else 9 if i == 4 else 10) for i in range(40)], "sig long, size long, common long")
    assert {(r.a, r.b) for r in across_pairs(mixed, tight, 1000, 7, 0.8).collect()} == {p for p in want if 3 not in p}


def test_bounds(spark):
    import numpy as np

    sets = {1: [1, 2, 3], 2: [3, 4], 3: [9], 4: [], 5: [3, 9, 10, 11]}
    sketches = spark.createDataFrame([(k, np.array(v, dtype=np.uint32).tobytes()) for k, v in sets.items()], "sig long, sketch binary")
    assert {r.sig: (r["size"], r.common) for r in _bounds(sketches).collect()} == {1: (3, 1), 2: (2, 1), 3: (1, 1), 4: (0, 0), 5: (4, 2)}


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, small)
        after.write.parquet(f"file://{folder}/{name}")
        read = spark.read.parquet(f"file://{folder}/{name}")
        out[name] = (docs, read)
        docs = read
    return out


def test_pipeline_stages(spark, small, stages):
    for name, (before, after) in stages.items():
        assert name == "source_mixing" or after.columns == before.columns, name
    texts = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    before, after = (texts(x) for x in stages["language_id"])
    assert after == {i: t for i, t in before.items() if any(c.isalpha() for c in t or "")}
    before, after = (texts(x) for x in stages["line_dedup"])
    assert set(after) == set(before)
    before, after = (texts(x) for x in stages["simhash_near_dedup"])
    ids = sorted(before)
    groups = brute.classes(len(ids), similar_pairs([before[i] for i in ids]))
    assert set(after) == {ids[c] for c in groups}
    before, after = (texts(x) for x in stages["decontamination"])
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert all(not any(item in decontaminate.normal(t) for item in items) for t in after.values())
    mixed = stages["source_mixing"][1]
    assert mixed.where("taken <= 0").count() == 0 and set(texts(mixed)) <= set(after)
    # the mix takes 1.5 times all words within a document per source
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0d]+", r.text)) for r in stages["source_mixing"][0].collect()}
    taken = sum(r.taken for r in mixed.collect())
    assert 0.5 * len(after) < mixed.count() and abs(taken - 1.5 * sum(words.values())) <= 25 * max(words.values())


def test_pipeline_run_and_clashing_columns(spark, small, stages, tmp_path):
    rows = lambda df: sorted((r.doc_id, r.taken) for r in df.collect())
    whole = rows(corpus_pipeline.run(spark, small))
    assert whole and whole == rows(stages["source_mixing"][1])
    docs = spark.createDataFrame([(1, "some words here", "en", "s", 15), (None, None, None, None, None), (1, "some words here", "en", "s", 15)], SCHEMA)
    docs = docs.withColumns({"score": F.lit("x"), "drop": F.lit(1), "_id": F.lit(2), "_row": F.lit(3), "component": F.lit(4), "kept_text": F.lit("k"), "_gone": F.lit(5)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        assert out.count() >= 1


def test_null_and_shared_ids_in_the_pipeline(spark, tmp_path):
    text = lambda k, n=80: " ".join(f"{k}{i}" for i in range(n))
    leak = text("leak", 30)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    bench.write.parquet(f"file://{tmp_path}/benchmark.parquet")
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (None, f"{text('c')} {leak}"), (7, text("d")), (7, text("e")), (7, f"{text('f')} {leak}"), (8, text("a") + " end"), (9, text("e") + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars")
    once = corpus_pipeline.keep_one_of_near_copies(spark, docs, f"file://{tmp_path}")
    key = lambda r: (r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.text) for r in once.collect()), key=key) == sorted((rows[i] for i in (0, 1, 3, 4, 5, 6)), key=key)
    clean = corpus_pipeline.drop_contaminated(spark, once, f"file://{tmp_path}")
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=key) == sorted((rows[i] for i in (0, 1, 4, 5)), key=key)
