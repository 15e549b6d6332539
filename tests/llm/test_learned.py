import random
import re
import zlib

import numpy as np
import pytest
from texts import ODD, prose

from badgeflow.llm import labels, quality, queries, toxicity


# --- labelled rows ------------------------------------------------------------------------


def test_sample_takes_no_held_out_rows_and_keeps_its_bounds(spark, documents):
    docs = documents([(d, f"text {d}") for d in range(200)] + [(300, "x" * 500), (301, None), (302, "b"), (302, "a"), (302, "a")])
    marks = spark.createDataFrame(
        [(d, d % 2) for d in range(200)] + [(300, 1), (301, 1), (302, 0), (302, 1), (4, 1), (None, 1), (6, None), (7, 5)],
        "doc_id long, toxic int",
    )
    texts, y = labels.training_sample(docs, marks, "toxic", max_chars=400)
    chosen = {t.split()[-1] for t in texts}
    wanted = {str(d) for d in range(200) if zlib.crc32(str(d).encode()) % 5} | ({"a"} if zlib.crc32(b"302") % 5 else set())
    assert chosen == wanted and len(texts) == len(wanted)
    assert len(labels.training_sample(docs, marks, "toxic", max_docs=20)[0]) <= 20
    assert dict(zip(texts, y)).get("text 4", 1) == 1
    held = docs.select("doc_id", labels.held_out(docs["doc_id"]).alias("h")).collect()
    assert all(r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)


# --- the field ----------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 7, 60])
def test_marginals_equal_enumeration(n):
    rng = np.random.default_rng(n)
    emission, transition = rng.normal(0, 2, n), rng.uniform(0.1, 2, (2, 2))
    first = np.r_[True, rng.random(n - 1) < 0.2]
    got = toxicity.marginals(emission, transition, first)
    begins = np.flatnonzero(first).tolist() + [n]
    for a, b in zip(begins, begins[1:]):
        b = min(b, a + 12) if b - a > 12 else b
        if b - a <= 12 and b in begins:
            total, ones = 0.0, np.zeros(b - a)
            for bits in range(1 << (b - a)):
                s = [(bits >> i) & 1 for i in range(b - a)]
                w = np.exp(sum(e for e, v in zip(emission[a:b], s) if v)) * np.prod([transition[u, v] for u, v in zip(s, s[1:])])
                total, ones = total + w, ones + w * np.array(s)
            assert np.allclose(got[a:b], ones / total)


def test_a_slice_gives_what_its_documents_give_alone():
    rng = random.Random(14)
    texts = [prose(rng, rng.randrange(50)) for _ in range(20)] + ["", "one"]
    model = toxicity.Model(np.random.default_rng(1).normal(0, 1, toxicity.TABLE).astype(np.float32), -0.5, np.array([[1, 0.3], [0.2, 0.9]]), np.ones(3))
    together = toxicity.words_of(texts)
    p = model.tokens(together)
    for d, text in enumerate(texts):
        alone = toxicity.words_of([text])
        assert np.allclose(p[together.doc == d], model.tokens(alone))
        assert np.isclose(model.scores(together, p)[d], model.scores(alone, model.tokens(alone))[0])


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        words = prose(rng, rng.randrange(5, 60), 300).split()
        toxic = rng.random() < 0.2
        for _ in range(rng.randrange(2, 5) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["Nasty", "vile,", "AWFUL", "gruß"]))
        rows.append((d, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows_and_spans(spark, documents):
    rows = toxic_rows(600, 15)
    docs = documents([r[:2] for r in rows] + ODD)
    marks = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    found = toxicity.scores(docs, model).collect()
    assert len(found) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    texts = {d: t for d, t, _ in rows}
    held = [(by_id[d].score >= 0.5) == bool(t) for d, _, t in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean(held) > 0.95
    spans = [texts[d][s.begin : s.end].lower() for d in texts for s in by_id[d].spans]
    assert spans and np.mean([any(w in s for w in ("nasty", "vile", "awful", "gruß")) for s in spans]) > 0.95
    clean = toxicity.clean_documents(docs, model)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(r.doc_id or -1 for r in found if r.score < 0.5)


def test_one_kind_of_label_or_none(spark, documents):
    docs = documents(ODD)
    for marks in ([], [(901, 0), (903, 0)]):
        table = spark.createDataFrame(marks, "doc_id long, toxic int, quality int" if not marks else "doc_id long, toxic int")
        assert all(r.score < 0.5 for r in toxicity.scores(docs, toxicity.fit(docs, table)).collect())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.scores(documents([]), quality.fit(documents([]), none)).collect() == []


# --- subword embeddings ---------------------------------------------------------------------


def brute_score(text, model):
    data = b" " + b"".join(w + b" " for w in (text or "").encode().split())
    words = data.split()
    total = model.bias
    groups = [rows for rows, _ in quality.features([text or ""])]
    grams = [data[i : i + n] for n in quality.GRAMS for i in range(len(data) - n + 1) if b" " not in data[i + 1 : i + n - 1]]
    assert [len(g) for g in groups] == [len(words), max(0, len(words) - 1), len([g for g in grams if words])] or not words
    for g in groups:
        total += model.values[g].sum() / max(1, len(g))
    return 1 / (1 + np.exp(-total))


def test_scores_of_a_slice_equal_those_of_its_texts():
    rng = random.Random(16)
    model = quality.Model(np.random.default_rng(2).normal(0, 3, 1 << quality.TABLE_BITS).astype(np.float32), 0.3)
    texts = [prose(rng, rng.randrange(30)) for _ in range(20)] + [t or "" for d, t in ODD if d != 907]
    assert np.allclose(model.scores(texts), [brute_score(t, model) for t in texts], atol=1e-6)


def test_quality_on_held_out_rows(spark, documents):
    rng = random.Random(17)
    rows = []
    for d in range(400):
        words = prose(rng, rng.randrange(8, 60)).split()
        bad = rng.random() < 0.25
        if bad:
            words = rng.choice([[w.upper() + "!!" for w in words], [w for x in words for w in [x] * 3], [w + " |" for w in words]])
        rows.append((d, " ".join(words), int(not bad)))
    docs = documents([r[:2] for r in rows] + ODD)
    marks = spark.createDataFrame([(d, q) for d, _, q in rows], "doc_id long, quality int")
    found = quality.scores(docs, quality.fit(docs, marks)).collect()
    assert len(found) == len(rows) + len(ODD) and all(0 <= r.score <= 1 for r in found)
    score = {r.doc_id: r.score for r in found}
    held = [(score[d] >= 0.5) == bool(q) for d, _, q in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean(held) > 0.95


def test_registered_queries_on_given_rows(spark):
    sf = "/root/testdata/sf0.01"
    marks = {r.doc_id: r for r in queries.table(spark, sf, "labels").collect()}
    for query, label in ((queries.op6_toxicity, "toxic"), (queries.op10_quality, "quality")):
        rows = query(spark, sf).collect()
        assert len(rows) == 1000
        held = [r for r in rows if r.held_out and r.doc_id in marks]
        assert np.mean([r.predicted == marks[r.doc_id][label] for r in held]) > 0.93


def test_spans_of_long_texts_beyond_ascii():
    import time

    from badgeflow.llm.common import words_of

    texts = ["a bad bad é word", "", "漢字 bad ß bad", "é bad " * 50_000, "bad"]
    words = words_of(texts)
    p = np.array([1.0 if words.text(i, i) == "bad" else 0.0 for i in range(len(words.start))])
    began = time.perf_counter()
    spans = toxicity.spans_of(words, p, texts)
    assert time.perf_counter() - began < 5
    for text, found in zip(texts, spans):
        assert [text[a:b] for a, b in found] == [m.group() for m in re.finditer(r"\bbad(?: bad)*\b", text)]
