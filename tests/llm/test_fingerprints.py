import hashlib
import random

import pytest
from pyspark.sql import functions as F
from texts import ODD, prose

from badgeflow.llm import fingerprints as fp


def brute_edited(rows):
    """(doc_id, n_chars, edited, next text or None)"""
    texts = {}
    for d, t in rows:
        if d is not None:
            texts[d] = min(texts.get(d, t or ""), t or "")
    ids = sorted(texts)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    out = []
    for d, t in rows:
        t = t or ""
        half = len(t) // 2
        following = texts[after[d]] if d is not None else None
        out.append((d, len(t), t[: len(t) - half] + (following or "")[:half], following))
    return out


@pytest.mark.parametrize("bits", [2, 12])
def test_edited_texts(documents, monkeypatch, bits):
    monkeypatch.setattr(fp, "BLOCK_BITS", bits)
    monkeypatch.setattr(fp, "BLOCK", 1 << bits)
    rng = random.Random(8)
    ids = [*range(-9, 9), *rng.sample(range(10**15), 30), -(10**17)]
    rows = [(d, prose(rng, rng.randrange(60)) + "é漢" * (d % 3)) for d in ids] + ODD
    docs = documents(rows)
    found = fp.edited(docs).select("doc_id", "n_chars", F.sha2("edited", 256).alias("h"), "next_sketch").collect()
    want = brute_edited(rows)
    assert sorted([(r.doc_id, r.n_chars, r.h) for r in found], key=str) == sorted(
        [(d, n, hashlib.sha256(e.encode()).hexdigest()) for d, n, e, _ in want], key=str
    )
    sketches = {r.t: r.s for r in docs.sparkSession.createDataFrame([(n,) for *_, n in want if n is not None], "t string").select("t", fp.sketch(F.col("t")).alias("s")).collect()}
    expected = sorted([(d, sketches.get(n)) for d, *_, n in want], key=str)
    assert sorted([(r.doc_id, r.next_sketch) for r in found], key=str) == expected


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_estimates(spark):
    rng = random.Random(9)
    base = [prose(rng, 1500, 10**6) for _ in range(6)]
    pairs = [(a, a[: len(a) * k // 8] + b[len(b) * k // 8 :]) for a, b in zip(base, base[1:]) for k in range(9)]
    pairs += [("", ""), ("", base[0]), ("a b", "a  b"), (base[0][:200], base[0])]
    table = spark.createDataFrame(pairs, "a string, b string").select("*", fp.sketch(F.col("a")).alias("x"), fp.sketch(F.col("b")).alias("y"))
    rows = table.select(
        "a", "b", "x", "y", fp.resemblance(F.col("x"), F.col("y")).alias("r"), fp.containment(F.col("x"), F.col("y")).alias("c"),
        fp.distinct_shingles(F.col("y")).alias("n"), fp.merged(F.col("x"), F.col("y")).alias("m"),
    ).collect()
    for r in rows:
        a, b = shingles(r.a), shingles(r.b)
        assert abs(r.r - (len(a & b) / len(a | b) if a | b else 1)) < 0.2
        if not a or 2 * len(a) > len(b):  # a far smaller set has too few hashes in common
            assert abs(r.c - (len(a & b) / len(a) if a else 1)) < 0.35
        assert len(r.y) < fp.K and r.n == len(b) or abs(r.n - len(b)) < 0.35 * len(b)
        assert r.m == sorted(set(r.x) | set(r.y))[: fp.K]
    assert [r.r for r in rows if r.a == r.b] == [1.0] * sum(a == b for a, b in pairs)


def test_sketch_is_the_smallest_hashes_and_no_python_runs(spark, documents, capsys):
    df = spark.createDataFrame([("a b c d e f",)], "t string").select(fp.sketch(F.col("t"), k=1).alias("one"), fp.sketch(F.col("t")).alias("all"))
    row = df.first()
    assert row.one == row.all[:1] and row.all == sorted(row.all) and len(row.all) == 2
    fp.edited(documents([(1, "a"), (2, "b")])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table_and_single_document(documents):
    assert fp.edited(documents([])).collect() == []
    assert fp.edited(documents([(1, "abcd")])).first().edited == "abab"
