import random
import re

from texts import ODD, prose

from badgeflow.llm import decontaminate
from badgeflow.llm.decontaminate import SPAN


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(len(w), SPAN)
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = set()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        out.add((doc, len(w), len(hit), tuple(sorted(found - {None}))))
    return out


def result(docs, items):
    rows = decontaminate.contamination(docs, items).select(
        "doc_id", "n_words", decontaminate.hit_words(decontaminate.F.col("runs")).alias("n_hit"), "items"
    ).collect()
    return [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows]


def test_equals_brute_force(spark, documents):
    rng = random.Random(1)
    items = [(i, prose(rng, n, 30)) for i, n in enumerate([40, 25, 10, 11, 9, 5, 1, 12, 40, 30])]
    items += [(10, items[0][1]), (10, "Zweiter Text ÜBER äöü " + items[1][1]), (11, None), (12, ""), (None, prose(rng, 20)), (13, "ab ab " * 12)]
    docs = []
    for d in range(60):
        parts = [prose(rng, rng.randrange(30), 30)]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1)
            parts += [", ".join(w[a : a + rng.randrange(1, 20)]).upper(), prose(rng, rng.randrange(4), 30)]
        docs.append((d, " ".join(parts)))
    docs += [(70, "AB ab--" * 40), (71, items[1][1] + " " + items[0][1]), *ODD]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert set(result(documents(docs), table)) == brute(docs, items)
    assert any(r[2] for r in brute(docs, items))


def test_every_shared_span_of_the_guaranteed_length_has_a_common_fingerprint():
    rng = random.Random(2)
    for _ in range(200):
        shared = prose(rng, SPAN, 5)
        kept = [
            set(decontaminate.fingerprints(decontaminate.words_of([f"{prose(rng, rng.randrange(9), 5)} {shared} {prose(rng, rng.randrange(9), 5)}"]))[1].tolist())
            for _ in range(2)
        ]
        assert kept[0] & kept[1]


def test_passages_of_many_items_and_runs_in_other_surroundings(spark, documents):
    """A passage that a third of all items share, and five words that all items and documents have, each among other words."""
    rng = random.Random(4)
    shared = prose(rng, 25)
    common = "one two three four five"
    around = lambda: f"{prose(rng, 6)} {common} {prose(rng, 6)}"
    items = [(i, f"{around()} {shared if i % 3 == 0 else ''}") for i in range(90)]
    items += [(i, "a third shorter one") for i in range(200, 240)] + [(None, prose(rng, 15))]
    docs = [(d, f"{around()} {shared if d % 3 == 0 else ''} {items[d][1] if d % 7 == 0 else ''}") for d in range(80)]
    docs += [(90, "so a third shorter one is"), (91, items[-1][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert set(result(documents(docs), table)) == brute(docs, items)
    windows = decontaminate.benchmark_windows(table)
    assert windows.count() == windows.distinct().count()
    classes = decontaminate._classes(windows)
    assert classes.count() == windows.select("hash", "span", "words").distinct().count()
    # each window of a document meets one window of the benchmark at most
    assert classes.groupBy("hash", "span", "words").count().where("count > 1").isEmpty()


def test_clean_documents_keeps_columns_and_odd_rows(spark, documents):
    passage = " ".join(f"w{i}" for i in range(10))
    docs = documents([(1, "so " + passage), (2, passage.replace("w5", "x")), *ODD])
    items = spark.createDataFrame([(0, passage)], "item_id long, text string")
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted([2, *(d or -1 for d, _ in ODD)])


def test_rows_are_named_by_id_and_text(spark, documents):
    passage = " ".join(f"w{i}" for i in range(10))
    docs = documents([(None, passage), (None, "clean"), (7, passage), (7, "clean too"), (8, "so " + passage)])
    items = spark.createDataFrame([(None, passage)], "item_id long, text string")
    assert sorted(r.text for r in decontaminate.clean_documents(docs, items).collect()) == ["clean", "clean too"]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(documents([]), none) == []
    assert result(documents([(1, "a b")]), none) == [(1, 2, 0, ())]
