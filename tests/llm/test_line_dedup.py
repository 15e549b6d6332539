import random

import pytest
from pyspark.sql import functions as F
from texts import ODD, prose

from badgeflow.llm import line_dedup


def key(line):
    low = line.strip(" \t\n\x0b\x0c\r")
    return low.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def brute(rows, min_docs, keep_first=False):
    holders = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(d)
    gone = {k for k, ds in holders.items() if k and len(ds) >= min_docs}
    first, out = set(), []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            if key(line) not in gone or (keep_first and key(line) not in first):
                kept.append(line)
            first.add(key(line))
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(docs, min_docs, keep_first=False):
    found = line_dedup.without_repeated_lines(docs, min_docs, keep_first)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect()), key=str)


def corpus():
    rng = random.Random(5)
    common = ["Home | About", " home | about\t", "Été ÀB", "\x0bCOOKIES\x0c", "x"]
    rows = []
    for d in range(50):
        lines = [rng.choice([prose(rng, 3, 9), *common, "", "  "]) for _ in range(rng.choice([1, 5, 200]))]
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("min_docs", [2, 10])
def test_equals_brute_force(documents, min_docs):
    rows = [*corpus(), *ODD]
    assert result(documents(rows), min_docs) == brute(rows, min_docs)


def test_keep_first(documents):
    rows = corpus()
    assert result(documents(rows), 2, True) == brute(rows, 2, True)


def test_bitmaps_hold_only_words_that_lose_lines(documents):
    lines = [f"own {i}" for i in range(200)]
    lines[70] = "shared"
    found = line_dedup.keep_bitmaps(documents([(1, "\n".join(lines)), (2, "shared"), (3, "alone")]), 2).collect()
    assert {r.doc_id: (r.n_dropped, {w: b % (1 << 64) for w, b in r.keep.items()}) for r in found} == {
        1: (1, {1: (1 << 64) - 1 - (1 << 6)}), 2: (1, {0: (1 << 64) - 2}),
    }


def test_hashes_are_range_partitioned_and_no_python_runs(documents, capsys):
    line_dedup.line_runs(documents([(1, "a\nb")])).explain()
    plan = capsys.readouterr().out
    assert "rangepartitioning(hash" in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") <= 2  # the test's own repartition, and the range


def test_empty_table(documents):
    assert result(documents([]), 2) == []
    assert documents([]).select(F.lit(1)).count() == 0
