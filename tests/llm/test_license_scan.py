import random

from texts import ODD, prose

from badgeflow.llm import license_scan as ls


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0


def brute(text):
    lines = [ls.normalised(line) for line in (text or "").split("\n")]
    best = {}
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            run = ls.bigrams([w for line in lines[i : j + 1] for w in line])
            for name, template in ls.TEMPLATES:
                score = dice(run, ls.bigrams(ls.normalised(template)))
                if score >= ls.THRESHOLD:
                    best[name] = min(best.get(name, (0, 0, 0)), (-score, j - i, i))
    return {(name, -s, i, i + n) for name, (s, n, i) in best.items()}


def test_equals_brute_force(documents):
    rng = random.Random(11)
    rows = list(ODD)
    for d in range(60):
        lines = [prose(rng, rng.randrange(12)) for _ in range(rng.randrange(5))]
        for _ in range(rng.randrange(3)):
            words = rng.choice(ls.TEMPLATES)[1].split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = "changed"
            if rng.random() < 0.5:
                words.insert(len(words) // 2, "\n")
            lines.insert(rng.randrange(len(lines) + 1), " ".join(words).upper())
        rows.append((d, "\n".join(lines)))
    texts = dict(r for r in rows if r[0] not in (908, 909, 907))
    found = {r.doc_id: r.licenses for r in ls.scan(documents(rows)).collect()}
    assert len(found) == len({d for d, _ in rows})
    for d, text in texts.items():
        assert {(m.license, m.score, m.first_line, m.last_line) for m in found[d]} == brute(text), d
    assert sum(map(len, found.values())) > 30


def brute_window(lines, template, threshold):
    """Runs of words in lines that hold more bigrams than a run of lines may."""
    words = [w for line in lines for w in line]
    line_of = [n for n, line in enumerate(lines) for _ in line]
    most = (2 - threshold) / threshold * len(template) + 1e-9
    best = None
    for i in range(len(words) - 1):
        for j in range(i, len(words) - 1):
            run = ls.bigrams(words[i : j + 2])
            a, b = line_of[i], line_of[j + 1]
            score = 2 * len(run & template) / (max(len(run), len(template)) + len(template))
            ends = (words[i], words[i + 1]) in template and (words[j], words[j + 1]) in template
            if ends and score >= threshold and len(run) <= most and len(ls.bigrams([w for x in lines[a : b + 1] for w in x])) > most:
                best = min(best or (0,), (-score, j - i, i))
    return best and (-best[0], line_of[best[2]], line_of[best[2] + best[1] + 1])


def test_windows_equal_brute_force():
    """The SQL of the query covers runs of lines only; runs of words are compared here."""
    rng = random.Random(13)
    seen = 0
    for _ in range(60):
        name, text = rng.choice(ls.TEMPLATES)
        words = ls.normalised(text)[:40]
        template = ls.bigrams(words)
        spoiled = [w if rng.random() > 0.03 else "other" for w in words]
        flat = [f"x{rng.randrange(9)}" for _ in range(rng.randrange(30))] + spoiled * rng.randrange(1, 3) + [f"y{rng.randrange(9)}" for _ in range(rng.randrange(90))]
        lines, rest = [], flat
        while rest:
            n = rng.choice([0, 3, 200])
            lines, rest = [*lines, rest[:n]], rest[n:]
        got, want = ls.best_window(ls.Grams(lines), template, 0.8), brute_window(lines, template, 0.8)
        assert got == want
        seen += want is not None
    assert seen > 10


def test_blank_and_repeated_lines_cost_little():
    import time

    index = ls.index(ls.TEMPLATES)
    mit = ls.TEMPLATES[6][1]
    for filler in ("\n" * 200_000, "of the software\n" * 100_000, "of the software " * 100_000, "the software and\nto use copies of\n" * 50_000):
        for text in (filler + mit + "\n", mit + "\n" + filler):
            began = time.perf_counter()
            found = ls._matched([text], index)[0]
            assert time.perf_counter() - began < 10
            assert "MIT" in [m["license"] for m in found]
    assert ls._matched(["\n\n\n" + ls.TEMPLATES[4][1] + "\n\n"], index)[0][0]["first_line"] == 3


def test_notices_that_share_their_lines(documents):
    mit = " ".join(dict(ls.TEMPLATES[6:7])["MIT"].split())
    warranty = prose(random.Random(12), 80)
    rows = [
        (1, "This module is by Ann. Licensed under the MIT License. See docs."),
        (2, f"{mit} {warranty}"),
        (3, f"{warranty}\n{warranty} {mit[:200]}\n{mit[200:]} {warranty}\n{warranty}"),
        (4, "see the file licensed under the mit license which is here"),
        (5, f"{warranty} licensed under terms of the mit {warranty}"),
    ]
    found = {r.doc_id: [(m.license, m.score, m.first_line, m.last_line) for m in r.licenses] for r in ls.scan(documents(rows)).collect()}
    assert found[1] == found[4] == [("MIT", 1.0, 0, 0)]
    assert found[2] == [("MIT", 1.0, 0, 0)]
    assert [(name, first, last) for name, _, first, last in found[3]] == [("MIT", 1, 2)] and found[3][0][1] > 0.95
    assert found[5] == []


def test_pruning_loses_nothing():
    index = ls.index(ls.TEMPLATES)
    for t, (name, text) in enumerate(ls.TEMPLATES):
        assert [0, t] in ls.candidates([text], index).tolist()
        assert name in [m["license"] for m in ls._matched(["before\n" + text + "\nafter"], index)[0]]


def test_empty_table_and_no_templates(documents):
    assert ls.scan(documents([])).collect() == []
    assert ls.scan(documents([(1, "MIT License")]), []).first().licenses == []
