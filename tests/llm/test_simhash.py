import random

import numpy as np
import xxhash
from texts import ODD, prose

from badgeflow.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """rows: (doc_id, fingerprint)"""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return sorted(((d, f, least.get(root(f))) for d, f in rows), key=str)


def test_fingerprints_and_components(documents):
    rng = random.Random(3)
    rows = list(ODD)
    for d in range(40):
        text = prose(rng, rng.randrange(1, 80))
        rows.append((d, text))
        for k in range(rng.randrange(4)):
            words = text.split()
            words[rng.randrange(len(words))] = "other"
            rows.append((100 + 10 * d + k, rng.choice([text, " ".join(words).upper()])))
    found = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(documents(rows)).collect()]
    assert sorted(found, key=str) == brute_components([(d, brute_fingerprint(t)) for d, t in rows])
    assert any(d != c for d, _, c in found)


def test_links_connect_chains_and_dense_groups(spark):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(50)}
    at = rng.getrandbits(64)
    for _ in range(60):  # a chain
        at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
        fps.add(at)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a | 1 << b) for a in range(16) for b in range(16)}  # one list
    fps |= {centre ^ 0b111, centre ^ (0b111 << 20), 0, 1, 3, (1 << 64) - 1, (1 << 64) - 2}
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = simhash.links(table)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 2 for r in links.collect())
    roots = {r.node % (1 << 64): r.root for r in simhash.components(links).collect()}
    want = brute_components([(i, f) for i, f in enumerate(sorted(fps))])
    groups = {}
    for _, f, c in want:
        groups.setdefault(c, set()).add(f)
    for members in groups.values():
        assert len(members) == 1 or len({roots[f] for f in members}) == 1
        assert len(members) > 1 or not members & roots.keys()
    assert len(set(roots.values())) == sum(len(g) > 1 for g in groups.values())


def test_a_list_does_not_return_all_pairs():
    members = np.array([(a << 8) | b for a in range(40) for b in range(40)], np.uint64)
    assert len(simhash._forest(members, 2)) == len(members) - 1


def test_one_of_each(documents):
    docs = documents([(5, "one two three four"), (3, "one two three four"), (4, "else here now then"), *ODD])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 3 in ids and 4 in ids and 5 not in ids and None in ids and ids.count(908) == 1 and ids.count(909) == 2
    assert simhash.one_of_each(documents([])).count() == 0


def test_one_of_each_names_rows_by_id_and_text(documents):
    copies, alone = "one two three four five", "else here now then again"
    rows = [(None, copies), (None, copies), (7, copies), (7, copies), (8, copies), (7, alone), (None, "no id at all here"), (None, "no id at all here")]
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(documents(rows)).collect()]
    assert sorted(kept, key=str) == sorted([(7, copies), (7, alone), (None, "no id at all here")], key=str)
