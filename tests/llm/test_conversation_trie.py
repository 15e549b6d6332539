import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from badgeflow.llm import conversation_trie

CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    # names that the operator uses inside
    T.StructField("depth", T.StringType()), T.StructField("id", T.StringType()), T.StructField("n_chars", T.StringType()),
    T.StructField("place", T.StringType()), T.StructField("x", T.StringType()),
])


def brute(rows):
    """rows: (conv_id, turn, role, text)"""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, role, text))
    turns = {c: [(r, t) for _, _, r, t in sorted(own[c])] for c in own}
    full = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        full[c] = turns.get(base, [])[:h] + mine[h:]
    nodes = {}
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(nodes, key=len, reverse=True):
        below = [totals[k] for k in children.get(node, [])]
        saved = (len(nodes[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(full[c]) == len(node)))
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(children.get(node, [])), *totals[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "1", "1", "1", "1", "1") for r in rows], CONVERSATIONS).repartition(3)
    return sorted((tuple(r) for r in conversation_trie.conversation_trie(df).collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(201, 215), -5, -105, -100, 1000]:  # 200 is absent
        for turn in range(rng.randrange(1, 8)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice("abc") * rng.randrange(1, 3)))
    for turn in range(70):  # a chain, and one that branches off it late
        rows.append((300, turn, "user", f"t{turn}"))
        rows.append((301, turn, "user", f"t{turn}" if turn < 40 else f"s{turn}"))
    want = brute(rows)
    assert found(spark, rows) == want
    assert max(w[3] for w in want if w[1] == 3) > 5


def test_odd_rows(spark):
    rows = [
        (0, None, "user", "first"), (0, 5, None, "é漢字"), (0, 5, "user", None), (0, 5, "user", None), (0, 2, "", ""),  # ties, repeated rows
        (1, None, None, None), (2, 1, "user", ""), (3, 1, "user", "x" * 200_000), (None, 1, "user", "no id"), (None, None, None, None),
        (99, 1, "only", "turn"), (550, 3, "no", "first of its hundred"), (551, 3, "no", "first of its hundred"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "no id")]) == []


def test_one_conversation_over_many_partitions(spark):
    """A conversation with most turns is numbered and hashed piece by piece."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(7, t % 50 if t % 3 else None, "user", f"t{t % 90}") for t in range(400)] + [(c, 1, "user", "t0") for c in range(8, 30)]
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("shape", ["path", "caterpillar", "binary", "star", "random"])
def test_subtree_totals(spark, shape):
    rng = random.Random(shape)
    n = 100
    parent = {
        "path": lambda i: i - 1, "caterpillar": lambda i: i - 2 if i % 2 == 0 else i - 1, "binary": lambda i: (i - 1) // 2,
        "star": lambda i: 0, "random": lambda i: rng.randrange(max(0, i - 5), i),
    }[shape]
    rows = [(0, None, 1, 5)] + [(i, parent(i), 1, rng.randrange(10)) for i in range(1, n)]
    want = {i: [a, b] for i, _, a, b in rows}
    for i, p, _, _ in reversed(rows):
        if p is not None:
            want[p] = [want[p][0] + want[i][0], want[p][1] + want[i][1]]
    tree = spark.createDataFrame(rows, "id bigint, parent bigint, size bigint, weight bigint")
    got = {r.id: [r["size"], r.weight] for r in conversation_trie.subtree_totals(tree, ["size", "weight"]).collect()}
    assert got == want


def test_ends_of_one_node_come_in_pieces(spark):
    rows = [(1, 2, c) for c in range(500)] + [(1, 3, -4), (-9, 9, 12), (-9, 9, 3)]
    ends = spark.createDataFrame(rows, "x bigint, y bigint, conv_id bigint").selectExpr("struct(x, y) AS id", "conv_id").repartition(4)
    got = {(r.id.x, r.id.y): r.ends_sha256 for r in conversation_trie.end_digests(ends, piece_bytes=20).collect()}
    want = {}
    for x, y, c in rows:
        want.setdefault((x, y), []).append(c)
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
