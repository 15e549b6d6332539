import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from badgeflow.llm import hard_negatives

EMBEDDINGS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.LongType()),
    # names that the operator uses inside
    T.StructField("anchor_id", T.StringType()), T.StructField("rank", T.StringType()), T.StructField("ids", T.StringType()),
])


def brute(rows, positives=5, negatives=10):
    """rows: (vec_id, label, vector) with whole numbers, one row an id; every hundredth is an anchor."""
    out = []
    for a, la, va in rows:
        if a % 100:
            continue
        score = {r: sum(x * y for x, y in zip(va, v)) for r, _, v in rows}
        label = {r: l for r, l, _ in rows}
        best = sorted((-score[r], r) for r in score if r != a and label[r] == la)[:positives]
        for s, p in best:
            fit = sorted((-score[r], r) for r in score if label[r] != la and 30 * -s <= 100 * score[r] <= 90 * -s)
            out += [(a, p, i + 1, r, -s, -n) for i, (n, r) in enumerate(fit[:negatives])]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], EMBEDDINGS).repartition(3)
    vectors = df.select("*", hard_negatives.quantised(F.col("embedding")).alias("vector"), (F.col("vec_id") % 100 == 0).alias("anchor"))
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(vectors, **options).collect())


def whole(x):
    return max(-hard_negatives.LIMIT, min(hard_negatives.LIMIT, int(256 * x // 1)))


def planted(rng, n, hot=0.5):
    centres = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(3)]
    rows = []
    for i in range(n):
        label = 0 if rng.random() < hot else rng.randrange(1, 4)
        base = centres[rng.randrange(3)]
        rows.append((i, [b + rng.gauss(0, 0.3) for b in base], label))
    return rows


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_equals_brute_force(spark, block_rows):
    rng = random.Random(block_rows)
    rows = planted(rng, 450)
    rows += [(i, rows[i % 9][1], i % 4) for i in range(450, 520)]  # ties
    want = brute([(i, l, [whole(x) for x in v]) for i, v, l in rows])
    assert len(want) > 100
    assert found(spark, rows, block_rows=block_rows, batch_anchors=2) == want
    assert found(spark, rows, positives=2, negatives=3) == brute([(i, l, [whole(x) for x in v]) for i, v, l in rows], 2, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.75], 2), (3, [0.5, 0.5, 9.0], 2), (100, [], 1), (200, [1e300, -1e300], 3), (4, [1e300, 0.0], 3)]
    odd = [
        (5, None, 1), (6, [None, 1.0], 2), (7, [nan, 1.0], 2), (8, [inf, 0.0], 2), (9, [0.6, 0.5], None), (None, [0.6, 0.5], 2),
        (2, [0.75], 2), (3, [9.0, 9.0], 5),  # a repeated row, and one whose id is taken by the first label
    ]
    want = brute([(i, l, [whole(x) for x in v]) for i, v, l in good])
    assert found(spark, good + odd) == want
    assert {a for a, *_ in want} == {0, 100}  # the empty vector scores 0 with every row
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []


def test_scan_leaves_rows_early():
    """Rows that cannot come into the result are not read to the end."""
    rng = random.Random(1)
    rows = [(i, [int(256 * x) for x in v]) for i, v, _ in planted(rng, 2000)]
    block = hard_negatives.Block(
        np.array([i for i, _ in rows]).tobytes(), np.ones(len(rows), np.int64).tobytes(),
        [np.array(c, np.int32).tobytes() for c in zip(*(v for _, v in rows))],
    )
    left = []
    anchor = np.array(rows[0][1])
    block.scan(anchor, np.arange(1, 2000), lambda lower, upper: left.append(len(lower)) or upper >= hard_negatives._kth(lower, 5))
    assert left[0] == 1999 and left[-1] < 1000
