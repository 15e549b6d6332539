import math
import os
import random
import sys

import duckdb
import pytest
from texts import ODD, prose

from badgeflow.llm import mixing, queries
from badgeflow.llm.mixing import Target

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))


def corpus(n=300, seed=10):
    rng = random.Random(seed)
    weights = [60, 20, 10, 5, 1]
    return [(d, prose(rng, rng.randrange(1, 60)), f"s{rng.choices(range(5), weights)[0]}") for d in range(n)]


def plan(docs, target):
    return [r.asDict() for r in mixing.mix_plan(docs, target).collect()]


def by_source(rows):
    out = {}
    for r in rows:
        out.setdefault(r["source"], []).append(r)
    return out


def entropy(shares):
    return -sum(p * math.log(p) for p in shares)


def test_every_document_is_used_and_no_source_more_than_the_limit(documents):
    rows = plan(documents(corpus()), Target(max_repeats=3.0))
    assert len(rows) == 300 and min(r["copies"] for r in rows) == 1
    repeats = {s: rs[0]["repeats"] for s, rs in by_source(rows).items()}
    assert max(repeats.values()) == pytest.approx(3.0, abs=1e-4) and min(repeats.values()) == 1.0
    assert max(r["copies"] for r in rows) <= 3
    for rs in by_source(rows).values():
        total, used = sum(r["n_tokens"] for r in rs), sum(r["n_tokens"] * r["copies"] for r in rs)
        assert rs[0]["repeats"] * total - 60 <= used <= rs[0]["repeats"] * total + 1


@pytest.mark.parametrize("part", [0.25, 0.75])
def test_entropy_target_is_met(documents, part):
    docs = documents(corpus())
    tokens = {s: sum(r["n_tokens"] for r in rs) for s, rs in by_source(plan(docs, Target())).items()}
    natural = entropy([t / sum(tokens.values()) for t in tokens.values()])
    goal = natural + part * (math.log(5) - natural)
    weights = {r["source"]: r["weight"] for r in plan(docs, Target(max_repeats=None, entropy=goal))}
    assert entropy(weights.values()) == pytest.approx(goal, abs=1e-4)


def test_budget_is_split_by_weight(documents):
    rows = plan(documents(corpus()), Target(max_repeats=None, budget=5000))
    for rs in by_source(rows).values():
        used = sum(r["n_tokens"] * r["copies"] for r in rs)
        assert 1000 - 60 <= used <= 1000  # five sources alike, whole documents


def test_the_same_seed_gives_the_same_mix_and_another_one_another(documents):
    copies = [sorted((r["doc_id"], r["copies"]) for r in plan(documents(corpus(), parts), Target(seed=seed))) for parts, seed in ((2, 1), (5, 1), (2, 2))]
    assert copies[0] == copies[1] != copies[2]


def test_equals_sql(spark, documents, tmp_path):
    documents(corpus() + [(d, t) for d, t in ODD if d not in (None, 908, 909)]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    from compare import difference

    assert difference(queries.op9_mixing(spark, str(tmp_path)), con, queries.ORACLE_SQL["op9_mixing"]) is None


def test_mixed_rows_keep_their_columns(documents):
    rows = corpus(60) + [(d, t, None) for d, t in ODD]
    docs = documents(rows)
    mixed = mixing.mixed(docs, Target(max_repeats=2.0))
    assert mixed.columns == docs.columns
    found = [(r.doc_id, r.text, r.source) for r in mixed.collect()]
    assert {(d, t, s) for d, t, s in rows} == set(found)
    assert found.count((908, "twin", None)) >= 2


@pytest.mark.parametrize("target", [Target(max_repeats=2.5), Target(budget=9000), Target(entropy=0.9)])
def test_each_pass_is_a_permutation_of_blocks(documents, target):
    docs = documents(corpus())
    plan_of = {r.doc_id: r for r in mixing.mix_plan(docs, target).collect()}
    copies, passes = {}, {}
    for r in mixing.mix_order(docs, target).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        passes.setdefault((r.source, r["pass"]), []).append((r.position, r.doc_id))
    assert copies == {d: r.copies for d, r in plan_of.items() if r.copies}
    orders = {}
    for (source, n), found in passes.items():
        found.sort()
        assert [p for p, _ in found] == list(range(1, len(found) + 1))
        orders.setdefault(source, []).append([d for _, d in found])
        blocks = [plan_of[d].block for _, d in found]
        assert sum(a != b for a, b in zip(blocks, blocks[1:])) == len(set(blocks)) - 1  # each block in one piece
        whole = {d for d, r in plan_of.items() if r.source == source and r.passes > n}
        assert not whole or whole == {d for _, d in found}
    assert any(len(o) > 1 and o[0][: len(o[1])] != o[1] for o in orders.values()) or all(len(o) == 1 for o in orders.values())


def test_empty_tables_and_texts(documents):
    assert plan(documents([]), Target()) == []
    assert [r["copies"] for r in plan(documents([(1, None), (2, "", "b")]), Target())] == [1, 1]


def test_no_python_runs(documents, capsys):
    mixing.mix_plan(documents(corpus(9))).explain()
    plan_text = capsys.readouterr().out
    assert "Python" not in plan_text and "Arrow" not in plan_text and "CartesianProduct" not in plan_text
