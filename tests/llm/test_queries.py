"""The registered queries against SQL on the given tables, and the pipeline against its stages' brute force."""

import os
import sys

import corpus_pipeline
import public_tokenizers
import pytest
from texts import ODD, prose  # noqa: F401
from tokenizers import Tokenizer

from badgeflow.llm import queries

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    from compare import connect, difference

    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE_SQL[name]) is None


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "token_output",
    ]


def test_pipeline(spark, tmp_path):
    from test_decontaminate import brute as leaks
    from test_simhash import brute_components, brute_fingerprint

    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").distinct().collect()}
    docs = {r.doc_id: r for r in queries.table(spark, SF, "documents").collect()}
    rejected = {r.doc_id for r in queries.op6_toxicity(spark, SF).where("score >= 0.5").collect()}
    kept = {d: r.text for d, r in docs.items() if d not in rejected}
    groups = brute_components([(d, brute_fingerprint(t)) for d, t in kept.items()])
    kept = {d: kept[d] for d, _, c in groups if d == c}
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    kept = {d: kept[d] for d, _, n_hit, _ in leaks(list(kept.items()), items) if not n_hit}
    assert rows.keys() == kept.keys()
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    assert all(rows[d].n_tokens == len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept.items())
