import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from texts import ODD, prose
from tokenizers import Tokenizer

from badgeflow.llm import chunk_encoding, queries
from badgeflow.llm.chunk_encoding import Chunking, Digests

PATH = public_tokenizers.path(queries.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
SMALL = Chunking(bits=5, least=32, most=100)


def brute(rows):
    out = []
    for d, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        whole = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        out.append((d, len(ids), whole, hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, path=PATH, **options):
    return sorted((tuple(r) for r in chunk_encoding.encoded(docs, path, Digests, **options).collect()), key=str)


def shared_texts(rng):
    """Copies, near copies, passages in many texts, passages that begin or end within a word, odd characters."""
    odd = ["İSTANBUL", "J̌", "ß́", "漢字かな", "éé", "don't", "I'll", "x'", "''s", "12345", "!?!?", "<|endoftext|>", "<|start",
           "oftext|>", " ", " ", "\x1c", "\x85", "ﬁ", "Å", "👩‍👩", "Σίσυφος ΣΑΣ"]
    passages = [" ".join(rng.choice([prose(rng, 3), rng.choice(odd)]) for _ in range(40)) for _ in range(4)]
    passages += ["x" * 700, "ab́漢" * 150, "\n" * 300]
    rows = []
    for d in range(60):
        parts = [rng.choice([rng.choice(passages), prose(rng, rng.randrange(1, 40)), rng.choice(odd)]) for _ in range(rng.randrange(1, 6))]
        rows.append((d, rng.choice(["", " ", "\n", "q"]).join(parts)))
    return rows + [(100 + d, t) for d, t in rows[::3]] + [(200 + d, t + " more") for d, t in rows[::4]]


@pytest.mark.parametrize("chunking", [SMALL, Chunking()])
def test_equals_library(documents, chunking):
    rows = [*ODD, *shared_texts(random.Random(5))]
    assert found(documents(rows), chunking=chunking) == brute(rows)


def test_empty_table(documents):
    assert found(documents([])) == []


def test_repeated_chunks_are_encoded_once(documents, spark):
    rng = random.Random(6)
    passage = prose(rng, 400)
    rows = [(d, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for d in range(20)]
    repeated = {bytes(r.digest) for r in chunk_encoding.repeated_chunks(documents(rows), SMALL).collect()}
    data = np.frombuffer(passage.encode(), np.uint8)
    cuts = SMALL.cuts(SMALL.marks(data).tolist(), data, 0, len(data))
    inner = [chunk_encoding._digest(passage.encode()[a:b]) for a, b in zip(cuts[3:-2], cuts[4:-1])]
    assert len(inner) > 10 and len(repeated & set(inner)) >= len(inner) - 2  # the cuts find their way back within a few chunks
    table = chunk_encoding.bit_table(spark.createDataFrame([(d,) for d in sorted(repeated)], "digest binary"))
    assert chunk_encoding._passing(sorted(repeated), table).all()
    others = [chunk_encoding._digest(str(i).encode()) for i in range(1000)]
    assert chunk_encoding._passing(others, table).sum() < 20


def test_a_full_bit_table_changes_nothing(documents, monkeypatch):
    rows = shared_texts(random.Random(7))
    monkeypatch.setattr(chunk_encoding, "bit_table", lambda digests: np.full(1024, (1 << 64) - 1, np.uint64))
    assert found(documents(rows), chunking=SMALL) == brute(rows)


def test_ids_and_decoded_text(documents):
    rows = [*ODD, *shared_texts(random.Random(8))]
    ids = chunk_encoding.encoded(documents(rows), PATH, chunking=SMALL)
    want = [(d, LIBRARY.encode(t or "", add_special_tokens=False).ids) for d, t in rows]
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in ids.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    texts = [(r.doc_id, r.text) for r in chunk_encoding.decoded(ids, PATH).collect()]
    assert sorted(texts, key=str) == sorted(((d, LIBRARY.decode(i, skip_special_tokens=False)) for d, i in want), key=str)


def test_other_tokenizers_get_whole_texts(documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = shared_texts(random.Random(9))[:20]
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in chunk_encoding.encoded(documents(rows), path, chunking=SMALL).collect()}
    assert got == {d: library.encode(t, add_special_tokens=False).ids for d, t in rows}


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op13_chunk_encoding(spark, "/root/testdata/sf0.01").collect()), key=str) == brute(rows)
