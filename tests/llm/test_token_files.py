import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import ODD, prose
from tokenizers import Tokenizer

from badgeflow.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 1 << 17), st.integers(0, (1 << 32) - 1))))
def test_coding_round_trip(values):
    control, data = token_files.encode(np.array(values, np.uint32))
    assert token_files.decode(control, data)[: len(values)].tolist() == values
    assert len(control) == -(-len(values) // 4)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x1ć 'sABab.,<|>")), max_size=40)))
def test_cached_words_give_the_ids_of_whole_texts(texts):
    texts += ["it's THE end... don't!! İstanbul ÀÉß×÷ x\x85y z\xa0w K", "<|endoftext|> a<|endoftext|>b", "é ́a", "x y　z"]
    cache = token_files.word_cache(PATH)
    whole = [e.ids for e in cache.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert cache.by_words
    assert [np.frombuffer(cache.encode(t), cache.dtype).tolist() for t in texts] == whole


def test_plain_words_of_latin_letters():
    rng = random.Random(18)
    letters = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
    texts = ["".join(rng.choices(letters + letters.upper(), k=rng.randrange(1, 12))) + rng.choice(["", ".", ",", "!?", "'", "'s", "-x"]) for _ in range(3000)]
    cache = token_files.WordCache(PATH)
    whole = [e.ids for e in cache.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(cache.encode(t), cache.dtype).tolist() for t in texts] == whole


def test_capitals_whose_mark_only_joins_the_small_letter():
    texts = [f"{a}{c}{mark}{b}" for c, mark in ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"] for a in ("", "x", "AB") for b in ("", "a", "AS is.")]
    texts += [t.lower() for t in texts] + ["A\u030a JA J\u030c THE the The"]
    cache = token_files.WordCache(PATH)
    whole = [e.ids for e in cache.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert cache.by_words
    assert [np.frombuffer(cache.encode(t), cache.dtype).tolist() for t in texts] == whole


def test_another_kind_of_tokenizer_encodes_whole_texts():
    cache = token_files.WordCache(public_tokenizers.path("byte_bpe_50k.json"))
    text = "The cat's  hat. THE"
    assert not cache.by_words
    assert np.frombuffer(cache.encode(text), cache.dtype).tolist() == cache.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 50)
    cache = token_files.WordCache(PATH)
    rng = random.Random(6)
    for _ in range(20):
        texts = [prose(rng, 30) for _ in range(3)]
        whole = [e.ids for e in cache.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(cache.encode(t), cache.dtype).tolist() for t in texts] == whole
        assert len(cache) <= 51


def brute(rows, library):
    coded = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    return {(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in coded}


def test_files_hold_all_documents_in_order(documents, library, monkeypatch):
    rng = random.Random(7)
    rows = [(d, prose(rng, rng.randrange(200))) for d in rng.sample(range(1000, 9000), 80)] + ODD
    found = sorted(token_files.written_and_read(documents(rows), PATH).collect(), key=lambda r: r.start)
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in found} == brute(rows, library)
    assert len(found) == len(rows)
    assert [r.doc_id for r in found] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)]).tolist()[:-1]


def test_frequent_ids_take_one_byte(spark, documents, tmp_path):
    token_files.write(documents([(i, "the cat sat on the mat " * 20) for i in range(9)]), str(tmp_path), PATH)
    blocks = spark.read.parquet(f"{tmp_path}/blocks").collect()
    n = sum(sum(b.lengths) for b in blocks)
    assert sum(len(b.data) for b in blocks) <= n + 3 * 9
    ranks = spark.read.parquet(f"{tmp_path}/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)


def test_empty_table(documents):
    assert token_files.written_and_read(documents([]), PATH).collect() == []


def test_a_task_leaves_no_words_in_the_worker(library):
    import pyarrow as pa

    rng = random.Random(11)
    texts = [prose(rng, 40) for _ in range(30)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    out = list(token_files._tokenized(PATH, token_files.END_ID)([batch]))
    ids = [np.frombuffer(x, token_files.word_cache(PATH).dtype).tolist() for b in out for x in b.column("ids").to_pylist()]
    assert ids == [e.ids + [token_files.END_ID] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert len(token_files.word_cache(PATH)) == 0
    assert token_files.CACHED_WORDS <= 200_000
