"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Documents are tokenized where they lie and their ids written once to the shared folder. Ids are counted
over the corpus; the most frequent one becomes rank 0, so most tokens take one byte. A rank takes 1 to 4
bytes in the data stream; its length is 2 bits in a separate control stream, so that a reader finds all
lengths by looking control bytes up in a table of 256 rows, without a branch for each value. Documents
are range-partitioned and sorted by doc_id, coded and written in blocks (a Parquet row each, columns below); the
table of ranks lies beside them. Nothing but the ranks (one for each id of the vocabulary) and the totals of
the partitions is gathered.

    blocks/  shard, first (tokens of the shard before the block), doc_ids, lengths, control, data
    ranks/   id, rank, n

Each document fills up whole control bytes: it is padded to a multiple of four values with rank 0.

Defined cases: a null or empty text has only the end id. Repeated rows are each written; rows of equal doc_id
(null ones come first) are ordered by their ids' bytes. Other columns of the input are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import column_type, remove, slices
from badgeflow.session import work_dir

END_ID = 2
BLOCK_TOKENS = 1 << 16
#: Words that a Python worker keeps: about 60 MB. Most words of a corpus are rare, so a larger cache gains little time
#: and holds memory that the executor shares with its JVM.
CACHED_WORDS = 200_000

#: Lengths of the four values of each control byte.
LENGTHS = np.stack([(np.arange(256) >> (2 * i)) & 3 for i in range(4)], axis=1).astype(np.uint8) + 1
_BYTE = np.arange(4)

# --- the coding ---------------------------------------------------------------------------


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes, padded to a multiple of four values."""
    padded = np.zeros(-(-len(values) // 4) * 4, "<u4")
    padded[: len(values)] = values
    extra = (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    control = (extra.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = padded.view(np.uint8).reshape(-1, 4)[_BYTE <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes) -> np.ndarray:
    """All values, those of the padding included."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    out = np.zeros((len(lengths), 4), np.uint8)
    out[_BYTE < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


# --- tokenizing ---------------------------------------------------------------------------

#: Fixed value: how a vocabulary of word pieces splits text. Between its pieces lies white space, letters never
#: share a piece with signs, and only an apostrophe can tie letters to a sign before them.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, int]:
    """The usual letters for bytes: printable ones stand for themselves, the others for code points from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


class WordCache(dict):
    """Ids (as bytes) of white-space-separated pieces of text, looked up or else tokenized.

    Usable where the tokenizer splits at white space and ignores case (WORD_PATTERN); with any other one,
    and for texts that may hold special tokens, whole texts are encoded. Plain words go to the library's
    model at once, lower-cased, as its other steps leave them as they are. All other pieces go to the library
    in their own case: it composes letters and marks before it lower-cases. The cache is emptied when it is full.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        steps = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_words = kinds == ["NFC", "Replace", "Lowercase"] and splits == [WORD_PATTERN, None]
        self.model, self.letters = self.tokenizer.model, _byte_letters()

    def whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in done]

    def __missing__(self, piece: bytes) -> bytes:
        plain = _PLAIN.fullmatch(piece.decode("utf-8", "replace"))
        if not plain:
            ids = self.whole([piece.decode("utf-8", "replace")])[0]
        elif plain[2]:  # letters, then signs: two pieces for the tokenizer
            ids = self[plain[1].encode()] + self[plain[2].encode()]
        else:
            text = plain[1].lower()
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.letters)
            ids = array(self.dtype.char, [t.id for t in self.model.tokenize(text)]).tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.by_words or "<|" in text:
            return self.whole([text])[0]
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """One for each Python worker, kept between tasks; _tokenized empties its words when a task ends."""
    return WordCache(path)


def _tokenized(path: str, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path)
        end = np.array([end_id], cache.dtype).tobytes()
        try:
            for piece, texts in slices(batches):
                ids = [cache.encode(t) + end for t in texts]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
        finally:
            cache.clear()  # the worker runs later steps too; they get the memory back


    return rows


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids: little-endian numbers of 2 bytes, of 4 if the vocabulary needs them."""
    return docs.select("doc_id", "text").mapInArrow(
        _tokenized(path, end_id), f"doc_id {column_type(docs, 'doc_id')}, ids binary"
    )


def _counted(dtype: np.dtype, size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype)
            counts += np.bincount(ids, minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at])], names=["id", "n"])

    return rows


# --- files --------------------------------------------------------------------------------


def _blocked(dtype: np.dtype, rank_of, id_type: pa.DataType):
    def block(first: int, doc_ids: list, ids: list[bytes]) -> pa.RecordBatch:
        lengths = np.array([len(x) // dtype.itemsize for x in ids], np.int64)
        padded = -(-lengths // 4) * 4
        shift = np.repeat(np.cumsum(padded - lengths) - (padded - lengths), lengths)
        values = np.zeros(padded.sum(), np.uint32)
        values[np.arange(len(shift)) + shift] = rank_of.value[np.frombuffer(b"".join(ids), dtype)]
        control, data = encode(values)
        return pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64()), pa.array([doc_ids], pa.list_(id_type)), pa.array([lengths.tolist()], pa.list_(pa.int64())),
             pa.array([control], pa.binary()), pa.array([data], pa.binary())],
            names=["first", "doc_ids", "lengths", "control", "data"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = size = 0
        doc_ids, ids = [], []
        for batch in batches:
            for doc_id, coded in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                n = len(coded) // dtype.itemsize
                if ids and size + n > BLOCK_TOKENS:
                    yield block(first, doc_ids, ids)
                    first, size, doc_ids, ids = first + size, 0, [], []
                doc_ids.append(doc_id)
                ids.append(coded)
                size += n
        if ids:
            yield block(first, doc_ids, ids)

    return rows


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Tokenizes the documents with the file ``tokenizer`` and writes them below ``path``."""
    spark = docs.sparkSession
    cache = word_cache(tokenizer)
    dtype, size = cache.dtype, cache.tokenizer.get_vocab_size()
    id_type = column_type(docs, "doc_id")
    raw = work_dir(spark, "token-ids")
    tokenized(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(raw)
    ids = spark.read.parquet(raw)

    counts = ids.select("ids").mapInArrow(_counted(dtype, size), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counted = sorted(((r.n, r.id) for r in counts.collect()), key=lambda r: (-r[0], r[1]))  # one row per id of the vocabulary
    spark.createDataFrame([(i, rank, n) for rank, (n, i) in enumerate(counted)], "id bigint, rank bigint, n bigint").coalesce(
        1
    ).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(size, np.uint32)
    rank_of[[i for _, i in counted]] = np.arange(len(counted))

    blocks = (
        ids.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(
            _blocked(dtype, spark.sparkContext.broadcast(rank_of), _arrow_type(docs)),
            f"first bigint, doc_ids array<{id_type}>, lengths array<bigint>, control binary, data binary",
        )
    )
    blocks.select(F.spark_partition_id().alias("shard"), "*").write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    remove(spark, raw)


def _arrow_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)


def _documents(id_of, per_document: Callable[[np.ndarray], int], id_type: pa.DataType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids = id_of.value[decode(b["control"], b["data"])]
                lengths = np.array(b["lengths"], np.int64)
                at = np.cumsum(-(-lengths // 4) * 4) - (-(-lengths // 4) * 4)
                start = b["first"] + np.cumsum(lengths) - lengths
                values = [per_document(ids[a : a + n]) for a, n in zip(at.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["doc_ids"], id_type), pa.array([b["shard"]] * len(lengths), pa.int32()),
                     pa.array(start), pa.array(lengths), pa.array(values, pa.int64())],
                    names=["doc_id", "shard", "start", "n_tokens", "value"],
                )

    return rows


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def read(spark: SparkSession, path: str, per_document: Callable[[np.ndarray], int] = crc32) -> DataFrame:
    """doc_id, start, n_tokens and value (per_document of its ids), decoded from the files."""
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").select("id", "rank").collect()  # one row per id of the vocabulary
    id_of = np.zeros(len(ranks), np.uint32)
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    totals = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    base = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    id_type = blocks.schema["doc_ids"].dataType.elementType
    from pyspark.sql.pandas.types import to_arrow_type

    documents = blocks.mapInArrow(
        _documents(spark.sparkContext.broadcast(id_of), per_document, to_arrow_type(id_type)),
        f"doc_id {id_type.simpleString()}, shard int, start bigint, n_tokens bigint, value bigint",
    )
    return documents.join(base, "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "value")


def written_and_read(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    path = work_dir(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path).withColumnRenamed("value", "ids_crc32")
