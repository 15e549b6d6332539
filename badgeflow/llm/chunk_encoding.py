"""BPE encoding and decoding that encodes chunks shared by documents once.

Texts are cut where a rolling hash of the last 32 bytes says so, hence at the same places wherever the same passage
stands. Chunks are named by a 128-bit digest; the digests are counted over the corpus, and only chunks that
occur more than once travel:

1. count: digests of all chunks, pre-aggregated in each task; the repeated ones go into a bit table of bounded size
2. scan: a text without repeated chunks is encoded where it lies. Of the others, stretches between repeated chunks are
   encoded in place too; repeated chunks are named, and their text is handed on once by each task
3. encode once: each repeated chunk by one task, whose ids are joined to the places that name it
4. repair: pieces come together by document and place. Ids before a chunk's first and after its last white space
   are not kept: the words at a join are encoded again from both sides' text, and if a chunk has no white space the join
   grows over it into the next one, until white space on both sides makes its ids agree with those of the whole
   text: the tokenizer drops white space and none of its pieces crosses it.

What the bit table passes wrongly is encoded once as well, so the results never depend on it. A tokenizer that is not
known to split at white space gets whole texts. Ids go to a sink, piece by piece: a list of ids, or digests
of the ids and of the decoded text.

Defined cases: a null or empty text has no ids. Repeated rows, and rows without an id, each keep their row. A text of
any length is chunked whole; one without white space is one join. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import column_type, slices, written
from badgeflow.llm.token_files import WordCache, word_cache
from badgeflow.session import work_dir

DIGEST_BYTES = 16
PROBES = 4  # bits of a digest in the table
BITS_A_DIGEST = 16
MAX_TABLE_BITS = 27  # as a power of two: 16 MB
SEGMENT_WORDS = 1 << 13
SEEN = 1 << 20  # digests a task remembers as handed on
STEP_IDS = 1 << 16

_BLANK = b" \t\n\r\x0b\x0c"
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(_BLANK)] = True
#: A number for each byte, for the rolling hash.
_GEAR = np.frombuffer(hashlib.shake_128(b"gear").digest(1024), "<u4")


@dataclass(frozen=True)
class Chunking:
    """Chunks have 2 ** bits bytes more than ``least`` (32 or more) on average, and at most ``most``."""

    bits: int = 9
    least: int = 64
    most: int = 8192

    def marks(self, data: np.ndarray) -> np.ndarray:
        """Places before which a chunk may begin: the hash of the 32 bytes before them has leading zeros, and no
        character is split."""
        h = _GEAR[data]
        for k in (1, 2, 4, 8, 16):  # the sum of the last 32 numbers, each shifted by its distance
            h[k:] += h[:-k] << np.uint32(k)
        at = np.flatnonzero(h >> np.uint32(32 - self.bits) == 0) + 1
        at = at[at < len(data)]
        return at[data[at] & 0xC0 != 0x80]

    def cuts(self, marks: list[int], data: np.ndarray, start: int, end: int) -> list[int]:
        """Start of each chunk of data[start:end], and the end."""
        out, at = [start], start

        def forced(upto: int) -> int:
            nonlocal at
            while upto - at > self.most:
                at += self.most
                while data[at] & 0xC0 == 0x80:
                    at -= 1
                out.append(at)
            return at

        for i in range(bisect_left(marks, start + self.least), bisect_left(marks, end)):
            if marks[i] - forced(marks[i]) >= self.least:
                at = marks[i]
                out.append(at)
        forced(end)
        return [*out, end] if end > start else [start]


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=DIGEST_BYTES).digest()


def _chunked(batches: Iterator[pa.RecordBatch], chunking: Chunking) -> Iterator[tuple]:
    """Slices of the rows with their texts as bytes, and the cuts and digests of each text."""
    for piece, texts in slices(batches):
        encoded = [t.encode("utf-8", "replace") for t in texts]
        joined = b"\0".join(encoded)
        data = np.frombuffer(joined, np.uint8)
        marks = chunking.marks(data).tolist() if len(data) else []
        cuts, digests, start = [], [], 0
        for e in encoded:
            c = chunking.cuts(marks, data, start, start + len(e))
            cuts.append([x - start for x in c])
            digests.append([_digest(joined[a:b]) for a, b in zip(c, c[1:])])
            start += len(e) + 1
        yield piece, encoded, cuts, digests


# --- which chunks are repeated --------------------------------------------------------------


def repeated_chunks(docs: DataFrame, chunking: Chunking) -> DataFrame:
    """digest of the chunks that occur more than once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, digests in _chunked(batches, chunking):
            found = Counter(d for ds in digests for d in ds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["digest", "n"]
            )

    counts = docs.select("text").mapInArrow(rows, "digest binary, n bigint")
    return counts.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest")


def _places(digests: np.ndarray, size: int) -> np.ndarray:
    """The PROBES bits of each digest in a table of ``size`` (a power of two) bits."""
    return digests.view("<u4").reshape(-1, DIGEST_BYTES // 4)[:, :PROBES].astype(np.int64) & (size - 1)


def bit_table(digests: DataFrame) -> np.ndarray:
    """64-bit words of a bit table of the digests; it reaches the driver as segments, 16 MB at most."""
    n = digests.count()
    size = 1 << min(MAX_TABLE_BITS, max(16, (BITS_A_DIGEST * n - 1).bit_length() if n else 0))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8), size).ravel()
            bits = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bits)], names=["word", "bits"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, segment = None, np.zeros(SEGMENT_WORDS, np.int64)

        def taken():
            return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([segment.tobytes()], pa.binary())], names=["segment", "words"])

        for batch in batches:
            which, word, bits = (batch.column(c).to_numpy() for c in ("segment", "word", "bits"))
            for s in np.unique(which):  # they come sorted
                if last is not None and s != last:
                    yield taken()
                    segment[:] = 0
                last = int(s)
                segment[word[which == s] % SEGMENT_WORDS] = bits[which == s]
        if last is not None:
            yield taken()

    merged = digests.mapInArrow(words, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    dealt = merged.select(F.expr(f"word div {SEGMENT_WORDS}").alias("segment"), "word", "bits")
    found = dealt.repartition("segment").sortWithinPartitions("segment").mapInArrow(segments, "segment bigint, words binary")
    table = np.zeros(max(size >> 6, SEGMENT_WORDS), np.int64)
    for r in found.toLocalIterator():
        table[r.segment * SEGMENT_WORDS :][:SEGMENT_WORDS] = np.frombuffer(r.words, np.int64)[: len(table)]
    return table[: size >> 6].view(np.uint64)


def _passing(digests: list[bytes], table: np.ndarray) -> np.ndarray:
    at = _places(np.frombuffer(b"".join(digests), np.uint8), len(table) * 64)
    return ((table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


# --- sinks ----------------------------------------------------------------------------------


class Ids:
    """Little-endian numbers of 4 bytes."""

    schema = (("ids", "binary", pa.binary()),)

    def __init__(self, vocabulary: Vocabulary):
        self.parts: list[bytes] = []

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids.astype("<u4").tobytes())

    def row(self) -> tuple:
        return (b"".join(self.parts),)


class Digests:
    """Number of ids, digest of the ids as little-endian numbers of 4 bytes, digest of the decoded text."""

    schema = (("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string()))

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.n, self.ids, self.text = vocabulary, 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), STEP_IDS):
            few = ids[at : at + STEP_IDS]
            self.ids.update(few.astype("<u4").tobytes())
            if self.n:
                self.text.update(self.vocabulary.between)
            self.text.update(self.vocabulary.decoded(few))
            self.n += len(few)

    def row(self) -> tuple:
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


class Vocabulary:
    """Tokens by id. Without a decoder in its file, a tokenizer's decoded text is its tokens with a space between them."""

    between = b" "

    def __init__(self, cache: WordCache):
        if cache.tokenizer.decoder is not None:
            raise ValueError("only tokenizers without a decoder can be decoded piece by piece")
        self.tokens = [(cache.tokenizer.id_to_token(i) or "").encode() for i in range(cache.tokenizer.get_vocab_size())]

    def decoded(self, ids: np.ndarray) -> bytes:
        return self.between.join(map(self.tokens.__getitem__, ids.tolist()))


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One for each Python worker."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(word_cache(path))
    return _VOCABULARIES[path]


# --- the steps ------------------------------------------------------------------------------

#: Of a stretch of text: the text before its first white space, ids between, and the text after its last white space.
#: Without white space all text is in head, and there are no (null) inner ids.
_PIECE = (("head", "binary", pa.binary()), ("inner", "binary", pa.binary()), ("tail", "binary", pa.binary()))
FINISHED, PIECE, NAMED, TEXT = range(4)


def _piece(cache: WordCache, text: bytes) -> tuple[bytes, bytes | None, bytes | None]:
    blank = np.flatnonzero(_IS_BLANK[np.frombuffer(text, np.uint8)])
    if not len(blank):
        return text, None, None
    a, b = blank[0], blank[-1]
    return text[:a], cache.encode(text[a:b].decode("utf-8", "replace")), text[b + 1 :]


def _batches(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]], size: int = 1000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def taken() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], names=[n for n, _ in fields])

    for row in rows:
        out.append(row)
        if len(out) == size:
            yield taken()
            out = []
    if out:
        yield taken()


def _scan(path: str, chunking: Chunking, table, sink, fields):
    def finished(cache: WordCache, text: bytes) -> tuple:
        s = sink(vocabulary(path) if sink is Digests else None)
        s.add(np.frombuffer(cache.encode(text.decode("utf-8", "replace")), cache.dtype))
        return s.row()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cache, seen = word_cache(path), set()
        number = TaskContext.get().partitionId() << 40
        no_piece, no_result = (None,) * len(_PIECE), (None,) * len(sink.schema)
        for piece, texts, cuts, digests in _chunked(batches, chunking):
            passing = _passing([d for ds in digests for d in ds], table.value) if cache.by_words else np.zeros(sum(map(len, digests)), bool)
            ends = np.cumsum([len(d) for d in digests])
            for doc_id, text, cut, names, end in zip(piece.column("doc_id").to_pylist(), texts, cuts, digests, ends.tolist()):
                number += 1
                named = passing[end - len(names) : end]
                if not named.any():
                    yield (FINISHED, number, doc_id, None, None, *no_piece, None, *finished(cache, text))
                    continue
                own = 0  # where the stretch of chunks that are not repeated began
                for i in np.flatnonzero(named).tolist():
                    if cut[i] > own:
                        yield (PIECE, number, doc_id, 2 * i, None, *_piece(cache, text[own : cut[i]]), None, *no_result)
                    yield (NAMED, number, doc_id, 2 * i + 1, names[i], *no_piece, None, *no_result)
                    own = cut[i + 1]
                    if names[i] not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(names[i])
                        yield (TEXT, None, None, None, names[i], *no_piece, text[cut[i] : own], *no_result)
                if len(text) > own:
                    yield (PIECE, number, doc_id, 2 * len(names), None, *_piece(cache, text[own:]), None, *no_result)

    return lambda batches: _batches(rows(batches), fields)


def _encode_once(path: str):
    """Rows come sorted by digest; each is encoded where it comes first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cache, last = word_cache(path), None
        for batch in batches:
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("chunk").to_pylist()):
                if digest != last:
                    yield (digest, *_piece(cache, text))
                last = digest

    fields = [("digest", pa.binary()), *((n, t) for n, _, t in _PIECE)]
    return lambda batches: _batches(rows(batches), fields)


def _repair(path: str, sink, fields):
    """Pieces come sorted by row and place."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cache = word_cache(path)
        at = doc = into = None
        join: list[bytes] = []

        def closed() -> None:
            text = b"".join(join)
            if text:
                into.add(np.frombuffer(cache.encode(text.decode("utf-8", "replace")), cache.dtype))
            join.clear()

        for batch in batches:
            for number, doc_id, head, inner, tail in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "head", "inner", "tail"))):
                if number != at:
                    if at is not None:
                        closed()
                        yield (doc, *into.row())
                    at, doc, into = number, doc_id, sink(vocabulary(path) if sink is Digests else None)
                join.append(head)
                if inner is not None:
                    closed()
                    into.add(np.frombuffer(inner, cache.dtype))
                    join.append(tail)
        if at is not None:
            closed()
            yield (doc, *into.row())

    return lambda batches: _batches(rows(batches), fields)


def encoded(docs: DataFrame, path: str, sink: type = Ids, chunking: Chunking = Chunking()) -> DataFrame:
    """doc_id and the columns of the sink (Ids: ids; Digests: n_tokens, ids_sha256, decoded_sha256) of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark, id_type = docs.sparkSession, column_type(docs, "doc_id")
    id_field = ("doc_id", id_type, to_arrow_type(docs.schema["doc_id"].dataType))
    table = spark.sparkContext.broadcast(bit_table(written(repeated_chunks(docs, chunking), "repeated-chunks")))
    scanned = (
        ("kind", "int", pa.int32()), ("row", "bigint", pa.int64()), id_field, ("place", "int", pa.int32()), ("digest", "binary", pa.binary()),
        *_PIECE, ("chunk", "binary", pa.binary()), *sink.schema,
    )

    def schema(fields) -> str:
        return ", ".join(f"{n} {t}" for n, t, _ in fields)

    def arrow(fields) -> list[tuple[str, pa.DataType]]:
        return [(n, t) for n, _, t in fields]

    folder = work_dir(spark, "scanned-chunks")
    docs.select("doc_id", "text").mapInArrow(_scan(path, chunking, table, sink, arrow(scanned)), schema(scanned)).write.option(
        "compression", "zstd"
    ).parquet(folder)
    scan = spark.read.schema(schema(scanned)).parquet(folder)
    chunks = (
        scan.where(F.col("kind") == TEXT).select("digest", "chunk").repartition("digest").sortWithinPartitions("digest")
        .mapInArrow(_encode_once(path), f"digest binary, {schema(_PIECE)}")
    )
    names = [n for n, _, _ in _PIECE]
    named = scan.where(F.col("kind") == NAMED).select("row", "doc_id", "place", "digest").join(written(chunks, "chunk-ids"), "digest")
    pieces = scan.where(F.col("kind") == PIECE).select("row", "doc_id", "place", *names).unionByName(named.drop("digest"))
    result = (id_field, *sink.schema)
    repaired = (
        pieces.repartition("row").sortWithinPartitions("row", "place")
        .select("row", "doc_id", *names).mapInArrow(_repair(path, sink, arrow(result)), schema(result))
    )
    return scan.where(F.col("kind") == FINISHED).select(*[n for n, _, _ in result]).unionByName(repaired)


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids (as in the sink Ids); null ids have a null text."""
    id_type = column_type(ids, "doc_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            texts = [None if b is None else known.decoded(np.frombuffer(b, "<u4")).decode() for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(rows, f"doc_id {id_type}, text string")
