"""Benchmark decontamination by winnowing.

Of each text, the hashes of all runs of ``K`` words are taken, and from every ``WINDOW`` neighbouring
ones the smallest is kept as a fingerprint. Two texts that share ``K + WINDOW - 1`` words in a row share
all hashes of one such window, hence a fingerprint. Each fingerprint of a document that the benchmark
has too is extended to the windows of which it is the smallest hash, and fingerprint and window are joined
with those of the benchmark: a run that many texts have in other surroundings meets nothing. Items shorter
than a window are one window each, looked up as a whole.

Only fingerprints that pass a bit table of the benchmark's (as large as its fingerprints need, at most 16 MB)
leave the scan of the documents, so what is shuffled follows the suspect passages, not the corpus. The
benchmark holds each window once. Windows of the same items are one class, told by the number and two
digests of its items; documents carry classes, and items are listed once for each set of classes that
occurs, so that a passage of many items is never copied along with its hits.

Defined cases: a null text has no words. Identical rows are judged once; a doc_id (null too) with several
texts gives a row for each. Items without words are ignored; those without an id count as hits, but are in no list
of ids; several rows of one item add up. Other columns of the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import Words, column_type, slices, words_of, written

K, WINDOW = 5, 6
SPAN = K + WINDOW - 1
#: Bits of the table of benchmark fingerprints: so many for each, and at most a power of two, 16 MB.
BITS_EACH, MAX_BITS = 64, 27

_FOUND = "array<struct<hash:bigint,span:int,pos:int,words:string>>"
_FOUND_ARROW = pa.struct([("hash", pa.int64()), ("span", pa.int32()), ("pos", pa.int32()), ("words", pa.string())])
_KEY = ["hash", "span", "words"]


def _minima(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of each run, whether it is within one text, and the smallest of the window from each run on.

    0 marks a window that is not within one text.
    """
    hashes, whole = words.grams(K)
    hashes = hashes | np.uint64(1)
    n = max(0, len(hashes) - WINDOW + 1)
    least = hashes[:n].copy()
    for i in range(1, WINDOW):
        np.minimum(least, hashes[i : n + i], out=least)
    least[words.doc[:n] != words.doc[SPAN - 1 : SPAN - 1 + n]] = 0
    return hashes, whole, least


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the kept runs: smallest of a window, every one of equal smallest."""
    hashes, whole, least = _minima(words)
    n = len(least)
    best = np.zeros(len(hashes), np.uint64)  # the largest of the minima of the windows around a run
    for i in range(WINDOW if n else 0):
        np.maximum(best[i : n + i], least, out=best[i : n + i])
    at = np.flatnonzero((best == hashes) & whole)
    return at, hashes[at]


def found(words: Words, lengths: list[int], known: np.ndarray | None) -> list[tuple]:
    """(text, hash, span, pos, words) of the windows whose fingerprint is known.

    span is the number of words: SPAN, or the length of a short item.
    """
    def passing(h):
        if known is None:
            return np.ones(len(h), bool)
        bit = (h >> np.uint64(1)) & np.uint64(len(known) * 64 - 1)
        return (known[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    first = np.cumsum(words.counts) - words.counts
    least = _minima(words)[2]
    windows = [(SPAN, least, least != 0), *((k, *words.grams(k)) for k in lengths)]
    out = []
    for k, hashes, whole in windows:
        ok = np.flatnonzero(whole & passing(hashes))
        for i, h in zip(ok.tolist(), hashes[ok].view(np.int64).tolist()):
            d = words.doc[i]
            out.append((int(d), h, k, int(i - first[d]), words.text(i, i + k - 1)))
    return out


def _nested(rows: list[tuple], n: int) -> pa.Array:
    """The rows of each of n texts as an array of structs."""
    rows = sorted(rows, key=lambda r: r[0])
    columns = list(zip(*rows)) or [()] * (1 + len(_FOUND_ARROW))
    ends = np.cumsum(np.bincount(np.array(columns[0], np.int64), minlength=n))
    fields = [pa.array(values, field.type) for values, field in zip(columns[1:], _FOUND_ARROW)]
    flat = pa.StructArray.from_arrays(fields, fields=list(_FOUND_ARROW))
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), flat)


def _document_rows(lengths: list[int], known):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in slices(batches):
            words = words_of(texts)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_key"), pa.array(words.counts, pa.int64()),
                 _nested(found(words, lengths, known.value), len(texts))],
                names=["doc_id", "text_key", "n_words", "found"],
            )

    return rows


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in slices(batches):
        words = words_of(texts)
        short = sorted({int(c) for c in words.counts if 0 < c < SPAN})
        rows = [r for r in found(words, short, None) if r[2] in (SPAN, words.counts[r[0]])]
        yield pa.RecordBatch.from_arrays([piece.column("item_id"), _nested(rows, len(texts))], names=["item_id", "found"])


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """hash, span, words, item_id: each window of each item once."""
    return (
        benchmark.select("item_id", "text")
        .mapInArrow(_item_rows, f"item_id {column_type(benchmark, 'item_id')}, found {_FOUND}")
        .select("item_id", F.inline("found"))
        .select("item_id", *_KEY).distinct()
    )


def _classes(links: DataFrame) -> DataFrame:
    """hash, span, words, item_class of each window; the class is null where no item has an id."""
    item = F.col("item_id")
    digests = [F.bit_xor(F.when(item.isNotNull(), F.xxhash64(*salt, item))) for salt in ([], [F.lit("second")])]
    return links.groupBy(*_KEY).agg(F.concat_ws(":", F.nullif(F.count(item), F.lit(0)), *digests).alias("c")).select(
        *_KEY, F.when(F.col("c") != "", F.col("c")).alias("item_class")
    )


def _bit_table(windows: DataFrame) -> np.ndarray:
    """At most 2 ** MAX_BITS / 64 words reach the driver."""
    hashes = windows.select("hash").distinct()
    bits = min(MAX_BITS, max(12, (hashes.count() * BITS_EACH).bit_length()))
    low = F.shiftrightunsigned("hash", 1).bitwiseAND((1 << bits) - 1)
    words = (
        hashes.select(low.alias("low"))
        .select(F.shiftright("low", 6).alias("word"), F.expr("shiftleft(1L, cast(low & 63 AS int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    )
    table = np.zeros(1 << (bits - 6), np.int64)
    for row in words.toLocalIterator():
        table[row.word] = row.bits
    return table.view(np.uint64)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (word ranges a..b of benchmark windows), items (their item ids, ascending)."""
    links = written(benchmark_windows(benchmark), "benchmark-windows")
    windows = written(_classes(links), "benchmark-classes")
    judged = written(_judged(docs, windows), "contamination")
    # the items of a class are those of any of its windows
    one = windows.where("item_class IS NOT NULL").groupBy("item_class").agg(F.min(F.struct(*_KEY)).alias("w"))
    members = one.select("item_class", "w.*").join(links, _KEY).where("item_id IS NOT NULL").select("item_class", "item_id")
    sets = (
        judged.where(F.size("classes") > 0).select("classes").distinct()
        .select("classes", F.explode("classes").alias("item_class")).join(members, "item_class")
        .groupBy("classes").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    sets = written(sets, "contamination-items")  # so that the join knows its size
    none = F.array().cast(f"array<{column_type(benchmark, 'item_id')}>")
    # documents without a class are no group of their own: each has its own part
    part = F.when(F.size("classes") == 0, F.xxhash64("doc_id", "text_key")).otherwise(F.lit(0)).alias("part")
    return (
        judged.select("*", part).join(sets.withColumn("part", F.lit(0).cast("bigint")), ["classes", "part"], "left")
        .select("doc_id", "n_words", "runs", F.coalesce("items", none).alias("items"))
    )


def _judged(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, runs, classes (of the windows that occur, ascending)."""
    lengths = [r.span for r in windows.where(F.col("span") < SPAN).select("span").distinct().collect()]  # 1 to 9
    known = docs.sparkSession.sparkContext.broadcast(_bit_table(windows))
    suspects = (
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
        .mapInArrow(
            _document_rows(sorted(lengths), known),
            f"doc_id {column_type(docs, 'doc_id')}, text_key bigint, n_words bigint, found {_FOUND}",
        )
        .select("doc_id", "text_key", "n_words", F.explode_outer("found").alias("f"))
        # a document without suspects keeps a row, under a key of its own that joins with nothing
        .select(
            "doc_id", "text_key", "n_words", F.col("f.pos"), F.col("f.words"),
            F.coalesce("f.hash", F.xxhash64("doc_id", "text_key")).alias("hash"),
            F.coalesce("f.span", F.lit(-1)).alias("span"),
        )
    )
    run = F.struct(F.col("pos").alias("a"), (F.col("pos") + F.col("span") - 1).alias("b"))
    return (
        suspects.join(windows.withColumn("hit", F.lit(True)), _KEY, "left")
        .groupBy("doc_id", "text_key").agg(
            F.max("n_words").alias("n_words"),
            F.sort_array(F.collect_set(F.when(F.col("hit"), run))).alias("runs"),
            F.sort_array(F.collect_set("item_class")).alias("classes"),
        )
    )


def hit_words(runs: Column) -> Column:
    """Words covered by the sorted ranges, each counted once."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("upto"))

    def add(acc: Column, run: Column) -> Column:
        new = F.greatest(F.lit(0), run["b"] - F.greatest(run["a"] - 1, acc["upto"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["upto"], run["b"]).alias("upto"))

    return F.aggregate(runs, start, add)["n"]


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, as they are. Rows are named by id and text."""
    windows = written(benchmark_windows(benchmark).select(*_KEY).distinct().withColumn("item_class", F.lit(None).cast("string")), "benchmark-windows")
    leaked = _judged(docs, windows).where(F.size("runs") > 0).select(F.col("doc_id").alias("leaked_id"), F.col("text_key").alias("leaked_key"))
    leaked = written(leaked.distinct(), "contaminated")  # so that the join knows its size
    d = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("leaked_id")) & (F.xxhash64("row.text") == F.col("leaked_key"))
    return d.join(leaked, same, "left_anti").select("row.*")
