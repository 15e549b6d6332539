"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint of 64 bits is 8 bytes at fixed positions. Two fingerprints that differ in at most
``max_bits`` bits differ in at most as many bytes, so they share at least ``8 - max_bits`` of their
(position, byte) entries: the guaranteed minimum. Lists of single entries would hold every 256th
fingerprint, so the index is keyed by the guaranteed minimum itself: a fingerprint is entered under each
choice of ``8 - max_bits`` positions with their bytes. Fingerprints that meet in a list have reached the
count; their shared bytes are tallied and the differing bits verified. A list holds distinct fingerprints
that vary in ``max_bits`` bytes only, so it has a fixed bound (65,536 for two), however many documents
there are; copies are one fingerprint. Within a list only a spanning forest of the verified links is
returned, never all pairs, so that large groups stay linear.

Components are found by alternating large-star and small-star steps over tables in the shared folder.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; repeated rows each
keep their row; a null doc_id takes part but is never a component's id unless all its ids are null. Other
columns of the input are not read. Where one of each group stays, it is the row with the smallest id (null last;
of equal ids the text with the smaller hash), and one of repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import column_type, slices, written

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BLOCK = 1 << 14  # shingles whose bits are counted at once; fingerprints compared at once


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the hashes of the word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) > shingle else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(SEED)), np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[i : i + BLOCK].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in slices(batches):
        hashes = np.array([simhash(t) for t in texts], np.uint64).view(np.int64)
        others = [n for n in piece.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*map(piece.column, others), pa.array(hashes)], names=[*others, "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed number) of every row."""
    return docs.select("doc_id", "text").mapInArrow(_hashed, f"doc_id {column_type(docs, 'doc_id')}, fp bigint")


def _masks(max_bits: int) -> np.ndarray:
    """For each choice of left-out byte positions, the bits of the others."""
    full = (1 << 64) - 1
    return np.array([full ^ sum(0xFF << (8 * p) for p in out) for out in combinations(range(8), max_bits)], np.uint64)


def _linked(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    differing = x ^ y
    shared = sum(((differing >> np.uint64(8 * p)) & np.uint64(0xFF)) == 0 for p in range(8))
    return (shared >= 8 - max_bits) & (np.bitwise_count(differing) <= max_bits)


def _forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Verified links that connect what is connected in a list, by breadth-first search."""
    links, rest = [], members
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            near, at = front[:BLOCK // 64], np.full(len(rest), -1)
            for i in range(0, len(rest), BLOCK):
                ok = _linked(rest[i : i + BLOCK, None], near[None, :], max_bits)
                at[i : i + BLOCK] = np.where(ok.any(axis=1), ok.argmax(axis=1), -1)
            new = at >= 0
            links += zip(near[at[new]].tolist(), rest[new].tolist())
            front, rest = np.concatenate([front[len(near):], rest[new]]), rest[~new]
    return links


def _lists(max_bits: int):
    masks = _masks(max_bits)

    def links(which: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        """which, fps: whole lists, one after the other."""
        if not len(fps):
            return
        key = fps & masks[which]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (which[1:] != which[:-1])])
        size = np.diff(np.r_[first, len(fps)])
        two = first[size == 2]
        x, y = fps[two], fps[two + 1]
        ok = _linked(x, y, max_bits)
        more = [p for a, n in zip(first[size > 2].tolist(), size[size > 2].tolist()) for p in _forest(fps[a : a + n], max_bits)]
        pairs = np.array(more, np.uint64).reshape(-1, 2)
        a, b = (np.concatenate([u, v]).view(np.int64) for u, v in ((x[ok], pairs[:, 0]), (y[ok], pairs[:, 1])))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        which, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            which = np.r_[which, batch.column("which").to_numpy().astype(np.int64)]
            fps = np.r_[fps, batch.column("fp").to_numpy().view(np.uint64)]
            if not len(fps):
                continue
            key = fps & masks[which]
            last = np.flatnonzero((key != key[-1]) | (which != which[-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last list may go on in the next batch
            yield from links(which[:cut], fps[:cut])
            which, fps = which[cut:], fps[cut:]
        yield from links(which, fps)

    return rows


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: links between the distinct values of fp, as many as connect what belongs together."""
    masks = [int(m) for m in _masks(max_bits).view(np.int64)]
    entries = F.array(*[
        F.struct(F.lit(i).cast("tinyint").alias("which"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks)
    ])
    return (
        fps.select("fp", F.inline(entries))
        .repartition("which", "key").sortWithinPartitions("which", "key", "fp")
        .select("which", "fp").mapInArrow(_lists(max_bits), "a bigint, b bigint")
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of the component of each node that has an edge."""
    def star(df: DataFrame) -> DataFrame:
        return written(df.where("u <> v").distinct(), "edges")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = star(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    now, before = state(edges), None
    while now != before:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        # large star: every larger neighbour goes to the smallest one
        edges = star(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        # small star: so do the smaller ones and the node itself
        edges = star(
            edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
        )
        before, now = now, state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def named(hashed: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, root (of its component) and component_id of each distinct fingerprint of rows with doc_id and fp."""
    classes = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = written(components(links(classes.select("fp"), max_bits)), "simhash-roots")
    grouped = classes.join(roots, classes["fp"] == roots["node"])
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = written(grouped.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id"), "simhash-components")
    return written(
        classes.join(moved, "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")),
        "simhash-named",
    )


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links lead to) of every row."""
    hashed = written(fingerprints(docs), "simhash")
    return hashed.join(named(hashed, max_bits), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, as it is. Rows are named by id and text, so none goes for another's sake."""
    text_key = F.xxhash64("text")
    hashed = written(
        docs.select("doc_id", text_key.alias("text_key"), "text")
        .mapInArrow(_hashed, f"doc_id {column_type(docs, 'doc_id')}, text_key bigint, fp bigint"),
        "simhash",
    )
    rows = hashed.join(named(hashed, max_bits).select("fp", "root"), "fp").groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
    rows = rows.withColumn("name", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    rows = written(rows, "simhash-rows")
    kept = written(rows.groupBy("root").agg(F.min("name").alias("kept"), F.count("*").alias("names")).where("names > 1"), "simhash-kept")
    judged = rows.join(kept, "root", "left").withColumn("gone", F.coalesce(F.col("name") != F.col("kept"), F.lit(False)))
    name = [F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key")]
    # written, so that the joins know their sizes
    gone = written(judged.where("gone").select(*name), "simhash-gone")
    repeated = written(judged.where("NOT gone AND n > 1").select(*name), "simhash-repeated")
    d = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    of_row = [F.col("row.doc_id"), F.xxhash64("row.text")]
    same = of_row[0].eqNullSafe(F.col("r_id")) & (of_row[1] == F.col("r_key"))
    single = d.join(gone.unionByName(repeated), same, "left_anti")
    again = d.join(repeated, same, "left_semi").select("row", of_row[0].alias("r_id"), of_row[1].alias("r_key"))
    return single.unionByName(again.dropDuplicates(["r_id", "r_key"]).select("row")).select("row.*")
