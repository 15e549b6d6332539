"""Hard negatives by a vertical (BOND) scan over integer vectors.

Rows are dealt by id into blocks that hold each dimension as a column with its minimum and maximum. An anchor
reads a block's columns in the order of its own magnitudes, largest first. After every few columns each row's
score lies between its partial sum plus the least and the most that the remaining columns can add; rows that
cannot come into the result any more leave the candidate bitmap, and only the last ones are read to the end:

- positives: a row leaves when its upper bound is below the k-th best lower bound;
- negatives: each positive opens an exact window of scores; a row leaves when it misses all windows, or when
  each window it may reach surely holds enough better rows.

Anchors are a query set: batches of them meet all blocks, one (block, batch) pair after the other, and every pair
yields at most k rows an anchor (or window). The best of these are taken by window ranks, for which Spark keeps
the first k in each task before the shuffle. No block, batch or list depends on how rows are spread over labels.

Defined cases: rows with a null id, label or vector, or with a null in the vector, take no part. An id stands for
one row: of several rows with one id the first by (label, vector) counts. A shorter vector is read as if zeros
followed. Components beyond +-LIMIT count as +-LIMIT. Anchors without positives, and positives without rows in their
window, give no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import written

BLOCK_ROWS = 4096
BATCH_ANCHORS = 256
STEP = 8  # columns between two looks at the bounds
#: Largest magnitude of a component: products and sums of up to 8,192 columns stay exact in 64 bits.
LIMIT = 1 << 24
MAX_TASKS = 10_000  # of a scan; more blocks than that share tasks

_BLOCKS = "ids binary, labels binary, anchors binary, columns array<binary>"
_ANCHORS = "anchor_id bigint, label bigint, vector binary"
_BATCHES = "anchor_ids array<bigint>, anchor_labels array<bigint>, vectors array<binary>, positives array<array<bigint>>, scores array<array<bigint>>"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector is null or has a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(scale * x.cast("double"), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int")

    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, whole))


# --- blocks and batches -------------------------------------------------------------------


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """A row for each vector, zeros after the shorter ones."""
    starts = vectors.offsets.to_numpy()
    size = np.diff(starts)
    out = np.zeros((len(size), size.max(initial=0)), np.int32)
    values = vectors.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]]
    out[np.arange(out.shape[1]) < size[:, None]] = np.clip(values, -LIMIT, LIMIT)
    return out


def _blocked(block_rows: int):
    def block(parts: list[tuple]) -> pa.RecordBatch:
        width = max(m.shape[1] for *_, m in parts)
        ids, labels, anchors = (np.concatenate([p[i] for p in parts]) for i in range(3))
        rows = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for *_, m in parts])
        columns = [c.tobytes() for c in np.ascontiguousarray(rows.T)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()], pa.binary()) for x in (ids, labels, anchors)] + [pa.array([columns], pa.list_(pa.binary()))],
            names=["ids", "labels", "anchors", "columns"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by id; of equal ids the first one counts."""
        parts, held, last = [], 0, None
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            new = np.ones(len(ids), bool)
            new[1:] = ids[1:] != ids[:-1]
            new[:1] = ids[:1] != last if last is not None else True
            last = ids[-1] if len(ids) else last
            labels = batch.column("label").to_numpy()
            anchors = batch.column("anchor").to_numpy(zero_copy_only=False).astype(bool)
            vectors = _matrix(batch.column("vector"))
            at = np.flatnonzero(new)
            while len(at):
                here, at = at[: block_rows - held], at[block_rows - held :]
                parts.append((ids[here], labels[here], anchors[here], vectors[here]))
                held += len(here)
                if held == block_rows:
                    yield block(parts)
                    parts, held = [], 0
        if parts:
            yield block(parts)

    return rows


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rows: vec_id, label, vector (whole numbers), anchor (boolean)."""
    usable = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(
        ~F.exists("vector", lambda x: x.isNull())
    )
    columns = [F.col(c).cast("bigint") for c in ("vec_id", "label")]
    dealt = usable.select(*columns, "vector", F.coalesce("anchor", F.lit(False)).alias("anchor")).repartition("vec_id")
    return dealt.sortWithinPartitions("vec_id", "label", "vector").mapInArrow(_blocked(block_rows), _BLOCKS)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(b["anchors"], bool))
            ids, labels = (np.frombuffer(b[c], np.int64)[at] for c in ("ids", "labels"))
            rows = np.array([np.frombuffer(c, np.int32)[at] for c in b["columns"]], np.int32).reshape(len(b["columns"]), len(at)).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(labels), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["anchor_id", "label", "vector"],
            )


def _batched(size: int):
    longs = pa.list_(pa.int64())
    types = {"anchor_id": longs, "label": longs, "vector": pa.list_(pa.binary()), "positives": pa.list_(longs), "scores": pa.list_(longs)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                few = batch.slice(at, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([few.column(c).to_pylist()], t) for c, t in types.items()],
                    names=["anchor_ids", "anchor_labels", "vectors", "positives", "scores"],
                )

    return rows


# --- the scan -----------------------------------------------------------------------------


class Block:
    def __init__(self, ids: bytes, labels: bytes, columns: list[bytes]):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.columns = np.array([np.frombuffer(c, np.int32) for c in columns], np.int64).reshape(len(columns), len(self.ids))
        self.low, self.high = self.columns.min(axis=1, initial=LIMIT), self.columns.max(axis=1, initial=-LIMIT)

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, alive) -> tuple[np.ndarray, np.ndarray]:
        """Rows that stay and their scores. alive(lower, upper) tells which candidates may still count."""
        n = min(len(anchor), len(self.columns))
        order = np.argsort(-np.abs(anchor[:n]), kind="stable")
        weight = anchor[order].astype(np.int64)
        ends = weight * self.low[order], weight * self.high[order]
        least, most = (np.append(np.cumsum(f(*ends)[::-1])[::-1], 0) for f in (np.minimum, np.maximum))
        partial = np.zeros(len(candidates), np.int64)
        for at in range(0, n, STEP):
            read = order[at : at + STEP]
            partial = partial + weight[at : at + STEP] @ self.columns[read[:, None], candidates[None, :]]
            done = min(at + STEP, n)
            keep = alive(partial + least[done], partial + most[done])
            if not keep.all():
                candidates, partial = candidates[keep], partial[keep]
        return candidates, partial

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best: higher scores first, then smaller ids."""
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]

    def positives(self, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        def alive(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            return upper >= _kth(lower, k)

        return self.best(*self.scan(anchor, np.flatnonzero((self.labels == label) & (self.ids != anchor_id)), alive), k)

    def negatives(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple]:
        """For each window of scores, both ends included, the ids and scores of its k best rows of other labels."""

        def alive(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(lower), bool)
            for low, high in windows:
                may = (upper >= low) & (lower <= high)
                inside = lower[(lower >= low) & (upper <= high)]
                keep |= may & (upper >= _kth(inside, k)) if len(inside) >= k else may
            return keep

        rows, scores = self.scan(anchor, np.flatnonzero(self.labels != label), alive)
        found = []
        for low, high in windows:
            fits = (scores >= low) & (scores <= high)
            found.append(self.best(rows[fits], scores[fits], k))
        return found


def _kth(values: np.ndarray, k: int) -> int:
    """The k-th largest value, or one below all if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else np.iinfo(np.int64).min


def _pairs(batches: Iterator[pa.RecordBatch], of_anchor, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p in batch.to_pylist():
            block, found = Block(p["ids"], p["labels"], p["columns"]), [np.zeros((0, len(names)), np.int64)]
            for one in zip(p["anchor_ids"], p["anchor_labels"], p["vectors"], p["positives"], p["scores"]):
                found += of_anchor(block, one[0], one[1], np.frombuffer(one[2], np.int32).astype(np.int64), one[3], one[4])
            rows = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(rows.T)], names=names)


def _positives(k: int):
    names = ["anchor_id", "positive_id", "positive_score"]

    def of_anchor(block: Block, anchor_id: int, label: int, anchor: np.ndarray, *_) -> list[np.ndarray]:
        ids, scores = block.positives(anchor_id, label, anchor, k)
        return [np.stack([np.full(len(ids), anchor_id), ids, scores], axis=1)]

    return (lambda batches: _pairs(batches, of_anchor, names)), ", ".join(f"{n} bigint" for n in names)


def _negatives(k: int, low: int, high: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def of_anchor(block: Block, anchor_id: int, label: int, anchor: np.ndarray, positives: list, scores: list) -> list[np.ndarray]:
        windows = [(-(-low * s // 100), high * s // 100) for s in scores]
        found = block.negatives(label, anchor, windows, k)
        return [
            np.stack([np.full(len(ids), anchor_id), np.full(len(ids), p), np.full(len(ids), s), ids, negative], axis=1)
            for p, s, (ids, negative) in zip(positives, scores, found)
        ]

    return (lambda batches: _pairs(batches, of_anchor, names)), ", ".join(f"{n} bigint" for n in names)


def hard_negatives(
    rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    block_rows: int = BLOCK_ROWS, batch_anchors: int = BATCH_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, label, vector (whole numbers), anchor (boolean). Of each anchor's best ``positives`` rows of its label,
    the best ``negatives`` rows of other labels whose score is between low and high per cent of the positive's.
    """
    table = written(blocks(rows, block_rows), "vector-blocks")
    n_blocks = table.select("ids").count()
    spread = table.drop("anchors").repartition(max(1, min(n_blocks, MAX_TASKS)))
    anchors = written(table.mapInArrow(_anchors, _ANCHORS), "anchors")

    def scanned(queries: DataFrame, scan) -> DataFrame:
        # the stated query set against all rows, block by block; Spark broadcasts the batches only if it measures them small
        function, schema = scan
        return spread.crossJoin(written(queries.mapInArrow(_batched(batch_anchors), _BATCHES), "anchor-batches")).mapInArrow(function, schema)

    def first(found: DataFrame, keys: list[str], score: str, row_id: str, k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), row_id))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    none = F.array().cast("array<bigint>")
    near = first(
        scanned(anchors.select("*", none.alias("positives"), none.alias("scores")), _positives(positives)),
        ["anchor_id"], "positive_score", "positive_id", positives,
    )
    listed = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("p"))  # at most ``positives`` each
    listed = written(
        listed.select("anchor_id", F.col("p.positive_id").alias("positives"), F.col("p.positive_score").alias("scores")), "anchor-positives"
    )
    found = scanned(anchors.join(listed, "anchor_id").select("anchor_id", "label", "vector", "positives", "scores"), _negatives(negatives, low, high))
    return first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
