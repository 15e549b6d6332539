"""Quality classifier on supervised subword embeddings.

A document is the sum of three averages of learned vectors: of its words, of its pairs of neighbouring words
(pairs of equal words share one vector) and of the character n-grams of its words, all hashed into one table.
A softmax layer gives the class. Table and layer are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows. Case and signs count, as they tell prose from debris.

Scoring takes whole texts inside Spark tasks. As the layer is linear, each table row is projected on the
difference of the two outputs once; a document's log odds are then three averages of single numbers, summed
over bytes and words by array operations, and memory does not depend on the vocabulary.

Defined cases: null and empty texts have the score of the layer's bias; without labels of both kinds the score
is the base rate of the sample (0 without any rows). Repeated rows each keep their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from badgeflow.llm.common import SPACE, SpanHash, column_type, slices
from badgeflow.llm.labels import MAX_CHARS, MAX_DOCS, logistic, training_sample

TABLE_BITS = 18
DIMENSIONS = 10
GRAMS = (3, 4)
EPOCHS, RATE = 4, 0.5
#: A small sample is gone through more often, until this many steps or ten times the epochs.
LEAST_STEPS = 12_000

#: White space between words.
BLANK_BYTES = np.zeros(256, bool)
BLANK_BYTES[[0x20, *range(0x09, 0x0E)]] = True


def _row(h: np.ndarray, kind: int) -> np.ndarray:
    spread = (h + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Table rows and their text, for words, word pairs and character n-grams."""
    encoded = [b" " + t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    raw = np.frombuffer(b"".join(encoded), np.uint8)
    bounds = np.cumsum([len(e) for e in encoded]) if encoded else np.zeros(0, np.int64)
    blank = BLANK_BYTES[raw]
    kept = ~blank
    kept[1:] |= ~blank[:-1]  # the blank behind a word
    kept[np.r_[0, bounds[:-1]] if len(texts) else bounds] = True  # and the one before a text, so that texts never meet
    data = np.where(blank, np.uint8(SPACE), raw)[kept]
    text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.r_[0, np.cumsum(kept)[bounds - 1]])) if len(texts) else np.zeros(0, np.int32)
    inside = data != SPACE
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    word, owner = SpanHash(data)(start, end), text[start]
    out = [(_row(word, 1), owner)]
    same = owner[1:] == owner[:-1]
    pair = np.where(word[1:] == word[:-1], np.uint64(0), word[1:] * np.uint64(3) + word[:-1])
    out.append((_row(pair, 2)[same], owner[1:][same]))
    rows, of = [], []
    wide = data.astype(np.uint64)
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        gram = wide[:m].copy()
        whole = np.ones(m, bool)
        for i in range(1, n):
            gram = (gram << np.uint64(8)) | wide[i : m + i]
            if i < n - 1:
                whole &= inside[i : m + i]
        rows.append(_row(gram, 2 + n)[whole])
        of.append(text[:m][whole])
    out.append((np.concatenate(rows), np.concatenate(of)) if rows else (np.zeros(0, np.int32), np.zeros(0, np.int32)))
    return out


@dataclass(frozen=True)
class Model:
    values: np.ndarray  # of each table row: its vector times the difference of the outputs
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        odds = np.full(len(texts), self.bias)
        for rows, of in features(texts):
            total = np.bincount(of, weights=self.values[rows], minlength=len(texts))
            odds += total / np.maximum(1, np.bincount(of, minlength=len(texts)))
        return logistic(odds)


def train(texts: list[str], y: np.ndarray, seed: int = 1) -> Model:
    rate = float(y.mean()) if len(y) else 0.0
    if rate in (0.0, 1.0):
        return Model(np.zeros(1 << TABLE_BITS, np.float32), float(np.log((rate + 1e-9) / (1 - rate + 1e-9))))
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << TABLE_BITS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    documents = []
    for text in texts:
        shares = []
        for rows, _ in features([text]):
            at, count = np.unique(rows, return_counts=True)
            shares.append((at, (count / max(1, len(rows))).astype(np.float32)))
        documents.append((np.concatenate([a for a, _ in shares]), np.concatenate([s for _, s in shares])))
    epochs = max(EPOCHS, min(10 * EPOCHS, LEAST_STEPS // len(documents)))
    steps = epochs * len(documents)
    for step, i in enumerate(np.concatenate([random.permutation(len(documents)) for _ in range(epochs)])):
        at, share = documents[i]
        hidden = share @ table[at]
        out = hidden @ layer + bias
        p = np.exp(out - out.max())
        error = p / p.sum()
        error[y[i]] -= 1
        rate_now = RATE * (1 - step / steps)
        grad = layer @ error
        layer -= rate_now * np.outer(hidden, error)
        bias -= rate_now * 0.1 * error
        # a row may be in two averages: repeated rows of the index each count
        np.subtract.at(table, at, rate_now * share[:, None] * grad[None, :])
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _scored(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(model.value.scores(texts))], names=["doc_id", "score"]
            )

    return rows


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Model:
    return train(*training_sample(docs, labels, "quality", max_docs, max_chars))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size
    return docs.select("doc_id", "text").mapInArrow(_scored(shared), f"doc_id {column_type(docs, 'doc_id')}, score double")
