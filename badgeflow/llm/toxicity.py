"""Toxic spans by a linear-chain conditional random field.

Training labels are given for documents, so tokens are labelled first: a word is taken as toxic if toxic
documents hold it significantly more often than others (a likelihood-ratio test; near copies count once).
The field has two states; a token's features are its own, the previous and the next word and its first and
last four bytes, hashed into one weight table; weights and transitions maximise the likelihood of the token
labels (numpy, AdaGrad). The training rows are a bounded sample; the model is a table of fixed size.

Scoring takes whole texts inside Spark tasks. Forward-backward marginals of all tokens are computed exactly;
a document's expected number of toxic tokens and its largest marginal give its score through a logistic
function fitted on the same sample. Runs of tokens with a marginal of one half or more are the spans.

A chain is a document; a slice of documents is one array in which the transition into a document's first
token ignores what came before. The recursions run over equal parts of that array side by side, joined by
the parts' transfer matrices, so a very long text costs as much for a token as a short one.

Defined cases: null and empty texts have no tokens and the score of that; without labels of both kinds the
score is the base rate of the sample (0 without any rows). Repeated rows each keep their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from badgeflow.llm.common import Words, column_type, slices, text_slices, words_of
from badgeflow.llm.labels import MAX_CHARS, MAX_DOCS, fit_logistic, logistic, training_sample

TABLE = 1 << 20
AFFIX = 4
G_TEST = 20.0  # likelihood-ratio statistic that makes a word toxic
MIN_DOCS = 3
EPOCHS, RATE, DECAY = 8, 0.3, 1e-5
#: A small sample is gone through more often, until this many steps or ten times the epochs.
LEAST_STEPS = 160
SIGNATURES = 4  # smallest shingle hashes that two copies may share

# --- features -----------------------------------------------------------------------------


def features(words: Words) -> list[np.ndarray]:
    """Rows of the weight table for each token: word, previous word, next word, beginning, end."""
    start, end = words.start, words.end
    word = words.spans(start, end)
    head = words.spans(start, np.minimum(end, start + AFFIX))
    tail = words.spans(np.maximum(start, end - AFFIX), end)
    first = np.r_[True, words.doc[1:] != words.doc[:-1]] if len(start) else np.zeros(0, bool)
    previous, following = np.zeros_like(word), np.zeros_like(word)
    previous[1:], following[:-1] = word[:-1], word[1:]
    previous[first] = 0
    following[np.r_[first[1:], True] if len(start) else first] = 0
    kinds = [word, previous, following, head, tail]
    return [((h + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int32) for i, h in enumerate(kinds)]


# --- forward and backward -------------------------------------------------------------------


def marginals(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of state 1 at each token.

    emission: the log odds of state 1 by the token's features. transition: 2 x 2 factors. first: tokens that
    begin a chain, each with equal odds from outside.
    """
    return _both_ways(emission, transition, first)[0]


def _both_ways(emission, transition, first):
    """Marginals, and the normalised forward and backward vectors (n, 2)."""
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((0, 2)), np.zeros((0, 2))
    e = np.clip(emission, -30, 30)
    out = np.stack([np.exp(np.minimum(0, -e)), np.exp(np.minimum(0, e))], axis=1)
    # step t: vector(t) = vector(t - 1) @ m[t]; a first token forgets the vector
    m = transition[None, :, :] * out[:, None, :]
    m[first] = out[first][:, None, :] * 0.5
    forward = _scan(m)
    # backwards, with the emission of the token itself left out: beta(t) = m[t + 1] @ beta(t + 1)
    back = np.empty_like(m)
    back[:-1] = m[:0:-1].transpose(0, 2, 1)
    back[-1] = 0.5
    back = np.concatenate([back[-1:], back[:-1]])
    backward = _scan(back)[::-1]
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), forward, backward


def _scan(m: np.ndarray) -> np.ndarray:
    """Normalised running products (1, 1) @ m[0] @ .. @ m[t], over parts of about sqrt(n) steps side by side."""
    n = len(m)
    length = max(1, int(np.sqrt(n)))
    parts = -(-n // length)
    padded = np.empty((parts * length, 2, 2))
    padded[:n], padded[n:] = m, np.eye(2)
    # by step, so that all parts take their step at once
    a, b, c, d = np.ascontiguousarray(padded.reshape(parts, length, 4).transpose(2, 1, 0))
    pa_, pb, pc, pd = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for t in range(1, length):
        pa_, pb, pc, pd = pa_ * a[t] + pb * c[t], pa_ * b[t] + pb * d[t], pc * a[t] + pd * c[t], pc * b[t] + pd * d[t]
        total = pa_ + pb + pc + pd
        pa_, pb, pc, pd = pa_ / total, pb / total, pc / total, pd / total
    x, y = 0.5, 0.5
    into = np.empty((2, parts))
    for p, (qa, qb, qc, qd) in enumerate(zip(pa_.tolist(), pb.tolist(), pc.tolist(), pd.tolist())):
        into[0, p], into[1, p] = x, y
        x, y = x * qa + y * qc, x * qb + y * qd
        total = x + y
        x, y = x / total, y / total
    out = np.empty((length, 2, parts))
    x, y = into
    for t in range(length):
        x, y = x * a[t] + y * c[t], x * b[t] + y * d[t]
        total = x + y
        x, y = x / total, y / total
        out[t, 0], out[t, 1] = x, y
    return out.transpose(2, 0, 1).reshape(-1, 2)[:n]


# --- training -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # log odds of state 1, by feature row
    bias: float
    transition: np.ndarray
    scale: np.ndarray  # of (1, log expected toxic tokens, largest log odds)

    def tokens(self, words: Words) -> np.ndarray:
        emission = np.full(len(words.start), self.bias)
        for rows in features(words):
            emission += self.weights[rows]
        return marginals(emission, self.transition, _first(words))

    def scores(self, words: Words, p: np.ndarray) -> np.ndarray:
        return logistic(_summary(words, p) @ self.scale)


def _first(words: Words) -> np.ndarray:
    return np.r_[True, words.doc[1:] != words.doc[:-1]] if len(words.doc) else np.zeros(0, bool)


def _summary(words: Words, p: np.ndarray) -> np.ndarray:
    n = len(words.counts)
    expected = np.bincount(words.doc, weights=p, minlength=n)
    largest = np.zeros(n)
    np.maximum.at(largest, words.doc, p)
    return np.stack([np.ones(n), np.log(expected + 1e-2), largest], axis=1)


@dataclass(frozen=True)
class Sample:
    """The tokens of the training texts, made slice by slice."""

    word: np.ndarray  # hash of each token
    doc: np.ndarray
    rows: list[np.ndarray]
    first: np.ndarray
    counts: np.ndarray
    signatures: np.ndarray  # smallest shingle hashes of each document


def sample(texts: list[str]) -> Sample:
    parts = []
    for a, b in text_slices(texts):
        words = words_of(texts[a:b])
        hashes, whole = words.grams(5)
        doc = words.doc[: len(hashes)][whole]
        least = np.full((SIGNATURES, b - a), np.uint64(0xFFFFFFFFFFFFFFFF))
        for seed in range(SIGNATURES):
            turned = (hashes[whole] ^ np.uint64(seed * 0x5851F42D4C957F2D % (1 << 64))) * np.uint64(0xD1342543DE82EF95)
            np.minimum.at(least[seed], doc, turned)
        word = words.spans(words.start, words.end)
        parts.append((word, (words.doc + a).astype(np.int32), features(words), _first(words), words.counts, least))
    word, doc, rows, first, counts, least = zip(*parts)
    return Sample(
        np.concatenate(word), np.concatenate(doc), [np.concatenate(r) for r in zip(*rows)], np.concatenate(first),
        np.concatenate(counts), np.concatenate(least, axis=1),
    )


def _distinct_documents(words: Sample) -> np.ndarray:
    """For each document the smallest one that shares one of its smallest shingle hashes."""
    n = len(words.counts)
    label = np.arange(n)
    for least in words.signatures:
        _, group = np.unique(least, return_inverse=True)
        for _ in range(2):
            smallest = np.full(group.max() + 1 if n else 0, n)
            np.minimum.at(smallest, group, label)
            label = np.minimum(label, smallest[group])
            label = label[label]
    return np.where(words.counts >= 5, label, np.arange(n))


def toxic_words(words: Sample, y: np.ndarray) -> np.ndarray:
    """Hashes of words that toxic documents hold significantly more often."""
    label = _distinct_documents(words)
    toxic = np.zeros(len(y), bool)
    np.logical_or.at(toxic, label, y == 1)
    vocabulary, at = np.unique(words.word, return_inverse=True)
    pairs = np.unique(at.astype(np.int64) * len(y) + label[words.doc])
    w, d = pairs // max(1, len(y)), pairs % max(1, len(y))
    kept = np.unique(label)
    n1, n0 = max(1, toxic[kept].sum()), max(1, (~toxic[kept]).sum())
    a = np.bincount(w, weights=toxic[d], minlength=len(vocabulary))
    b = np.bincount(w, weights=~toxic[d], minlength=len(vocabulary))
    share = (a + b) / (n1 + n0)

    def term(k, n):
        rate = k / n
        return k * np.log(np.maximum(rate, 1e-12) / np.maximum(share, 1e-12)) + (n - k) * np.log(
            np.maximum(1 - rate, 1e-12) / np.maximum(1 - share, 1e-12)
        )

    g = 2 * (term(a, n1) + term(b, n0))
    return vocabulary[(g > G_TEST) & (a >= MIN_DOCS) & (a / n1 > 4 * b / n0)]


def train(texts: list[str], y: np.ndarray) -> Model:
    rate = float(y.mean()) if len(y) else 0.0
    if rate in (0.0, 1.0):
        flat = np.array([np.log((rate + 1e-9) / (1 - rate + 1e-9)), 0.0, 0.0])
        return Model(np.zeros(TABLE, np.float32), -5.0, np.ones((2, 2)), flat)
    words = sample(texts)
    target = (np.isin(words.word, toxic_words(words, y)) & (y == 1)[words.doc]).astype(float)
    rows, first = words.rows, words.first
    weights, squares = np.zeros(TABLE), np.full(TABLE, 1e-6)
    bias, trans, trans_squares = -4.0, np.zeros((2, 2)), np.full((2, 2), 1e-6)
    chains = np.array_split(np.arange(len(texts)), max(1, len(texts) // 200))
    begin = np.r_[0, np.cumsum(words.counts)]
    for _ in range(max(EPOCHS, min(10 * EPOCHS, LEAST_STEPS // len(chains)))):
        for docs in chains:
            part = slice(begin[docs[0]], begin[docs[-1] + 1])
            if part.start == part.stop:
                continue
            emission = np.full(part.stop - part.start, bias)
            for r in rows:
                emission += weights[r[part]]
            factors = np.exp(trans - trans.max())
            p, forward, backward = _both_ways(emission, factors, first[part])
            error = target[part] - p
            grad = np.zeros(TABLE)
            for r in rows:
                grad += np.bincount(r[part], weights=error, minlength=TABLE)
            used = grad != 0
            g = grad[used] - DECAY * weights[used]
            squares[used] += g * g
            weights[used] += RATE * g / np.sqrt(squares[used])
            bias += 0.5 * RATE * float(error.mean()) / max(1e-3, float(np.abs(error).mean()))
            trans, trans_squares = _transition_step(
                trans, trans_squares, factors, emission, forward, backward, target[part], first[part]
            )
    model = Model(weights.astype(np.float32), bias, np.exp(trans - trans.max()), np.zeros(3))
    pieces = (words_of(texts[a:b]) for a, b in text_slices(texts))
    summary = np.concatenate([_summary(piece, model.tokens(piece)) for piece in pieces])
    return Model(model.weights, model.bias, model.transition, fit_logistic(summary, y))


def _transition_step(trans, squares, factors, emission, forward, backward, target, first):
    inner = ~first[1:]
    e = np.clip(emission[1:], -30, 30)
    out = np.stack([np.exp(np.minimum(0, -e)), np.exp(np.minimum(0, e))], axis=1)
    pair = forward[:-1, :, None] * factors[None] * (out * backward[1:])[:, None, :]
    pair = pair[inner] / pair[inner].sum(axis=(1, 2), keepdims=True)
    t = target.astype(int)
    seen = np.bincount(2 * t[:-1][inner] + t[1:][inner], minlength=4).reshape(2, 2)
    g = (seen - pair.sum(axis=0)) / max(1, inner.sum())
    squares = squares + g * g
    return trans + 0.1 * g / np.sqrt(squares), squares


# --- scoring --------------------------------------------------------------------------------


def spans_of(words: Words, p: np.ndarray, texts: list[str]) -> list[list[tuple[int, int]]]:
    """For each text the (begin, end) character offsets of runs of toxic tokens."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    base = np.cumsum([0] + [len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
    size = words.end - words.start
    toxic = np.flatnonzero(p >= 0.5)
    docs = words.doc[toxic]
    for d in np.unique(docs).tolist():
        at = toxic[np.searchsorted(docs, d) : np.searchsorted(docs, d, "right")]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
        begin = words.offset[at[first]] - base[d]
        last = at[np.r_[first[1:] - 1, len(at) - 1]]
        end = words.offset[last] + size[last] - base[d]
        if not texts[d].isascii():  # bytes to characters: each has one byte that is no continuation
            raw = np.frombuffer(texts[d].encode("utf-8", "surrogatepass"), np.uint8)
            chars = np.r_[0, np.cumsum(raw & 0xC0 != 0x80)]
            begin, end = chars[begin], chars[end]
        out[d] = list(zip(begin.tolist(), end.tolist()))
    return out


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _scored(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in slices(batches):
            words = words_of(texts)
            p = model.value.tokens(words)
            spans = [[{"begin": a, "end": b} for a, b in s] for s in spans_of(words, p, texts)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(model.value.scores(words, p)), pa.array(spans, _SPANS)],
                names=["doc_id", "score", "spans"],
            )

    return rows


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Model:
    return train(*training_sample(docs, labels, "toxic", max_docs, max_chars))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and spans (character offsets of toxic passages) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size
    return docs.select("doc_id", "text").mapInArrow(
        _scored(shared), f"doc_id {column_type(docs, 'doc_id')}, score double, spans array<struct<begin:int,end:int>>"
    )


def clean_documents(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents with a score below ``least``, as they are, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in slices(batches):
            words = words_of(texts)
            yield piece.filter(pa.array(shared.value.scores(words, shared.value.tokens(words)) < least))

    return docs.mapInArrow(rows, docs.schema)
