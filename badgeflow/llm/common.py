"""What several operators share: tables in the shared folder, bounded slices of batches, words as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from badgeflow.session import work_dir

#: Characters of text that one step of an array computation takes; a longer text is a step of its own.
SLICE_CHARS = 1 << 20

#: Fixed values of the word rule: after lower-casing A-Z, digits, a-z and everything beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True
SPACE = 0x20
#: The same for words as they stand between white space, signs included.
SPACED_BYTES = np.ones(256, bool)
SPACED_BYTES[list(b" \t\n\r\x0b\x0c")] = False

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; pure ASCII takes the faster function with the same result."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of work_dir, through the file system that Spark wrote it to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, also where use has it in a lambda or several times."""
    return F.transform(F.array(value), use)[0]


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def text_slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about SLICE_CHARS together."""
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > SLICE_CHARS:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Pieces of the batches with about SLICE_CHARS of text each, null texts as empty ones."""
    for batch in batches:
        texts = [t or "" for t in batch.column(text).to_pylist()]
        for a, b in text_slices(texts):
            yield batch.slice(a, b - a), texts[a:b]


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept for slices of usual size."""
    usual = 2 * SLICE_CHARS
    if n <= usual and base in _POWERS:
        return _POWERS[base][:n]
    factors = np.full(max(n, usual), base, np.uint64)
    factors[0] = 1
    np.cumprod(factors, out=factors)
    if n <= usual:
        _POWERS[base] = factors
    return factors[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a polynomial hash, whose low bits are weak, over all 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class SpanHash:
    """Hashes of any spans of a byte array, each in constant time, from one running sum."""

    def __init__(self, data: np.ndarray):
        inverse = pow(_BASE, -1, 1 << 64)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=self.sums[1:])
        self.back = powers(len(data) + 1, inverse)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


@dataclass(frozen=True)
class Words:
    """The words of several texts: ``data`` holds each word followed by one space."""

    data: np.ndarray
    start: np.ndarray  # in data, of each word
    end: np.ndarray
    doc: np.ndarray  # the text of each word
    counts: np.ndarray  # words of each text
    offset: np.ndarray  # first byte of each word in the texts joined by one byte

    @cached_property
    def spans(self) -> SpanHash:
        return SpanHash(self.data)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the k words from each word on, and whether they are in one text."""
        n = len(self.start) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        return self.spans(self.start[:n], self.end[k - 1 :]), self.doc[:n] == self.doc[k - 1 :]

    def text(self, first: int, last: int) -> str:
        """Words first to last, joined by spaces."""
        return self.data[self.start[first] : self.end[last]].tobytes().decode("utf-8", "replace")


def words_of(texts: list[str], word_bytes: np.ndarray = WORD_BYTES) -> Words:
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(encoded).lower() + b"\n", np.uint8)
    inside = word_bytes[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    offset = np.flatnonzero(inside & ~before)
    kept = inside | before
    data = np.where(inside, raw, np.uint8(SPACE))[kept]
    end = np.flatnonzero(data == SPACE)
    start = np.zeros(len(end), np.int64)
    start[1:] = end[:-1] + 1
    bounds = np.cumsum([len(e) + 1 for e in encoded]) if encoded else np.zeros(0, np.int64)
    doc = np.searchsorted(bounds, offset, side="right")
    return Words(data, start, end, doc, np.bincount(doc, minlength=len(texts)), offset)
