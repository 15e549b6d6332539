import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(__file__))

INSIDE = (
    "hash", "score", "pos", "block", "fp", "n_lines", "n_dropped", "kept", "keep", "b", "d", "row", "text_key", "copies", "weight", "copy",
    "r_id", "r_key", "leaked_id", "root", "name", "place", "digest",
)
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    *[T.StructField(name, T.StringType()) for name in INSIDE],
])


@pytest.fixture
def documents(spark):
    """Makes a documents table with clashing extra columns from (doc_id, text[, source]) rows."""

    def make(rows, parts=3):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "a", None, *["x"] * len(INSIDE)) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make
