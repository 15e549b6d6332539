"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the ``K`` smallest distinct hashes of a text's shingles of five words, ascending. Sketches of
parts merge into the sketch of the whole, and two of them estimate resemblance, containment and the number
of distinct shingles. Everything is a column expression.

``edited`` pairs each document with the one that follows it by id. Ids are integers, so blocks of ``BLOCK``
neighbouring ones hold at most that many, however they are spread; the successor is found within the block,
and across blocks by the same step on block numbers. A document's text is shuffled once, and of its
successor's only what takes part.

Defined cases: fewer than five words are one shingle, no words none; two empty sketches resemble each other
fully. A null text is empty. Rows of one doc_id share a successor; if that has several texts, the first in
sort order is taken. Without a doc_id there is no successor: the cut text stays cut, and near_next is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import let, written

SHINGLE = 5
K = 128
BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
#: The white space between words, as a pattern.
BLANKS = r"[\x20\x09-\x0D]+"

# --- sketches -------------------------------------------------------------------------------


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    def smallest(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (shingle - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, shingle)))
        return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)

    def of(stripped: Column) -> Column:
        # each word is hashed once; a shingle's hash is that of its words' hashes
        words = F.transform(F.split(stripped, BLANKS), lambda w: F.xxhash64(w))
        return F.when(stripped == "", F.array().cast("array<bigint>")).otherwise(let(words, smallest))

    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")), of)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together (shingles across their border are not in either)."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common among all distinct shingles, 0 to 1."""

    def share(together: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(together, a), b))
        return F.when(F.size(together) == 0, F.lit(1.0)).otherwise(common / F.size(together))

    return let(merged(a, b, k), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Exact below k, else estimated from the k-th smallest hash."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's distinct shingles that b has too, 0 to 1."""
    r = resemblance(a, b, k)
    common = r / (1 + r) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


# --- successors -----------------------------------------------------------------------------


def successors(ids: DataFrame) -> DataFrame:
    """id and next, the next larger id (null after the largest), of a table of distinct integers."""
    if ids.count() <= BLOCK:
        return ids.select("id", F.lead("id").over(Window.orderBy("id")).alias("next"))
    blocked = ids.select("id", F.shiftright(F.col("id").cast("bigint"), BLOCK_BITS).alias("block"))
    firsts = written(blocked.groupBy("block").agg(F.min("id").alias("first")), "id-blocks")
    following = (
        successors(firsts.select(F.col("block").alias("id")))
        .join(firsts.select(F.col("block").alias("next"), "first"), "next")
        .select(F.col("id").alias("block"), F.col("first").alias("of_next_block"))
    )
    within = F.lead("id").over(Window.partitionBy("block").orderBy("id"))
    return (
        blocked.withColumn("next", within).join(following, "block", "left")
        .select("id", F.coalesce("next", "of_next_block").alias("next"))
    )


def neighbours(docs: DataFrame) -> tuple[DataFrame, bool]:
    """id, previous and longest (characters of the previous one), ids in a circle; whether an id repeats."""
    ids = written(
        docs.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.length("text")).alias("longest"), F.count("*").alias("n")),
        "document-ids",
    )
    extent = ids.agg(F.min("id").alias("first"), F.max("n").alias("n")).first()
    pairs = successors(ids.select("id")).withColumn("next", F.coalesce("next", F.lit(extent["first"])))
    links = pairs.join(ids.select("id", "longest"), "id").select(F.col("next").alias("id"), F.col("id").alias("previous"), "longest")
    return written(links, "document-links"), (extent["n"] or 0) > 1


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (text), and the sketches of text, edited text and the next document's text.

    The edited text has its last floor(n_chars / 2) code points replaced by as many first ones of the next
    document, ascending doc_id in a circle.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = rows.where("doc_id IS NOT NULL")  # as both joins have it, so that they share its shuffle
    links, repeated = neighbours(own)
    source = own.groupBy("doc_id").agg(F.min("text").alias("text")) if repeated else own
    heads = source.join(links, source["doc_id"] == links["id"]).select(
        F.col("previous").alias("doc_id"),
        F.substring("text", F.lit(1), F.expr("longest div 2").cast("int")).alias("head"),
        sketch(F.col("text")).alias("next_sketch"),
    )
    without = rows.where("doc_id IS NULL").withColumns({
        "head": F.lit(""), "next_sketch": F.lit(None).cast("array<bigint>"),
    })
    half = F.expr("length(text) div 2").cast("int")
    joined = own.join(heads, "doc_id").unionByName(without).select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - half), F.substring("head", F.lit(1), half)
        ).alias("edited"),
        sketch(F.col("text")).alias("sketch"),
        "next_sketch",
    )
    return joined.withColumn("edited_sketch", sketch(F.col("edited")))
