"""Lines that repeat across documents, as keep bitmaps.

Hashes of lines are range-partitioned together with their document, and sorted by hash, document and
position, so a hash that a third of all lines share spans several partitions. Each partition streams its
sorted rows into one row per hash and document with the positions, and one per hash with its number of
documents and its first occurrence; only those partial rows are merged between partitions. What comes back
for a document is a sparse bitmap of 64 lines a word, without words that keep all; the text itself is
joined to it once, where a caller wants the text. All steps are DataFrame functions.

Defined cases: a null or empty text is one empty line, and an empty key is never dropped. Rows of one doc_id
are one document when documents are counted, a null doc_id being one too; each row keeps its own result.
Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import ascii_lower, let, written

#: The white space that is stripped from a line.
BLANKS = " \t\n\x0b\x0c\r"
MIN_DOCS = 10
WORD = 64


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_runs(docs: DataFrame) -> DataFrame:
    """hash, doc_id, at (text_key and position of each such line of the document, ascending)."""
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(lines(F.col("text"))).alias("pos", "line")
    ).select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key"))
    return (
        keyed.where("key <> ''")
        .select(F.unhex(F.md5("key")).alias("hash"), "doc_id", "text_key", "pos")
        .repartitionByRange("hash", "doc_id")
        .sortWithinPartitions("hash", "doc_id", "text_key", "pos")
        .groupBy("hash", "doc_id").agg(F.sort_array(F.collect_set(F.struct("text_key", "pos"))).alias("at"))
    )


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """doc_id, text_key, n_dropped, keep: word number to bits (1: the line stays), for texts that lose lines.

    Lines found in at least min_docs documents go; with keep_first all but the first one, by document
    and position.
    """
    runs = written(line_runs(docs), "line-runs")
    first = F.min(F.struct("doc_id", F.col("at")[0].alias("at"))).alias("first")
    repeated = written(
        runs.groupBy("hash").agg(F.count("*").alias("n_docs"), first).where(F.col("n_docs") >= min_docs), "repeated-lines"
    )
    gone = runs.join(repeated, "hash").select("doc_id", "first", F.explode("at").alias("one"))
    if keep_first:
        gone = gone.where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("one") == F.col("first.at"))))
    bits = gone.select(
        "doc_id", "one.text_key", F.expr(f"one.pos div {WORD}").cast("int").alias("word"),
        F.expr(f"shiftleft(1L, cast(one.pos % {WORD} AS int))").alias("bit"),
    )
    return (
        bits.groupBy("doc_id", "text_key", "word").agg(F.bit_or("bit").alias("bits"))
        .groupBy("doc_id", "text_key")
        .agg(
            F.sum(F.bit_count("bits")).alias("n_dropped"),
            F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits")))).alias("keep"),
        )
    )


def kept_lines(text: Column, keep: Column) -> Column:
    """The text without the lines whose bit is 0."""

    def of(all_lines: Column) -> Column:
        words = F.sequence(F.lit(0), ((F.size(all_lines) - 1) / WORD).cast("int"))

        def of_word(word: Column) -> Column:
            bits = F.coalesce(F.element_at(keep, word), F.lit(-1).cast("bigint"))
            # the sign is the bit of the line
            return F.filter(
                F.slice(all_lines, word * WORD + 1, WORD),
                lambda line, n: F.call_function("shiftleft", bits, F.lit(WORD - 1) - n) < 0,
            )

        return F.array_join(F.flatten(F.transform(words, of_word)), "\n")

    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(let(lines(text), of))


def without_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """The documents with n_lines, n_dropped and kept, the remaining text; these replace columns of the same names."""
    bitmaps = written(keep_bitmaps(docs, min_docs, keep_first), "line-bitmaps")
    others = [F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    rows = docs.select(F.struct(*others).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_key"))
    own = F.struct(
        F.size(lines(F.col("row.text"))).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        kept_lines(F.col("row.text"), F.col("keep")).alias("kept"),
    )
    return rows.join(bitmaps, same, "left").select("row", own.alias("own")).select("row.*", "own.*")
