"""One registered query for each operator, over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from badgeflow.llm import (
    chunk_encoding, conversation_trie, decontaminate, fingerprints, hard_negatives, license_scan, line_dedup, mixing, quality, simhash,
    token_files, toxicity, url_filter,
)
from badgeflow.llm.labels import held_out

#: The vocabulary file of the token queries.
TOKENIZER = "word_bpe_49k.json"
#: How often the mix may use a document of the rarest source.
MAX_REPEATS = 2.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex64(number: Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def id_digest(ids: Column) -> Column:
    """sha256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(ids, lambda i: i.cast("string"))), ","), 256)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words(F.col("runs"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        id_digest(F.col("items")).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    best = F.get("licenses", F.lit(0))
    return found.select(
        "doc_id", F.size("licenses").alias("n_licenses"), best["license"].alias("license"), best["score"].alias("score"),
        best["first_line"].alias("first_line"), best["last_line"].alias("last_line"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document of the same number: bad if its quality is 0."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    found = url_filter.verdicts(table(spark, sf_dir, "pages"), labels)
    return found.select("page_id", "host", "path", "rule", "verdict", "confidence")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_and_read(table(spark, sf_dir, "documents"), tokenizer_path())


def _predicted(found: DataFrame, least: float) -> list[Column]:
    return [
        F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("score"),
        (F.col("score") >= least).cast("int").alias("predicted"),
    ]


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(*_predicted(found, 0.5), F.size("spans").alias("n_spans"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited(table(spark, sf_dir, "documents"))
    own, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(own).alias("fingerprint"), fingerprints.as_text(other).alias("edited_fingerprint"),
        fingerprints.resemblance(own, other).alias("near_edited"),
        F.coalesce(fingerprints.resemblance(own, following), F.lit(0.0)).alias("near_next"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"), mixing.Target(max_repeats=MAX_REPEATS))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(*_predicted(found, 0.3))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    every_seventh = F.col("vec_id") % 7 == 0
    label = F.col("label").cast("bigint")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(every_seventh, (label + 1) % 10).otherwise(label).alias("label"),
        hard_negatives.quantised(F.col("embedding")).alias("vector"), (F.col("vec_id") % 100 == 0).alias("anchor"),
    )
    return hard_negatives.hard_negatives(rows)


def op13_chunk_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_encoding.encoded(table(spark, sf_dir, "documents"), tokenizer_path(), chunk_encoding.Digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_files": op5_token_files,
    "op6_toxicity": op6_toxicity,
    "op7_fingerprints": op7_fingerprints,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_chunk_encoding": op13_chunk_encoding,
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')"""



def _templates() -> str:
    rows = [(i, name, " ".join(license_scan.normalised(text))) for i, (name, text) in enumerate(license_scan.TEMPLATES)]
    return ", ".join(f"({i}, '{name}', '{text}')" for i, name, text in rows)


ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": f"""
WITH templates AS (
  SELECT i, license, list_distinct([w[k] || ' ' || w[k + 1] for k in range(1, len(w))]) AS grams
  FROM (SELECT i, license, string_split(words, ' ') AS w FROM (VALUES {_templates()}) t(i, license, words))
),
lines AS (
  SELECT doc_id, pos, {_WORDS.replace("coalesce(text, '')", "line")} AS w
  FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
  )
),
placed AS (SELECT *, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM lines),
-- no template reaches the threshold with more words than that, unless words repeat
runs AS (
  SELECT a.doc_id, a.pos AS first_line, b.pos AS last_line,
    (SELECT flatten(list(c.w ORDER BY c.pos)) FROM lines c WHERE c.doc_id = a.doc_id AND c.pos BETWEEN a.pos AND b.pos) AS w
  FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + len(a.w) <= 400
),
sized AS (
  SELECT doc_id, first_line, last_line, list_distinct([w[k] || ' ' || w[k + 1] for k in range(1, len(w))]) AS grams
  FROM runs WHERE len(w) > 1
),
scored AS (
  SELECT doc_id, license, first_line, last_line,
    2 * len(list_intersect(s.grams, t.grams)) / (len(s.grams) + len(t.grams))::DOUBLE AS score
  FROM sized s JOIN templates t ON len(s.grams) BETWEEN 0.66 * len(t.grams) AND 1.51 * len(t.grams)
),
best AS (
  SELECT DISTINCT ON (doc_id, license) * FROM scored WHERE score >= 0.8
  ORDER BY doc_id, license, score DESC, last_line - first_line, first_line
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) AS place,
    count(*) OVER (PARTITION BY doc_id) AS n
  FROM best
)
SELECT d.doc_id, coalesce(n, 0)::INTEGER AS n_licenses, license, score, first_line::INTEGER AS first_line, last_line::INTEGER AS last_line
FROM documents d LEFT JOIN ranked r ON d.doc_id = r.doc_id AND place = 1
""",
    "op1_decontaminate": f"""
WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
),
doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (
    SELECT *, unnest(range(1, len(w) - k + 2)) AS i
    FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
  )
),
hits AS (SELECT doc_id, i, k, item_id FROM grams JOIN windows USING (k, gram)),
covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS word FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op4_line_dedup": r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
),
repeated AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE r.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON k.key = r.key GROUP BY doc_id
""",
    "op9_mixing": rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS n_tokens
  FROM documents
),
sources AS (SELECT source, count(*) AS documents, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY source),
limits AS (SELECT greatest(0.0, 1 - ln({MAX_REPEATS}) / nullif(ln(max(tokens) / min(tokens)), 0)) AS least, max(tokens)::DOUBLE AS most
  FROM sources WHERE tokens > 0),
bisected AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN (low + high) / 2 >= coalesce(least, 0) THEN low ELSE (low + high) / 2 END,
    CASE WHEN (low + high) / 2 >= coalesce(least, 0) THEN (low + high) / 2 ELSE high END
  FROM bisected, limits WHERE step < 30
),
temperature AS (
  SELECT CASE WHEN coalesce(least, 0) <= 0 THEN 0.0 ELSE round(high, 6) END AS a, most FROM bisected, limits WHERE step = 30
),
weighted AS (
  SELECT source, documents, tokens, CASE WHEN tokens > 0 THEN pow(tokens::DOUBLE, a) ELSE 0 END AS w,
    CASE WHEN tokens > 0 THEN round(pow(most / tokens, 1 - a), 6) ELSE 1.0 END AS repeats
  FROM sources, temperature
),
plan AS (
  SELECT source, round(w / sum(w) OVER (), 6) AS weight, repeats, ceil(sqrt(documents))::BIGINT AS n_blocks,
    floor(repeats)::BIGINT AS passes, round((repeats - floor(repeats)) * tokens)::BIGINT AS rest
  FROM weighted
),
placed AS (
  SELECT d.*, weight, repeats, passes, rest,
    ('0x' || substr(md5('1:block:' || d.source || ':' || doc_id), 1, 8))::BIGINT % n_blocks AS block,
    md5('1:' || passes || ':' || doc_id) AS place
  FROM docs d JOIN plan USING (source)
),
blocks AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, block) AS upto
  FROM (
    SELECT source, block, sum(n_tokens) AS size, md5('1:' || passes || ':' || source || ':' || block) AS place
    FROM placed GROUP BY source, block, passes
  )
),
counted AS (
  SELECT p.*, b.upto AS block_upto, b.upto - b.size AS block_before,
    b.upto - b.size + sum(n_tokens) OVER (PARTITION BY p.source, p.block ORDER BY p.place, p.doc_id::VARCHAR, n_tokens) AS upto
  FROM placed p JOIN blocks b USING (source, block)
)
SELECT doc_id, source, n_tokens, weight, repeats, passes, block,
  passes + CASE WHEN rest > 0 AND (block_upto <= rest OR block_before < rest AND upto <= rest) THEN 1 ELSE 0 END AS copies
FROM counted
""",
    "op11_conversation_trie": r"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (
      PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))
    ) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
-- the bits of CRC-32, a byte followed by seven shifts
crc AS (
  SELECT c, list_reduce(
    [4294967295::BIGINT] || flatten(list_transform(string_split(c::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)
  ) AS bits
  FROM (SELECT DISTINCT c FROM own)
),
convs AS (SELECT c, c - c % 100 AS base, xor(bits, 4294967295) % 6 AS h FROM crc),
rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text
  FROM (
    SELECT k.c, 0 AS part, o.pos, o.role, o.text FROM convs k JOIN own o ON o.c = k.base AND o.pos < k.h
    UNION ALL
    SELECT k.c, 1, o.pos, o.role, o.text FROM convs k JOIN own o ON o.c = k.c AND o.pos >= k.h
  )
),
prefixes AS (
  SELECT c, d, length(text) AS chars,
    md5(string_agg(md5(length(role)::VARCHAR || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d)) AS key
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs
),
nodes AS (SELECT key, d, min(c) AS c, count(*) AS n_convs, any_value(chars) AS chars FROM prefixes GROUP BY key, d),
tops AS (SELECT n.key, n.d, a.key AS top_key, a.d AS top_d FROM nodes n JOIN prefixes a ON a.c = n.c AND a.d <= n.d),
children AS (SELECT top_key AS key, top_d AS d, count(*) AS n FROM tops WHERE top_d = d - 1 GROUP BY ALL),
totals AS (
  SELECT top_key AS key, top_d AS d, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved
  FROM tops t JOIN nodes n ON n.key = t.key AND n.d = t.d LEFT JOIN children k ON k.key = t.key AND k.d = t.d
  GROUP BY top_key, top_d
),
lengths AS (SELECT c, max(d) AS d FROM prefixes GROUP BY c),
ends AS (SELECT key, d, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM prefixes JOIN lengths USING (c, d) GROUP BY key, d)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, t.n_leaves, t.saved AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN totals t USING (key, d) LEFT JOIN children k USING (key, d) LEFT JOIN ends e USING (key, d)
LEFT JOIN tops u ON u.key = n.key AND u.d = n.d AND u.top_d = n.d - 1 LEFT JOIN nodes p ON p.key = u.top_key AND p.d = u.top_d
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, v.vec_id, v.label, list_inner_product(a.q, v.q)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
""",
}
