"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources alike) and 1
(as they are), normalised. The exponent is bisected to meet a target entropy or a limit on how often the
most repeated source may be gone through; each job evaluates the midpoints of six steps at once, so sources
are never gathered. Without a token budget, the mix is the smallest one that uses every document; with one,
each source gets its weight's share of it.

A source's budget is realised in whole passes over its documents and one part of a pass. Its documents are
hashed into about sqrt(n) blocks, and each pass is a permutation of blocks, and of documents in a block. The part of a
pass takes blocks in order as long as they fit, and of the next block documents in order. A table of the
blocks says all that, so documents are only joined to it, and no window holds more than about sqrt(n) rows
of a hot source. ``mix_order`` gives each copy its pass and position; ``mixed`` only repeats the rows. All steps are
DataFrame functions.

Defined cases: a null source is the source ''; null and empty texts have no tokens. Sources without tokens
have weight 0 and each of their documents stays once. Rows equal in doc_id, source and tokens are taken
together. Other columns are kept as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from badgeflow.llm.common import written

#: Decimals of the exponent and of repeats, so that every client computes the same.
DECIMALS = 6
STEPS_PER_JOB = 6
JOBS = 5
#: What separates tokens, as a pattern.
TOKEN = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    max_repeats: float | None = 2.0  # passes over the most repeated source, where every document is used once
    entropy: float | None = None  # of the weights, in nats
    budget: int | None = None  # tokens of the mix; None: so that every document is used
    seed: int = 1


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def measured(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), tokens(F.col("text")).alias("n_tokens"))


def _order(*parts) -> Column:
    """A permutation's sort key."""
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def exponent(sources: DataFrame, target: Target) -> float:
    """The smallest exponent whose weights keep to the limits: repeats at most, entropy at most the targets."""
    shares = sources.where("tokens > 0")
    extent = shares.agg(F.sum("tokens").alias("total"), F.max("tokens").alias("most")).first()
    if not extent["total"]:
        return 1.0
    log_share = F.log(F.col("tokens") / F.lit(float(extent["total"])))
    log_most = math.log(extent["most"] / extent["total"])
    low, high = 0.0, 1.0

    def allowed(points: list[float]) -> list[bool]:
        each = shares.select(log_share.alias("l"), F.posexplode(F.array(*map(F.lit, points))).alias("i", "a"))
        rows = each.groupBy("i", "a").agg(
            F.sum(F.exp(F.col("a") * F.col("l"))).alias("z"),
            F.sum(F.col("l") * F.exp(F.col("a") * F.col("l"))).alias("e"),
            F.max((1 - F.col("a")) * (F.lit(log_most) - F.col("l"))).alias("r"),
        ).orderBy("i").collect()  # a row per point
        return [
            (target.max_repeats is None or r.r <= math.log(target.max_repeats))
            and (target.entropy is None or math.log(r.z) - r.a * r.e / r.z <= target.entropy)
            for r in rows
        ]

    if allowed([0.0])[0]:
        return 0.0
    for _ in range(JOBS):
        n = 1 << STEPS_PER_JOB
        points = [low + (high - low) * i / n for i in range(1, n)]
        good = allowed(points)
        first = good.index(True) if True in good else n - 1
        low, high = (points[first - 1] if first else low), (points[first] if first < n - 1 else high)
    return round(high, DECIMALS)


def budgets(sources: DataFrame, target: Target) -> DataFrame:
    """source, weight, repeats, n_blocks, passes (whole ones) and rest (tokens of the part of a pass)."""
    a = exponent(sources, target)
    extent = sources.agg(
        F.max("tokens").alias("most"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(a)) * (F.col("tokens") > 0).cast("int")).alias("z")
    ).first()
    most, z = float(extent["most"] or 0), float(extent["z"] or 0)
    used = F.col("tokens") > 0
    weight = F.when(used, F.pow(F.col("tokens").cast("double"), F.lit(a)) / F.lit(z or 1.0)).otherwise(F.lit(0.0))
    if target.budget is None:
        repeats = F.pow(F.lit(most) / F.col("tokens"), F.lit(1 - a))
    else:
        repeats = weight * F.lit(float(target.budget)) / F.col("tokens")
    repeats = F.when(used, F.round(repeats, DECIMALS)).otherwise(F.lit(1.0))
    passes = F.floor("repeats").cast("bigint")
    return sources.select(
        "source", "tokens", F.round(weight, DECIMALS).alias("weight"), repeats.alias("repeats"),
        F.ceil(F.sqrt(F.col("documents").cast("double"))).cast("bigint").alias("n_blocks"),
    ).select(
        "source", "weight", "repeats", "n_blocks", passes.alias("passes"),
        F.round((F.col("repeats") - passes) * F.col("tokens")).cast("bigint").alias("rest"),
    )


def _placed(rows: DataFrame, plan: DataFrame, target: Target) -> DataFrame:
    """Rows with their source's plan, their block and their place in it."""
    number = F.conv(F.substring(_order(target.seed, "block", F.col("source"), _id(F.col("doc_id"))), 1, 8), 16, 10)
    return rows.join(plan, "source").withColumns({
        "block": number.cast("bigint") % F.col("n_blocks"),
        "place": F.struct(
            _order(target.seed, F.col("passes"), _id(F.col("doc_id"))).alias("key"), _id(F.col("doc_id")).alias("id"), "n_tokens"
        ),
    })


def block_order(target: Target, epoch: Column) -> Column:
    return _order(target.seed, epoch, F.col("source"), F.col("block"))


def plans(rows: DataFrame, target: Target) -> tuple[DataFrame, DataFrame]:
    """The sources' plan, and of each block in the part of a pass: whole, or the last place that is taken.

    rows: doc_id, source, n_tokens.
    """
    sources = written(rows.groupBy("source").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens")), "mix-sources")
    plan = written(budgets(sources, target), "mix-plan")
    placed = _placed(rows, plan, target)
    ordered = Window.partitionBy("source").orderBy(F.col("order"), F.col("block"))
    blocks = written(
        placed.groupBy("source", "block", "passes", "rest").agg(F.sum("n_tokens").alias("size"))
        .withColumn("order", block_order(target, F.col("passes")))
        .withColumn("upto", F.sum("size").over(ordered))
        .select("source", "block", "rest", (F.col("upto") - F.col("size")).alias("before"), "upto"),
        "mix-blocks",
    )
    cut = blocks.where("before < rest AND upto > rest").select("source", "block", "before")  # one of each source
    running = F.sum("n_tokens").over(Window.partitionBy("source", "block").orderBy("place"))
    last = (
        placed.join(cut, ["source", "block"]).withColumn("upto", F.col("before") + running)
        .where("upto <= rest").groupBy("source", "block").agg(F.max("place").alias("last"))
    )
    taken = blocks.join(last, ["source", "block"], "left").select(
        "source", "block", ((F.col("rest") > 0) & (F.col("upto") <= F.col("rest"))).alias("whole"), "last"
    )
    return plan, written(taken.where("whole OR last IS NOT NULL"), "mix-taken")


def with_copies(docs: DataFrame, rows: DataFrame, target: Target = Target()) -> DataFrame:
    """docs (with doc_id, source and n_tokens) with weight, repeats, passes, block and copies.

    rows: the same documents without what is not needed for planning.
    """
    plan, taken = plans(rows, target)
    extra = F.coalesce(F.col("whole") | (F.col("place") <= F.col("last")), F.col("whole"), F.lit(False))
    return (
        _placed(docs, plan, target).join(taken, ["source", "block"], "left")
        .withColumn("copies", F.col("passes") + extra.cast("bigint"))
        .drop("place", "whole", "last", "rest", "n_blocks")
    )


def mix_plan(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """doc_id, source, n_tokens, weight, repeats, passes, block, copies of every document."""
    rows = written(measured(docs), "mix-documents")
    return with_copies(rows, rows, target)


def mixed(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """Each document as often as the mix uses it, with its columns as they are."""
    rows = written(measured(docs), "mix-documents")
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    keyed = docs.select(own).select(
        "row", F.col("row.doc_id").alias("doc_id"), F.coalesce("row.source", F.lit("")).alias("source"),
        tokens(F.col("row.text")).alias("n_tokens"),
    )
    return with_copies(keyed, rows, target).where("copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    ).select("row.*")


def mix_order(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """doc_id, source, n_tokens, pass (from 0) and position (from 1, in the pass over the source) of each copy in the mix.

    Each pass has its own permutation of blocks, and of documents in a block. A position is the size of the blocks before
    plus the place in the block, so no window holds a whole source. Sort by these columns to realise the mix.
    """
    rows = written(measured(docs), "mix-documents")
    copies = with_copies(rows, rows, target).where("copies > 0").select(
        "doc_id", "source", "n_tokens", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("pass")
    )
    of_pass = ["source", "pass"]
    blocks = copies.groupBy(*of_pass, "block").agg(F.count("*").alias("size")).withColumn("order", block_order(target, F.col("pass")))
    before = F.sum("size").over(Window.partitionBy(*of_pass).orderBy("order", "block")) - F.col("size")
    blocks = written(blocks.select(*of_pass, "block", before.alias("before")), "mix-pass-blocks")
    place = [_order(target.seed, F.col("pass"), _id(F.col("doc_id"))), _id(F.col("doc_id")), F.col("n_tokens")]
    in_block = F.row_number().over(Window.partitionBy(*of_pass, "block").orderBy(*place))
    return copies.withColumn("place", in_block).join(blocks, [*of_pass, "block"]).select(
        "doc_id", "source", "n_tokens", "pass", (F.col("before") + F.col("place")).alias("position")
    )
