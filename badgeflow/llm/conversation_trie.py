"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Conversations are rebuilt from the opening of their hundred's first one and their own turns; equal sequences of
first turns are one node. A turn is known by a digest from the start on: texts are not shuffled. Turns are numbered
and prefixes hashed by running over range-partitioned rows, so a conversation may span any number of tasks; what one
task hands to the next is a row for each partition. A prefix is named by the xor of two 64-bit hashes of (depth, turn).

Totals of all subtrees come from contraction in join rounds. Each round

- rakes the leaves: their totals are complete and go to their parents in one aggregation;
- compresses unary chains: pointers are doubled until all of a chain's nodes point at its end, which then takes the
  chain's place under the parent of its top.

A chain of any length is one round (with as many joins as its length has binary digits), and without chains at
least half the nodes are leaves. Afterwards the contracted nodes are re-expanded, last round first.

The ids of the conversations that end at a node are joined into pieces where they lie, sorted by node and id; only
pieces meet in the task that digests them, one after the other.

Defined cases: a turn that is null comes first; equal turns are ordered by the digest of role and text, and repeated
rows are turns of their own. A null role or text is empty. Rows without conv_id belong to no conversation and take no
part. Without conversations there is no node. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import written

HUNDRED = 100
MOST_SHARED = 5  # turns that a conversation takes from its hundred's first one
PIECE_BYTES = 4096
#: Parents with more than this share of all nodes as children are few, and broadcast: fewer than HOT_PARENTS.
HOT_PARENTS = 1000

_EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


# --- running values over sorted partitions --------------------------------------------------


def _running(xored: list[str]):
    """Of rows sorted by conv_id: shard, place in the conversation, the running xor of columns, and whether the
    conversation is the first of its shard (so it may have begun in an earlier one)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, last, count = TaskContext.get().partitionId(), None, None, 0
        carried = {c: np.int64(0) for c in xored}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("conv_id").to_numpy()
            first = ids[0] if first is None else first
            new = np.r_[last is None or ids[0] != last, ids[1:] != ids[:-1]]
            start, group = np.flatnonzero(new), np.cumsum(new)  # group 0 goes on from the last batch
            place = np.arange(n) - np.r_[-count, start][group]
            columns = {}
            for c in xored:
                upto = np.bitwise_xor.accumulate(batch.column(c).to_numpy())
                before = np.r_[carried[c], np.r_[np.int64(0), upto][start]]
                columns[c] = upto ^ before[group]
                carried[c] = columns[c][-1]
            last, count = ids[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, shard)), pa.array(place), pa.array(ids == first), *map(pa.array, columns.values())],
                names=[*batch.schema.names, "shard", "place", "opens", *(f"{c}_upto" for c in xored)],
            )

    return rows


def running(rows: DataFrame, order: list[str], name: str, xored: tuple[str, ...] = ()) -> DataFrame:
    """The rows with place (from 0) in their conversation by ``order``, and for each of ``xored`` its xor up to there."""
    upto = [f"{c}_upto" for c in xored]
    schema = ", ".join([
        *(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields),
        "shard bigint, place bigint, opens boolean", *(f"{c} bigint" for c in upto),
    ])
    sorted_rows = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    table = written(sorted_rows.mapInArrow(_running(list(xored)), schema), name)
    ends = table.groupBy("shard").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last"),
        F.max_by(F.struct("place", *upto), F.struct("conv_id", "place")).alias("end"),
    )
    carries, open_id, carry = [], None, (0,) * (1 + len(xored))
    for r in sorted(ends.collect(), key=lambda r: r.shard):  # a row for each partition
        if r["first"] != open_id:
            carry = (0,) * len(carry)
        carries.append((r.shard, *carry))
        if r["first"] != r["last"]:
            carry = (0,) * len(carry)
        place, *xors = r.end
        carry = (carry[0] + place + 1, *(a ^ b for a, b in zip(carry[1:], xors)))
        open_id = r["last"]
    names = ["before", *(f"{c}_before" for c in xored)]
    small = rows.sparkSession.createDataFrame(carries, ", ".join(["shard bigint", *(f"{c} bigint" for c in names)]))

    def carried(c: str) -> Column:
        return F.when(F.col("opens"), F.col(c)).otherwise(F.lit(0).cast("bigint"))

    return table.join(F.broadcast(small), "shard").select(
        *rows.columns, (F.col("place") + carried("before")).alias("place"),
        *[F.col(f"{c}_upto").bitwiseXOR(carried(f"{c}_before")).alias(f"{c}_upto") for c in xored],
    )


# --- from conversations to nodes ------------------------------------------------------------


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its hundred's first one."""
    return (F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)).cast("int")


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, turn_key, n_chars of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("turn_key"),
        F.length(text).cast("bigint").alias("n_chars"),
    )
    return running(turns, ["turn", "turn_key"], "turns").withColumnRenamed("place", "pos").drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (conv_id, depth from 1, turn_key, n_chars), and all conv_ids."""
    openings = turns.where((F.col("conv_id") % HUNDRED == 0) & (F.col("pos") < MOST_SHARED))
    openings = written(
        openings.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "turn_key", "n_chars"))).alias("opening")), "openings"
    )
    wanted = shared_turns(F.col("conv_id"))
    convs = turns.where("pos = 0").select("conv_id", wanted.alias("wanted"), (F.col("conv_id") - F.col("conv_id") % HUNDRED).alias("base"))
    convs = written(
        convs.join(openings.select(F.col("conv_id").alias("base"), "opening"), "base", "left")
        .select("conv_id", "wanted", F.expr("slice(coalesce(opening, array()), 1, wanted)").alias("taken")),
        "conversations",
    )
    # few conversations find fewer turns than they want
    short = written(convs.where("size(taken) < wanted").select("conv_id", (F.col("wanted") - F.size("taken")).alias("missing")), "short-openings")
    own = turns.where(F.col("pos") >= wanted).join(short, "conv_id", "left").select(
        "conv_id", (F.col("pos") + 1 - F.coalesce("missing", F.lit(0))).alias("depth"), "turn_key", "n_chars"
    )
    taken = convs.select("conv_id", F.inline("taken")).select("conv_id", (F.col("pos") + 1).alias("depth"), "turn_key", "n_chars")
    return taken.unionByName(own), convs.select("conv_id")


def _id(x: str, y: str) -> Column:
    return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))


def trie(turns: DataFrame, conv_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes (id, parent, conv_id, depth, n_convs, n_chars), and the node at which each conversation ends."""
    steps = turns.withColumns({"x": F.xxhash64("depth", "turn_key"), "y": F.xxhash64("turn_key", "depth")})
    prefixes = running(steps, ["depth"], "prefixes", ("x", "y")).select(
        "conv_id", "depth", "n_chars", _id("x_upto", "y_upto").alias("id"),
        F.struct(F.col("x_upto").bitwiseXOR(F.col("x")).alias("x"), F.col("y_upto").bitwiseXOR(F.col("y")).alias("y")).alias("parent"),
    )
    root = F.struct(F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"))
    inner = prefixes.groupBy("id").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"), F.min("n_chars").alias("n_chars"),
    )
    top = conv_ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("conv_id IS NOT NULL").select(
        root.alias("id"), F.lit(None).cast("struct<x:bigint,y:bigint>").alias("parent"), "conv_id", F.lit(0).cast("bigint").alias("depth"),
        "n_convs", F.lit(0).cast("bigint").alias("n_chars"),
    )
    last = prefixes.groupBy("conv_id").agg(F.max_by("id", "depth").alias("id"))
    ends = conv_ids.join(last, "conv_id", "left").select("conv_id", F.coalesce("id", root).alias("id"))
    return written(inner.unionByName(top), "trie-nodes"), ends


# --- contraction ----------------------------------------------------------------------------


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """id and, for each of ``values``, its sum over the subtree that the node tops. tree: id, parent (null: a root), values."""

    def added(a: str, b: str) -> list[Column]:
        return [(F.col(f"{a}{v}") + F.col(f"{b}{v}")).alias(v) for v in values]

    has_children = tree.where("parent IS NOT NULL").select(F.col("parent").alias("id")).distinct().withColumn("inner", F.lit(True))
    #: of alive nodes: own and raked values, values on the edge to the parent (of chains that were compressed), leaf or not
    alive = written(
        tree.select("id", "parent", *values, *[F.lit(0).cast("bigint").alias(f"edge_{v}") for v in values])
        .join(has_children, "id", "left").withColumn("leaf", F.col("inner").isNull()).drop("inner"),
        "contracted",
    )
    raked, compressed = [], []
    while True:
        raked.append(alive.where("leaf").select("id", *values))
        gathered = alive.where("parent IS NOT NULL").groupBy("parent").agg(
            *[F.coalesce(F.sum(F.when(F.col("leaf"), F.col(v) + F.col(f"edge_{v}"))), F.lit(0)).alias(f"raked_{v}") for v in values],
            F.count_if(~F.col("leaf")).alias("n_inner"),
            F.max(F.when(~F.col("leaf"), F.struct("id", *[f"edge_{v}" for v in values]))).alias("child"),
        ).withColumnRenamed("parent", "id")
        left = alive.where("NOT leaf").join(gathered, "id").select(
            "id", "parent", *added("", "raked_"), *[f"edge_{v}" for v in values], "n_inner", "child",
            ((F.col("n_inner") == 1) & F.col("parent").isNotNull()).alias("unary"),
        )
        left = written(left, "raked")
        n_left, n_unary = left.agg(F.count("*"), F.count_if("unary")).first()
        if not n_left:
            break
        rest = left.where("NOT unary").select("id", "parent", *values, *[f"edge_{v}" for v in values], (F.col("n_inner") == 0).alias("leaf"))
        if n_unary:
            chains = _chains(left.where("unary"), values)
            compressed.append((len(raked) - 1, chains))
            tops = chains.groupBy("to").agg(
                F.max_by(F.struct("parent", *[(F.col(f"edge_{v}") + F.col(v)).alias(v) for v in values]), "hops").alias("top")
            ).withColumnRenamed("to", "id")
            rest = rest.join(tops, "id", "left").select(
                "id", F.coalesce("top.parent", "parent").alias("parent"), *values,
                *[F.coalesce(f"top.{v}", f"edge_{v}").alias(f"edge_{v}") for v in values], "leaf",
            )
        alive = written(rest, "contracted")
    totals = raked.pop()
    for at in range(len(raked) - 1, -1, -1):
        for chains in [c for n, c in compressed if n == at]:
            below = totals.select(F.col("id").alias("to"), *[F.col(v).alias(f"below_{v}") for v in values])
            expanded = chains.join(below, "to").select("id", *added("", "below_"))
            totals = written(totals.unionByName(expanded), "expanded")
        totals = totals.unionByName(raked[at])
    return totals


def _chains(unary: DataFrame, values: list[str]) -> DataFrame:
    """id, to (the end of the chain), hops up to it, values between them (the edge to the end included), parent, edges.

    Only pointers that have not reached an end are doubled again; but for one in a chain they point at different nodes.
    """
    edges = [f"edge_{v}" for v in values]
    columns = ["id", "to", "hops", *values]
    moving = written(
        unary.select("id", F.col("child.id").alias("to"), F.lit(1).cast("bigint").alias("hops"),
                     *[(F.col(v) + F.col(f"child.edge_{v}")).alias(v) for v in values]),
        "chains",
    )
    ended = None
    while True:
        known = moving.withColumn("ended", F.lit(False))
        if ended is not None:
            known = known.unionByName(ended.withColumn("ended", F.lit(True)))
        following = known.select(
            F.col("id").alias("to"), F.col("to").alias("to_next"), F.col("ended").alias("ended_next"),
            *[F.col(c).alias(f"{c}_next") for c in ("hops", *values)],
        )
        doubled = written(
            moving.join(following, "to", "left").select(
                "id", F.coalesce("to_next", "to").alias("to"),
                *[(F.col(c) + F.coalesce(f"{c}_next", F.lit(0))).alias(c) for c in ("hops", *values)],
                F.coalesce("ended_next", F.lit(True)).alias("ended"),
            ),
            "chains",
        )
        done = doubled.where("ended").select(columns)
        ended = done if ended is None else ended.unionByName(done)
        moving = doubled.where("NOT ended").select(columns)
        if not moving.take(1):
            return written(ended.join(unary.select("id", "parent", *edges), "id"), "chains")


# --- digests of the ends --------------------------------------------------------------------


def _pieces(piece_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by node and conv_id: comma-joined ids, and the first of each piece."""
        at, ids, size = None, [], 0
        out: list[tuple] = []

        def taken() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["x", "y", "first", "piece"])

        for batch in batches:
            for x, y, c in zip(*(batch.column(n).to_pylist() for n in ("x", "y", "conv_id"))):
                if ids and ((x, y) != at or size >= piece_bytes):
                    out.append((*at, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                at = (x, y)
                ids.append(c)
                size += len(str(c)) + 1
            if len(out) >= 1000:
                yield taken()
        if ids:
            out.append((*at, ids[0], ",".join(map(str, ids))))
        if out:
            yield taken()

    return rows


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted by node and first id: the digest of all pieces of a node."""

    def rows() -> Iterator[tuple]:
        at, digest = None, None
        for batch in batches:
            for x, y, piece in zip(*(batch.column(n).to_pylist() for n in ("x", "y", "piece"))):
                if (x, y) != at:
                    if at is not None:
                        yield (*at, digest.hexdigest())
                    at, digest = (x, y), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
        if at is not None:
            yield (*at, digest.hexdigest())

    out = []
    for row in rows():
        out.append(row)
        if len(out) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["x", "y", "ends_sha256"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["x", "y", "ends_sha256"])


def end_digests(ends: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """id and ends_sha256 of the nodes at which conversations end."""
    order = ["x", "y", "conv_id"]
    pieces = (
        ends.select("id.x", "id.y", "conv_id").repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_pieces(piece_bytes), "x bigint, y bigint, first bigint, piece string")
    )
    found = pieces.repartition("x", "y").sortWithinPartitions("x", "y", "first").mapInArrow(
        _digests, "x bigint, y bigint, ends_sha256 string"
    )
    return found.select(_id("x", "y").alias("id"), "ends_sha256")


# --- all together ---------------------------------------------------------------------------


def _with_parents(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """The nodes with their parent's conv_id. A parent of very many children is broadcast, as there are few of them."""
    names = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    least = max(HOT_PARENTS, nodes.count() // HOT_PARENTS)
    hot = written(
        children.where(F.col("n_children") > least).select(F.col("id").alias("parent")).join(names, "parent"), "hot-parents"
    ).select("parent", F.col("parent_conv_id").alias("hot_conv_id"))
    marked = nodes.join(F.broadcast(hot), "parent", "left")
    rest = marked.where("hot_conv_id IS NULL").drop("hot_conv_id").join(names, "parent", "left")
    return marked.where("hot_conv_id IS NOT NULL").withColumnRenamed("hot_conv_id", "parent_conv_id").unionByName(rest)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    turns, conv_ids = rebuilt(numbered(conversations))
    nodes, ends = trie(turns, conv_ids)
    children = written(nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children")), "children")
    valued = nodes.join(children, "id", "left").select(
        "id", "parent", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
    )
    totals = subtree_totals(valued, ["n_leaves", "saved_tokens"])
    return (
        _with_parents(nodes, children).join(totals, "id").join(children, "id", "left").join(end_digests(ends), "id", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY_DIGEST)).alias("ends_sha256"),
        )
    )
