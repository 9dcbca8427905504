"""The trie of conversation prefixes, by digests of fixed-length blocks of turns.

A node is a distinct sequence of first turns. Texts are hashed where they are
read; only digests and lengths move.

1. Prefix digests: 128 bits from every turn's digest and place, run along each
   conversation. Conversations are numbered and summed in chunks of ``CHUNK`` turns,
   so a very long one is many small groups.
2. Block digests first: conversations are grouped by the prefix at the end of
   every block of ``BLOCK`` turns. From a block's start to its end either
   - one conversation is left: its rows are nodes as they are;
   - all that enter the block leave it together: its nodes have the members of
     its end, and one member's rows stand for them;
   - or siblings diverge: only there are turns grouped by their own prefixes.
3. Sums over subtrees need no walk from level to level. Every node belongs to its
   smallest conversation, which owns the rest of its own path too; so each
   conversation adds, at each of its block ends and diverging turns, what it owns from
   there on, and one aggregate per prefix sums the subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import forget, only, sized_broadcast, written

BLOCK = 4               # turns of a block
CHUNK = 4096            # turns of a conversation that are numbered or summed together
SHARED = 100            # conversations that take over the first turns of one of them
MOST_SHARED = 6
ENDS_BYTES = 1 << 20    # ids joined at a time
PREFIX = ["depth", "p1", "p2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _running(rows: DataFrame, key: str, chunk: Column, order: list[Column], value: str, out: str, fold: Callable = F.sum) -> DataFrame:
    """``rows`` with ``out``: ``value`` folded over the rows of ``key`` from the first to this one.

    ``chunk`` rises with ``order`` and cuts a key into groups of bounded size.
    """
    rows = rows.withColumn("_chunk", chunk)
    local = fold(value).over(Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    parts = rows.groupBy(key, "_chunk").agg(fold(value).alias("part"))
    before = (parts.withColumn("before", fold("part").over(Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)))
              .where("before IS NOT NULL").select(key, "_chunk", "before"))
    before = written(before, "trie-before")         # empty where every conversation is one chunk
    both = rows.withColumn("_local", local).join(sized_broadcast(before, before.count(), 64), [key, "_chunk"], "left")
    zero = F.coalesce("before", F.lit(0).cast("long"))
    total = F.col("_local").bitwiseXOR(zero) if fold is F.bit_xor else F.col("_local") + zero
    return both.withColumn(out, total).drop("_chunk", "_local", "before")


def taken_over(conv: Column) -> Column:
    """How many first turns a conversation takes over."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(MOST_SHARED))


def _numbered(turns: DataFrame) -> DataFrame:
    """(``c``, ``at`` from 1, ``d1``, ``d2``, ``chars``): each conversation's turns in order, null first."""
    chunk = F.coalesce(F.call_function("div", F.col("turn").cast("long"), F.lit(CHUNK).cast("long")), F.lit(-(1 << 62)))
    chunk = F.when(F.col("turn") < 0, chunk - 1).otherwise(chunk)
    order = [F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2")]
    return _running(turns.withColumn("one", F.lit(1).cast("long")), "c", chunk, order, "one", "at").select("c", "at", "d1", "d2", "chars")


def rebuilt_turns(convs: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after the first turns of the hundred's conversation replaced each one's own.

    turns: ``c``, ``pos`` from 1, ``d1``, ``d2``, ``chars``; conversations: ``c``, ``length``.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = only(convs, [id_col, turn_col, role_col, text_col]).toDF("c", "turn", "role", "text").where("c IS NOT NULL").select(
        F.col("c").cast("long").alias("c"), "turn", F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit("turn"), text, role).alias("d2"),
        F.char_length(text).cast("long").alias("chars"))
    own = written(_numbered(turns), "trie-own")
    c, h = F.col("c"), taken_over(F.col("c"))
    heads = own.where((c % SHARED == 0) & (F.col("at") < MOST_SHARED)).groupBy(c.alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("at", "d1", "d2", "chars"))).alias("head"))
    ids = own.groupBy("c").agg(F.max("at").alias("turns")).withColumn("base", c - c % SHARED)
    ids = written(ids.join(heads, "base", "left").select(
        "c", h.alias("h"), "turns", F.coalesce(F.slice("head", F.lit(1), h.cast("int")), F.array().cast(heads.schema["head"].dataType)).alias("head"))
        .withColumn("length", F.size("head") + F.greatest(F.col("turns") - F.col("h"), F.lit(0).cast("long"))), "trie-ids")
    first = ids.select("c", F.explode("head").alias("t")).select("c", F.col("t.at").alias("pos"), "t.d1", "t.d2", "t.chars")
    shift = ids.select("c", "h", F.size("head").alias("taken"))
    rest = (own.join(sized_broadcast(shift, ids.count(), 64), "c").where("at > h")
            .select("c", (F.col("at") - F.col("h") + F.col("taken")).alias("pos"), "d1", "d2", "chars"))
    out = written(first.union(rest), "trie-rebuilt")
    forget(own)
    return out, ids.select("c", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(``c``, ``depth``, ``p1``, ``p2``, ``q1``, ``q2``, ``chars``): each turn's prefix digest, and the one before it."""
    rows = turns.select("c", F.col("pos").alias("depth"), "chars", F.xxhash64("pos", "d1", "d2").alias("h1"),
                        F.xxhash64(F.lit("prefix"), "d2", "pos", "d1").alias("h2"))
    chunk = F.call_function("div", F.col("depth") - 1, F.lit(CHUNK).cast("long"))
    for h, p in (("h1", "p1"), ("h2", "p2")):
        rows = _running(rows, "c", chunk, [F.col("depth")], h, p, F.bit_xor)
    return rows.select("c", *PREFIX, F.col("p1").bitwiseXOR(F.col("h1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("q2"), "chars")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (prefix, id) rows: per prefix its ids as comma-joined text, a piece at a time."""
    node, first, held, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({**{k: pa.array([v], pa.int64()) for k, v in zip(PREFIX, node)},
                                           "first": pa.array([first], pa.int64()), "ids": [",".join(held)]})

    for batch in batches:
        out = []
        for *own, c in zip(*(x.to_pylist() for x in batch.columns)):
            if own != node or size >= ENDS_BYTES:
                if held:
                    out.append(piece())
                node, first, held, size = own, c, [], 0
            held.append(str(c))
            size += len(held[-1]) + 1
        yield from out
    if held:
        yield piece()


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (prefix, first, ids) rows: per prefix the SHA-256 of all its ids."""
    node, digest = None, None

    def row() -> tuple:
        return (*node, digest.hexdigest())

    for batch in batches:
        out = []
        for *own, _, ids in zip(*(x.to_pylist() for x in batch.columns)):
            if own != node:
                if node:
                    out.append(row())
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], [*PREFIX, "ends"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row()], [*PREFIX, "ends"])


def _ends(members: DataFrame) -> DataFrame:
    """(prefix, ``ends``): SHA-256 of the ids of each prefix, ascending. Ids are joined in ranges, so
    only their text passes through the one task that hashes a prefix."""
    parts = (members.repartitionByRange(*PREFIX, "c").sortWithinPartitions(*PREFIX, "c").select(*PREFIX, "c")
             .mapInArrow(_joined_ids, "depth bigint, p1 bigint, p2 bigint, first bigint, ids string"))
    return (parts.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "first")
            .mapInArrow(_hashed_ids, "depth bigint, p1 bigint, p2 bigint, ends string"))


def prefix_trie(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256`` (of the members that end here).

    A conversation is rebuilt from the first h turns of the hundred's conversation and its
    own turns after its first h (``taken_over``). Null roles and texts are empty; turns
    with equal numbers (null ones first) stand in the order of their digests. Rows
    without a conversation id are left out. Repeated rows are turns of their own.
    Conversations that lose all turns are members of the root. An empty table gives
    no rows; other columns are not looked at. Very long texts are hashed whole
    where they are read.
    """
    turns, ids = rebuilt_turns(convs, id_col, turn_col, role_col, text_col)
    rows = written(_prefixes(turns), "trie-prefixes")
    forget(turns)
    none = F.lit(0).cast("long")
    total = ids.agg(F.count("*").alias("n"), F.min("c").alias("low")).first()
    if not total.n:
        return ids.select(*[F.lit(None).cast("long").alias(x) for x in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                          F.lit("").alias("ends_sha256"))

    # blocks: how many conversations enter and leave
    tops = rows.where(F.col("depth") % BLOCK == 0)
    groups = tops.groupBy(*PREFIX).agg(F.count("*").alias("n"), F.min("c").alias("low"))
    at_end = written(tops.select("c", *PREFIX).join(groups, PREFIX)
                     .select("c", F.call_function("div", F.col("depth"), F.lit(BLOCK).cast("long")).alias("k"), "n", "low"), "trie-ends")
    last = F.call_function("div", F.col("length") - 1, F.lit(BLOCK).cast("long"))
    blocks = ids.where("length > 0").select("c", "length", F.explode(F.sequence(none, last)).alias("k"))
    enter = at_end.select("c", "k", F.col("n").alias("n_in"), F.col("low").alias("low_in"))
    leave = at_end.select("c", (F.col("k") - 1).alias("k"), F.col("n").alias("n_out"))
    blocks = blocks.join(enter, ["c", "k"], "left").join(leave, ["c", "k"], "left").select(
        "c", "k", "length", F.coalesce("n_in", F.lit(total.n)).alias("n_in"), F.coalesce("low_in", F.lit(total.low)).alias("low_in"), "n_out")
    k = F.call_function("div", F.col("depth") - 1, F.lit(BLOCK).cast("long"))
    placed = written(rows.withColumn("k", k).join(blocks, ["c", "k"]), "trie-placed")

    # nodes of the three kinds; ``before``: lengths in the block before a node, ``end``: the place that sums its subtree
    alone = placed.where("n_in = 1")
    whole = placed.where("n_in > 1 AND n_out = n_in AND c = low_in")
    parted = placed.where("n_in > 1 AND (n_out IS NULL OR n_out < n_in)")
    step = Window.partitionBy("c", "k")
    chars = F.sum("chars").over(step.orderBy("depth").rowsBetween(Window.unboundedPreceding, -1))
    stood = whole.select(
        *PREFIX, "q1", "q2", F.col("n_in").alias("n"), F.col("c").alias("low"), F.col("c").alias("parent"), F.sum("chars").over(step).alias("chars"),
        F.coalesce(chars, none).alias("before"), *[F.max_by(x, "depth").over(step).alias(f"end_{x}") for x in PREFIX])
    split = written(parted.groupBy(*PREFIX, "q1", "q2").agg(
        F.count("*").alias("n"), F.min("c").alias("low"), F.max("low_in").alias("low_in"), F.max("chars").alias("chars")), "trie-split")
    above = split.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("low").alias("above"))
    split = split.join(above, ["depth", "q1", "q2"], "left").select(
        *PREFIX, "q1", "q2", "n", "low", F.when(F.col("depth") % BLOCK == 1 % BLOCK, F.col("low_in")).otherwise(F.col("above")).alias("parent"),
        "chars", none.alias("before"), *[F.col(x).alias(f"end_{x}") for x in PREFIX])
    nodes = written(stood.union(split), "trie-nodes")

    tops_alone = alone.where(F.col("depth") % BLOCK == 1 % BLOCK).select("depth", "q1", "q2")
    kids = written(nodes.select("depth", "q1", "q2").union(tops_alone)
                   .groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children")), "trie-kids")
    counted = written(nodes.join(kids, PREFIX, "left").withColumn("n_children", F.coalesce("n_children", none)), "trie-counted")

    # what each conversation owns, summed from every summing place of its path to its end
    sums = F.col("depth") == F.col("end_depth")
    weight = counted.where(sums).select(F.col("low").alias("c"), "depth", ((F.col("n") - 1) * F.col("chars")).alias("w"))
    leaves = alone.where("depth = length").select("c").union(counted.where("n_children = 0").select(F.col("low").alias("c")))
    active = written(leaves.withColumn("leaf", F.lit(1).cast("long")).union(weight.where("w > 0").select("c", none.alias("leaf")))
                     .groupBy("c").agg(F.max("leaf").alias("leaf")), "trie-active")
    places = placed.where((F.col("n_in") > 1) & ((F.col("depth") % BLOCK == 0) | F.col("n_out").isNull() | (F.col("n_out") < F.col("n_in"))))
    owned = places.select("c", *PREFIX).join(active, "c").join(weight, ["c", "depth"], "left").withColumn("w", F.coalesce("w", none))
    chunk = -F.call_function("div", F.col("depth"), F.lit(CHUNK).cast("long"))
    rest = _running(owned, "c", chunk, [F.col("depth").desc()], "w", "rest")
    below = rest.groupBy(*[F.col(x).alias(f"end_{x}") for x in PREFIX]).agg(F.sum("rest").alias("saved"), F.sum("leaf").alias("n_leaves"))

    ended = placed.where("n_in > 1 AND depth = length").select(*PREFIX, "c")
    bare = ids.where("length = 0").select(*[none.alias(x) for x in PREFIX], "c")
    ends = written(_ends(ended.union(bare)), "trie-hashes")
    named = (counted.join(below, [f"end_{x}" for x in PREFIX]).join(ends, PREFIX, "left").select(
        F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
        (F.col("saved") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")))
    last_turn = F.col("depth") == F.col("length")
    single = alone.select(
        F.col("c").alias("conv_id"), "depth", F.col("c").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), (~last_turn).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), none.alias("saved_tokens"),
        F.when(last_turn, F.sha2(F.col("c").cast("string"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"))

    # the root: totals, one row each
    children = kids.where("depth = 0").first()
    saved = weight.agg(F.sum("w")).first()[0] or 0
    n_leaves = active.agg(F.sum("leaf")).first()[0] or 1
    own_ends = ends.where("depth = 0").first()
    root = rows.sparkSession.range(1).select(
        F.lit(total.low).alias("conv_id"), none.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(total.n).cast("long").alias("n_convs"),
        F.lit(children.n_children if children else 0).cast("long").alias("n_children"), F.lit(n_leaves).cast("long").alias("n_leaves"),
        F.lit(saved).cast("long").alias("saved_tokens"), F.lit(own_ends.ends if own_ends else NO_ENDS).alias("ends_sha256"))
    return root.union(named).union(single)
