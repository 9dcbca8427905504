"""Near-duplicate documents by SuperMinHash signatures.

1. Sets: one Arrow pass hashes each document's word shingles to 64 bits. Equal
   sets get one 128-bit key and are one node from then on.
2. SuperMinHash (Ertl, "SuperMinHash - A New Minwise Hashing Algorithm for
   Jaccard Similarity Estimation", 2017): every element walks through its own
   random permutation of the slots and offers slot p(j) the value j + r, r in
   [0, 1). The ranks of an element fall on different slots, which lowers the
   variance, and once every slot holds a value below j + 1 later steps cannot
   change anything: large sets stop after a step or two.
3. Banding: ``ROWS`` slots make a band; buckets with one node are left out.
4. Verification on whole sets, in rounds that never emit a bucket's pairs:
   first every node with the smallest node of one of its buckets (one pair a
   node); then, in buckets whose nodes are still in several components, all
   pairs of up to ``SMALL`` nodes or each node with a few representatives; what a
   representative could not join in a large bucket is compared by rarest
   shingles, a prefix filter that loses no pair. Sizes and 125 signature bits
   drop pairs before their sets are read.
5. Verified links go through distributed union-find after each round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import forget, only, sized_broadcast, written
from curbline.llm.components import connected_components

SEED = 42
BANDS, ROWS = 25, 5     # misses 4 in 10 million of the pairs at 0.85
SLOTS = BANDS * ROWS
BLOCK = 4096            # elements hashed into the slots at a time
SMALL = 32              # nodes of a bucket that are paired with each other
ORDERS = 3              # representatives of a larger bucket

_GOLDEN = 0x9E3779B97F4A7C15
_STEP = np.uint64(_GOLDEN)


# --- inside a task ----------------------------------------------------------

def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a UTF-8 text's word shingles (uint64)."""
    words = text.lower().split()            # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(shingle, len(words))
    n = len(words) - width + 1
    hashed = xxhash.xxh64_intdigest
    parts = []
    for k in range(0, n, 1 << 16):
        m = min(n, k + (1 << 16))
        parts.append(np.fromiter((hashed(flat[s:e], SEED) for s, e in zip(
            starts[k:m].tolist(), ends[k + width - 1:m + width - 1].tolist())), np.uint64, m - k))
    return np.unique(np.concatenate(parts))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of a set of uint64: per slot the least j + r, as j * 2^53 + the bits of r."""
    best = np.full(slots, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), BLOCK):
        x = elements[at:at + BLOCK]
        rows = np.arange(len(x))
        places = None
        for j in range(slots):
            if j > int(best.max() >> np.uint64(53)):
                break
            z = _mixed(x + np.uint64(_GOLDEN * (j + 1) % 2**64))
            k = j + ((_mixed(z ^ _STEP) >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
            if j == 0:
                slot = first = k
            else:
                if places is None:
                    places = np.tile(np.arange(slots, dtype=np.int32), (len(x), 1))
                    places[rows, first] = 0
                    places[:, 0] = first
                slot = places[rows, k]
                places[rows, k] = places[:, j]
                places[:, j] = slot
            np.minimum.at(best, slot, (z >> np.uint64(11)) | np.uint64(j << 53))
    return best


def band_hashes(values: np.ndarray) -> np.ndarray:
    """One signed 64-bit hash per band of a signature."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in values.reshape(BANDS, ROWS).T:
        out = _mixed(out * _STEP + column)
    return out.view(np.int64)


def sketch(values: np.ndarray) -> np.ndarray:
    """The lowest bits of all slots, in signed 64-bit words."""
    bits = np.zeros(-(-len(values) // 64) * 64, np.uint8)
    bits[:len(values)] = (values & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(np.int64)


def set_key(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def _featured(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, bands, bits = [], [], [], []
            for t in batch.column(2).cast(pa.binary()):
                own = shingle_set(t.as_buffer().to_pybytes(), shingle)
                values = signature(own)
                keys.append(set_key(own))
                sizes.append(len(own))
                bands.append(band_hashes(values) if len(own) else [])
                bits.append(sketch(values))
            bits = np.array(bits).reshape(len(keys), 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(bits[:, 0]), pa.array(bits[:, 1]), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "text_hash", "key", "n", "s1", "s2", "bands"])

    return run


def _set_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):     # a few whole sets at a time
                sets = [shingle_set(t.as_buffer().to_pybytes(), shingle) for t in batch.column(0).slice(at, 64).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["key", "grams"])

    return run


# --- over the cluster -------------------------------------------------------

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return only(docs, [id_col, text_col]).toDF("id", "text").select("id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(``id``, ``text_hash``, ``key``, ``n``, ``s1``, ``s2``, ``bands``) per row."""
    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(
        _featured(shingle), f"id {kind}, text_hash bigint, key binary, n bigint, s1 bigint, s2 bigint, bands array<bigint>")


def most_apart(percent: int, loss: float = 1e-9) -> int:
    """Sketch bits in which a pair at the similarity differs at most, but for a share ``loss`` of such pairs."""
    p = (1 - percent / 100) / 2
    tail, bits = 1.0, -1
    while tail > loss:
        bits += 1
        tail -= math.comb(SLOTS, bits) * p ** bits * (1 - p) ** (SLOTS - bits)
    return bits


def _alike(percent: int, a: str, b: str) -> Column:
    """Sizes and signature bits of two members allow the similarity."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent) & (_bits_apart(a, b) <= most_apart(percent))


def _bits_apart(a: str, b: str) -> Column:
    return sum(F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in ("s1", "s2"))


def _overlap(percent: int, a: Column, b: Column) -> Column:
    """The fewest common elements with which sets of such sizes reach the similarity."""
    return F.call_function("div", (a + b) * percent + (99 + percent), F.lit(100 + percent).cast("long"))


def _can_meet(percent: int, a: str, b: str) -> Column:
    """``_alike``, and enough elements of each that are not its own alone."""
    return _alike(percent, a, b) & (F.least(f"{a}.common", f"{b}.common") >= _overlap(percent, F.col(f"{a}.n"), F.col(f"{b}.n")))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) with 100 x intersection >= percent x union of their whole sets."""
    x = sets.select(F.col("key").alias("a"), F.col("grams").alias("ga"))
    y = sets.select(F.col("key").alias("b"), F.col("grams").alias("gb"))
    sized = pairs.join(x, "a").join(y, "b").select(
        "a", "b", (F.size("ga") + F.size("gb")).cast("long").alias("total"), F.size(F.array_intersect("ga", "gb")).cast("long").alias("both"))
    return sized.where(F.col("both") * 100 >= (F.col("total") - F.col("both")) * percent).select("a", "b")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component (``label``) of their ``key``; a key without one is its own."""
    named = labels.select(F.col("node").alias("key"), F.col("component").alias("label"))
    return rows.join(named, "key", "left").withColumn("label", F.coalesce("label", "key"))


def _mixed_buckets(members: DataFrame) -> DataFrame:
    """Rows of the buckets in which several labels are left."""
    h = F.xxhash64("label")
    mixed = members.groupBy("band").agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("band")
    return members.join(mixed, "band", "left_semi")


def _member(*more: str) -> Column:
    return F.struct("key", "n", "s1", "s2", *more)


def _nearest_first(members: DataFrame, percent: int) -> DataFrame:
    """For each node one pair: of the nodes that head its buckets the one whose signature bits are nearest."""
    low = members.groupBy("band").agg(F.min(_member()).alias("y"))
    near = F.struct(_bits_apart("x", "y").alias("bits"), F.col("y.key").alias("b"))
    return (members.select("band", _member().alias("x")).join(low, "band")
            .where((F.col("x.key") > F.col("y.key")) & _alike(percent, "x", "y"))
            .groupBy(F.col("x.key").alias("a")).agg(F.min(near).alias("near")).select("a", "near.b"))


def _small_pairs(members: DataFrame, percent: int) -> DataFrame:
    x = members.select("band", F.col("label").alias("lx"), _member("common").alias("x"))
    y = members.select("band", F.col("label").alias("ly"), _member("common").alias("y"))
    return (x.join(y, "band").where((F.col("lx") != F.col("ly")) & (F.col("x.key") > F.col("y.key")) & _can_meet(percent, "x", "y"))
            .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")))


def _star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each node of a bucket with the first in each of a few orders, unless their labels agree."""
    low = members.groupBy("band").agg(F.array(*[
        F.min(F.struct(F.xxhash64("key", F.lit(i)).alias("at"), F.col("label"), _member("common").alias("y"))) for i in range(ORDERS)]).alias("heads"))
    each = (members.select("band", "label", _member("common").alias("x")).join(low, "band")
            .select("label", "x", F.explode("heads").alias("head")).select("label", "x", F.col("head.label").alias("ly"), F.col("head.y").alias("y")))
    return (each.where((F.col("label") != F.col("ly")) & _can_meet(percent, "x", "y"))
            .select(F.greatest("x.key", "y.key").alias("a"), F.least("x.key", "y.key").alias("b")))


def _rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """(``key``, ``n``, ``common``, ``rare``) of the sets that another of ``sets`` can be similar to.

    ``common`` counts the elements that another set has too; ``rare`` holds those (``h`` and
    the place ``at`` in the whole set, rarest first) that are among the first
    n - ceil(n percent / 100) + 1: sets that are similar have one of them in
    common, sets around a common passage none.
    """
    each = sets.select("key", F.size("grams").cast("long").alias("n"), F.explode("grams").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("often")).where("often > 1")
    least = F.expr(f"(n * {percent} + 99) div 100")
    # elements of one set alone come first: they are counted, not listed
    shared = each.join(often, "h").groupBy("key", "n").agg(F.count("*").alias("common"), F.collect_list(F.struct("often", "h")).alias("own"))
    alone = F.col("n") - F.col("common")
    length = F.greatest(F.col("n") - least + 1 - alone, F.lit(0)).cast("int")
    own = F.slice(F.sort_array("own"), F.lit(1), length)
    return (shared.where(F.col("common") >= least)
            .select("key", "n", "common", F.transform(own, lambda g, i: F.struct(g["h"].alias("h"), (i + F.col("n") - F.col("common")).alias("at"))).alias("rare")))


def _rare_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """All pairs with different labels that can reach the similarity: at the first element that
    both have, what follows must suffice."""
    each = rare.select("key", "label", "n", F.explode("rare").alias("g")).select("key", "label", "n", "g.h", "g.at")
    x, y = (each.select("h", *[F.col(c).alias(f"{c}_{k}") for c in ("key", "label", "n", "at")]) for k in "ab")
    na, nb = F.col("n_a"), F.col("n_b")
    return (x.join(y, "h").where((F.col("label_a") != F.col("label_b")) & (F.col("key_a") > F.col("key_b"))
                                 & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
                                 & (F.least(na - F.col("at_a"), nb - F.col("at_b")) >= _overlap(percent, na, nb)))
            .select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct())


def near_sets(nodes: DataFrame, texts: DataFrame, percent: int = 85, shingle: int = 5) -> DataFrame:
    """(``node``, ``component``) of the sets that are linked with another one.

    ``nodes``: one row per distinct set (``key``, ``n``, ``s1``, ``s2``, ``bands``, ``text_hash`` of one
    text that has it); ``texts`` (``text_hash``, ``text``).
    """
    # smaller sets reach the similarity with their equals only
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    bands = nodes.where(F.col("n") >= least).select("key", "n", "s1", "s2", F.explode("bands").alias("band"))
    shared = written(bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "superminhash-shared")
    members = written(bands.join(sized_broadcast(shared, shared.count(), 64), "band"), "superminhash-members")
    heads = written(_nearest_first(members, percent), "superminhash-pairs")

    wanted = nodes.join(members.select("key").distinct(), "key", "left_semi").select("text_hash").distinct()
    wanted = written(wanted, "superminhash-wanted")
    some = texts.join(sized_broadcast(wanted, wanted.count(), 64, 64 << 20), "text_hash", "left_semi")
    some = some.groupBy("text_hash").agg(F.first("text").alias("text")).select("text")
    sets = written(some.mapInArrow(_set_rows(shingle), "key binary, grams array<bigint>").join(
        members.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]), "superminhash-sets")

    links = written(_verified(heads, sets, percent), "superminhash-links")
    first = connected_components(links)
    left = written(_mixed_buckets(_labelled(members, first)), "superminhash-left")
    rare = written(_rare_first(sets.join(left.select("key").distinct(), "key", "left_semi"), percent), "superminhash-rare")
    left = left.join(rare.select("key", "common"), "key")
    small, large = left.where(F.col("size") <= SMALL), written(left.where(F.col("size") > SMALL), "superminhash-large")
    pairs = written(_small_pairs(small, percent).union(_star_pairs(large, percent)).distinct(), "superminhash-pairs")
    links = links.union(written(_verified(pairs, sets, percent), "superminhash-links"))
    second = connected_components(links)

    still = _mixed_buckets(_labelled(large.drop("label"), second)).select("key").distinct()
    still = written(_labelled(rare.join(still, "key", "left_semi"), second), "superminhash-still")
    more = written(_rare_pairs(still, percent), "superminhash-pairs")
    out = connected_components(links.union(written(_verified(more, sets, percent), "superminhash-links")))
    for t in (shared, members, heads, wanted, sets, rare, large, pairs, still, more):
        forget(t)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 85, shingle: int = 5) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``, ``kept``) for every row of ``docs``.

    A row's set is its distinct ``shingle``-word shingles (A-Z lowered, words between
    ASCII white space), the whole sequence if it has fewer words. Rows with
    100 x intersection >= ``percent`` x union are linked; ``component_id`` is the
    smallest id reachable, the row's own included, and ``kept`` says that it is the
    row's own id.

    Null and empty texts, and those without words, have no shingles and are
    linked with nothing. Rows with a null id take part (a group of null ids
    alone has a null ``component_id``) and are never ``kept``. Repeated rows stay
    repeated. Very long texts are used whole. An empty table gives no rows;
    other columns are not looked at. Sets hold 64-bit hashes.
    """
    own = written(features(docs, id_col, text_col, shingle), "superminhash-features")
    nodes = written(own.where("n > 0").groupBy("key", "n", "s1", "s2", "bands").agg(
        F.min("text_hash").alias("text_hash"), F.min("id").alias("low")), "superminhash-nodes")
    texts = _texts(docs, id_col, text_col).select("text_hash", "text")
    parts = near_sets(nodes, texts, percent, shingle).select(F.col("node").alias("key"), "component")
    rooted = nodes.select("key", "low").join(parts, "key", "left").withColumn("component", F.coalesce("component", "key"))
    lowest = rooted.groupBy("component").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "component").select("key", "component_id")
    found = own.select("id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key")).join(named, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
