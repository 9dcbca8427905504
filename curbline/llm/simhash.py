"""SimHash near-duplicates through a Gray-order hierarchical index.

1. Fingerprints: one Arrow pass over the texts; the texts themselves are never
   shuffled. Equal fingerprints are one node from then on, so a group of exact
   copies, however large, costs one row.
2. Distribution: the 64 bits are cut into ``distance + 2`` blocks. Two
   fingerprints at most ``distance`` bits apart agree on at least two whole
   blocks, so each fingerprint goes to one bucket per pair of blocks (15 for
   distance 4) and no link is missed. Buckets with over ``slice_rows`` rows are
   cut into slices, and every pair of slices is a bucket of its own.
3. Index: inside a task the buckets' fingerprints stand in Gray-rank order.
   Consecutive ones form groups, groups form groups above; each node holds the
   bits that all below it share (mask and pattern). Two nodes whose shared
   bits already differ in more than ``distance`` places are dropped with
   everything below; two nodes whose bits can differ in at most ``distance``
   places are joined whole, so a dense group is linked without its pairs.
4. A task hands on only a spanning forest of its links; components are found
   by ``connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import forget, only, written
from curbline.llm.components import connected_components

SEED = 42
FANOUT = 8
FRONTIER = 1 << 15      # node pairs expanded at a time
BATCH_ROWS = 200_000    # bucket rows indexed at a time (whole buckets)


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit integer (0 without words)."""
    words = text.lower().split()            # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    n = len(words) - width + 1
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        m = min(n, k + (1 << 15))
        h = np.array([hashed(flat[s:e], SEED) for s, e in
                      zip(starts[k:m].tolist(), ends[k + width - 1:m + width - 1].tolist())], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """(``id_col``, ``fp``) per row; a null text counts as empty (``fp`` 0)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                   for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], [id_col, "fp"])

    return only(docs, [id_col, text_col]).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


# --- the index inside a task ------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each uint64 in Gray-code order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links a-b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def _levels(bucket: np.ndarray, fp: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Index levels, elements first: (shared ones, any ones, first child, end child)."""
    ones, anys = fp, fp
    n = np.arange(len(fp))
    levels = [(ones, anys, n, n + 1)]
    while True:
        first_of = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[first_of, len(bucket)])
        if len(levels) > 1 and sizes.max() == 1:
            return levels
        inside = np.arange(len(bucket)) - np.repeat(first_of, sizes)
        starts = np.flatnonzero(inside % FANOUT == 0)
        ends = np.r_[starts[1:], len(bucket)]
        ones = np.bitwise_and.reduceat(ones, starts)
        anys = np.bitwise_or.reduceat(anys, starts)
        bucket = bucket[starts]
        levels.append((ones, anys, starts, ends))


def _spans(levels: list[tuple[np.ndarray, ...]], k: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Elements [from, to) below the nodes of level k."""
    lo, hi = node, node + 1
    for d in range(k, 0, -1):
        lo, hi = levels[d][2][lo], levels[d][3][hi - 1]
    return lo, hi


def _runs(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i all of lo[i]..hi[i]-1: (i repeated, the values)."""
    sizes = hi - lo
    owner = np.repeat(np.arange(len(lo)), sizes)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, lo[owner] + inside


def near_links(bucket: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that connect what is within ``distance`` in each bucket.

    ``bucket`` is sorted, ``fp`` (uint64) in Gray order within a bucket. Every
    returned link is a true one; every true link is implied by them.
    """
    levels = _levels(bucket, fp)
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []
    root = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, root, root)]
    while stack:
        k, a, b = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(k, a[:half], b[:half]), (k, a[half:], b[half:])]
            continue
        ones, anys = levels[k][:2]
        shared = ~(ones[a] ^ anys[a]) & ~(ones[b] ^ anys[b])
        apart = (ones[a] ^ ones[b]) & shared
        keep = np.bitwise_count(apart) <= distance
        a, b, shared, apart = a[keep], b[keep], shared[keep], apart[keep]
        whole = np.bitwise_count(~shared | apart) <= distance
        if whole.any():
            (alo, ahi), (blo, bhi) = _spans(levels, k, a[whole]), _spans(levels, k, b[whole])
            for first, lo, hi in ((alo, blo, bhi), (blo, alo, ahi)):
                owner, other = _runs(lo, hi)
                out_a.append(first[owner])
                out_b.append(other)
        a, b = a[~whole], b[~whole]
        if k and len(a):
            owner, x = _runs(levels[k][2][a], levels[k][3][a])
            pair, y = _runs(levels[k][2][b][owner], levels[k][3][b][owner])
            x, same = x[pair], (a == b)[owner][pair]
            ok = ~same | (x <= y)
            stack.append((k - 1, x[ok], y[ok]))
    if not out_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _index_task(distance: int):
    def links(keys: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        bucket = np.r_[0, np.cumsum((keys[1:] != keys[:-1]).any(axis=1))]
        a, b = near_links(bucket, fp, distance)
        values, place = np.unique(fp, return_inverse=True)
        root = forest(len(values), place[a], place[b])
        tied = np.flatnonzero(root != np.arange(len(values)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[tied].view(np.int64)), pa.array(values[root[tied]].view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(np.stack([np.asarray(c) for c in batch.columns], axis=1))
            rows += len(held[-1])
            if rows < BATCH_ROWS:
                continue
            block = np.concatenate(held)
            last = np.flatnonzero((block[1:, :-1] != block[:-1, :-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0     # the last bucket may go on
            if cut:
                yield links(block[:cut, :-1], block[:cut, -1].copy().view(np.uint64))
            held, rows = [block[cut:]], len(block) - cut
        if rows:
            block = np.concatenate(held)
            yield links(block[:, :-1], block[:, -1].copy().view(np.uint64))

    return run


# --- distribution -----------------------------------------------------------

def block_masks(distance: int) -> list[int]:
    """Bit masks of every pair among ``distance + 2`` blocks (as signed longs)."""
    n = distance + 2
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(blocks, 2))]


def fingerprint_links(nodes: DataFrame, distance: int = 4, slice_rows: int = 20_000) -> DataFrame:
    """Links (``a``, ``b``) that connect the distinct ``fp`` within ``distance`` bits."""
    fp = F.col("fp")
    keyed = nodes.select(fp, F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("mask"), fp.bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(block_masks(distance))])).alias("k")).select("k.mask", "k.bits", "fp")
    large = (keyed.groupBy("mask", "bits").count().where(F.col("count") > slice_rows)
             .select("mask", "bits", F.ceil(F.col("count") / slice_rows).alias("slices")))
    mine = F.pmod(F.xxhash64("fp"), F.coalesce("slices", F.lit(1)))
    sliced = (keyed.join(large, ["mask", "bits"], "left")
              .select("mask", "bits", "fp", mine.alias("own"),
                      F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("slices", F.lit(1)) - 1)).alias("other")))
    rank = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, s))
        sliced = sliced.withColumn("gray", rank)
        rank = F.col("gray")
    bucket = ["mask", "bits", "lo", "hi"]
    return (sliced.select("mask", "bits", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                          "fp", F.col("gray").bitwiseXOR(F.lit(-(1 << 63))).alias("gray"))
            .repartition(*bucket).sortWithinPartitions(*bucket, "gray")
            .select(*bucket, "fp")
            .mapInArrow(_index_task(distance), "a bigint, b bigint"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 4, distance: int = 4, slice_rows: int = 20_000) -> DataFrame:
    """(``id_col``, ``fp``, ``component_id``) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``distance`` bits, the row's own id included. Null and empty texts have
    fingerprint 0, which links like any other. Rows with a null id take part;
    a group of null ids alone has a null ``component_id``. Repeated rows stay
    repeated. Columns other than the two named are not looked at.
    """
    own = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    nodes = own.groupBy("fp").agg(F.min(id_col).alias("low"))
    links = written(fingerprint_links(own.select("fp").distinct(), distance, slice_rows), "simhash-links")
    parts = connected_components(links).select(F.col("node").alias("fp"), "component")
    rooted = nodes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = rooted.groupBy("component").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "component").select("fp", "component_id")
    forget(links)
    return own.join(named, "fp").select(id_col, "fp", "component_id")
