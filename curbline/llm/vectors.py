"""Nearest neighbours with randomly rotated one-bit codes.

Index: vectors are centred, normalised and rotated at random; a code is the
sign of each coordinate (packed bits), kept with two correction scalars: the
distance from the centre, and how well the code points along its vector.
From a code the inner product with a query is estimated without bias, with a
known error bound (Gao and Long, "RaBitQ", 2024).

Search: the stated queries go to the tasks in blocks of bounded size; each
task scans the codes of its own rows. A row is reranked by its exact distance
if the lower end of its estimate is not beyond the k-th smallest upper end
seen. Every task hands on k rows per query; a window keeps the k nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import written

SEED = 11
ERROR = 4.0                     # width of the bound; fails for about 1 row in 10,000
QUERY_BLOCK_BYTES = 8 << 20     # of queries sent to the tasks at a time
SCAN_ROWS = 4096                # rows estimated at a time


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(``vec_id``, ``v`` array<double>): rows with an id and a finite, non-zero vector."""
    inf = F.lit(float("inf"))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def encode(v: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance from the centre, and <code, unit vector>."""
    r = v - centre
    norm = np.linalg.norm(r, axis=1)
    unit = (r / np.where(norm > 0, norm, 1)[:, None]) @ turn
    along = np.abs(unit).sum(axis=1) / np.sqrt(v.shape[1])
    return np.packbits(unit > 0, axis=1), norm, np.where(norm > 0, along, 1.0)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The index: (``vec_id``, ``code``, ``norm``, ``along``, ``v``), written to the shared folder.

    Every usable row is indexed. The dimension is the most frequent length (the
    smaller of equals); rows of another length, null ids, and vectors that are
    null, zero or hold null or non-finite components take no part.
    """
    rows = usable(vectors, id_col, vector_col)
    sizes = sorted(rows.groupBy(F.size("v").alias("d")).count().collect(), key=lambda r: (-r["count"], r.d))
    d = sizes[0].d if sizes else 0
    rows = rows.where(F.size("v") == d)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(d)
        for batch in batches:
            sums += _matrix(batch.column(0), d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(sums)], ["place", "s"])

    centre = np.zeros(d)
    if d:
        for r in rows.select("v").mapInArrow(total, "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).collect():
            centre[r.place] = r.s / sizes[0]["count"]
    turn = rotation(d) if d else np.zeros((0, 0))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, norm, along = encode(_matrix(batch.column(1), d), centre, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(norm), pa.array(along), batch.column(1)],
                ["vec_id", "code", "norm", "along", "v"])

    index = written(rows.mapInArrow(code, "vec_id bigint, code binary, norm double, along double, v array<double>"), "vectors-index")
    index.centre, index.dimension = centre, d       # plain attributes, both bounded by the dimension
    return index


class Searcher:
    """The k nearest rows so far of each query of one block."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, centre: np.ndarray, k: int):
        self.ids, self.q, self.k, self.d = ids, q, k, q.shape[1]
        r = q - centre
        self.norm = np.linalg.norm(r, axis=1)
        self.unit = ((r / np.where(self.norm > 0, self.norm, 1)[:, None]) @ rotation(self.d)).astype(np.float32)
        self.near = np.full((len(q), k), np.inf)
        self.near_id = np.full((len(q), k), np.iinfo(np.int64).max)

    def bounds(self, code: np.ndarray, norm: np.ndarray, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper end of each squared distance (queries x rows), from codes alone."""
        signs = np.unpackbits(code, axis=1, count=self.d).astype(np.float32) * 2 - 1
        estimate = (self.unit @ signs.T) / (np.sqrt(self.d) * along).astype(np.float32)
        width = ERROR * np.sqrt(np.maximum(1 - along * along, 0)) / along / np.sqrt(max(self.d - 1, 1)) if self.d > 1 else 2.0
        scale = 2 * self.norm[:, None] * norm
        middle = self.norm[:, None] ** 2 + norm * norm
        slack = 1e-5 * middle
        return (middle - scale * np.minimum(estimate + width, 1) - slack,
                middle - scale * np.maximum(estimate - width, -1) + slack)

    def add(self, ids: np.ndarray, code: np.ndarray, norm: np.ndarray, along: np.ndarray, v: np.ndarray) -> int:
        """Scan some rows; the number of exact distances taken."""
        low, high = self.bounds(code, norm, along)
        own = self.ids[:, None] == ids
        high = np.where(own, np.inf, high)
        most = np.partition(high, self.k - 1, axis=1)[:, self.k - 1] if len(ids) >= self.k else np.full(len(self.q), np.inf)
        most = np.minimum(most, self.near[:, -1] ** 2 * (1 + 1e-9))
        qi, vi = np.nonzero((low <= most[:, None]) & ~own)
        for lo in range(0, len(qi), 1 << 16):
            a, b = qi[lo:lo + (1 << 16)], vi[lo:lo + (1 << 16)]
            # one component after the other, as a plain loop would sum
            exact = np.sqrt(np.cumsum((self.q[a] - v[b]) ** 2, axis=1)[:, -1])
            order = np.lexsort((ids[b], exact, a))
            a, b, exact = a[order], b[order], exact[order]
            first = np.searchsorted(a, np.arange(len(self.q) + 1))
            for i in np.unique(a):
                s = slice(first[i], min(first[i + 1], first[i] + self.k))
                d, n = np.r_[self.near[i], exact[s]], np.r_[self.near_id[i], ids[b[s]]]
                best = np.lexsort((n, d))[:self.k]
                self.near[i], self.near_id[i] = d[best], n[best]
        return len(qi)


def _search_block(index: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((ids, q))
    centre, d = index.centre, index.dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(*shared.value, centre, k)
        for batch in batches:
            for lo in range(0, batch.num_rows, SCAN_ROWS):
                part = batch.slice(lo, SCAN_ROWS)
                code = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                search.add(np.asarray(part.column(0)), code, np.asarray(part.column(2)), np.asarray(part.column(3)),
                           _matrix(part.column(4), d))
        at = np.nonzero(np.isfinite(search.near))
        yield pa.RecordBatch.from_arrays(
            [pa.array(search.ids[at[0]], pa.int64()), pa.array(search.near_id[at], pa.int64()), pa.array(search.near[at])],
            ["query_id", "vec_id", "score"])

    return index.select("vec_id", "code", "norm", "along", "v").mapInArrow(run, "query_id bigint, vec_id bigint, score double")


def nearest(index: DataFrame, asked: DataFrame, k: int = 10) -> DataFrame:
    """(``query_id``, ``rank`` from 1, ``vec_id``, ``score``): the k nearest rows of each query.

    ``asked`` are rows of the index (``vec_id``, ``v``). Rows with the query's
    id are no candidates for it; an id asked with several vectors is asked with
    the smallest. Nearness is the Euclidean distance of the original vectors in
    double precision, ties go to the smaller id; a repeated candidate row counts
    each time. Fewer candidates than k give fewer rows.
    """
    queries = asked.groupBy("vec_id").agg(F.min("v").alias("v"))
    count = queries.count()
    blocks = max(1, -(-count * index.dimension * 8 // QUERY_BLOCK_BYTES))
    found = []
    for b in range(blocks):         # a block is bounded; every block sees all rows
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
        if rows:
            found.append(_search_block(index, np.array([r.vec_id for r in rows], np.int64), np.array([r.v for r in rows], float), k))
    if not found:
        return asked.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
