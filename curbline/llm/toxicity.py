"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

1. A bounded set of labelled examples (``max_examples`` per label, by a hash of
   the id; their ids are broadcast, so no text is shuffled).
2. Terms: words that stand in toxic examples much and significantly more often
   (lift and log-likelihood ratio), the ``max_terms`` strongest.
   A document's vector has these words only.
3. One pass over all texts writes each document's term counts (few numbers a
   row); document frequencies over the whole corpus come from that table.
4. The examples' vectors form a block-max inverted index: postings by term, in
   blocks of example numbers with the largest weight of each. A query looks at
   blocks by falling upper bound and stops at the first that cannot reach the
   k-th best, so the k nearest are exact.
5. Cosine-weighted votes give a raw score. A monotone curve fitted to the
   examples' own leave-one-out votes calibrates it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.llm.common import only, written

_WORD = re.compile(r"[^\W\d_]+")
BLOCK = 64
MIN_G2 = 25.0           # about 1 word in 2 million by chance
MIN_LIFT = 4.0          # times as frequent in toxic examples
PRIOR_VOTES = 0.5
MARGIN = 1e-9           # rounding of summed weights


# --- block-max inverted index -----------------------------------------------

@dataclass
class BlockMaxIndex:
    """Postings of unit vectors, by term, with block maxima."""

    n: int
    start: np.ndarray           # per term: first entry of block table
    block: np.ndarray           # block table: block number
    top: np.ndarray             # its largest weight
    first: np.ndarray           # its first posting (one more entry at the end)
    example: np.ndarray         # postings
    weight: np.ndarray

    @staticmethod
    def build(n: int, n_terms: int, term: np.ndarray, example: np.ndarray, weight: np.ndarray) -> BlockMaxIndex:
        order = np.lexsort((example, term))
        term, example, weight = term[order], example[order], weight[order]
        blocks = max(1, -(-n // BLOCK))
        key = term.astype(np.int64) * blocks + example // BLOCK
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        top = np.maximum.reduceat(weight, first) if len(key) else weight
        return BlockMaxIndex(n, np.searchsorted(key[first] // blocks, np.arange(n_terms + 1)), key[first] % blocks,
                             top, np.r_[first, len(key)], example, weight)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine above 0 (ties: smaller number), exactly."""
        bound = np.zeros(-(-self.n // BLOCK))
        parts = [(slice(self.start[t], self.start[t + 1]), q) for t, q in zip(terms, weights)]
        for s, q in parts:
            bound[self.block[s]] += q * self.top[s]
        rest = np.argsort(-bound, kind="stable")[:np.count_nonzero(bound)]
        best, best_sim = np.empty(0, np.int64), np.empty(0)
        step = 4
        while len(rest):
            if len(best) >= k:      # a block must beat the k-th best, or tie with a smaller number
                worst = best_sim[k - 1]
                rest = rest[(bound[rest] > worst + MARGIN)
                            | (bound[rest] > worst - MARGIN) & (rest * BLOCK < best[k - 1])]
            chosen = np.full(len(bound), -1)
            group, rest = rest[:step], rest[step:]
            chosen[group] = np.arange(len(group))
            sims = np.zeros(len(group) * BLOCK)
            for s, q in parts:
                mine = np.flatnonzero(chosen[self.block[s]] >= 0) + s.start
                lo, sizes = self.first[mine], self.first[mine + 1] - self.first[mine]
                post = np.repeat(lo - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
                ex = self.example[post]
                sims[chosen[ex // BLOCK] * BLOCK + ex % BLOCK] += q * self.weight[post]
            ex = (group[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            hit = (sims > 0) & (ex != without)
            best, best_sim = np.r_[best, ex[hit]], np.r_[best_sim, sims[hit]]
            keep = np.lexsort((best, -np.round(best_sim, 9)))[:k]
            best, best_sim = best[keep], best_sim[keep]
            step *= 4
        return best, best_sim


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y on x: (x points, rising values)."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []      # mean, weight, weighted x
    for xi, yi, wi in zip(x[order], y[order], w[order]):
        blocks.append([yi, wi, xi * wi])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            (b, v, q), (a, u, p) = blocks.pop(), blocks.pop()
            blocks.append([(a * u + b * v) / (u + v), u + v, p + q])
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks])


# --- model ------------------------------------------------------------------

@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    ids: list                   # id of each example
    toxic: np.ndarray
    weight: np.ndarray          # how many labelled rows an example stands for
    k: int
    base: float                 # toxic share
    silent: float               # toxic share among examples without any term
    curve: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0, 1.0]), np.array([0.0, 1.0])))

    def vector(self, terms, counts) -> tuple[np.ndarray, np.ndarray]:
        t = np.asarray(terms, np.int64)
        w = (1.0 + np.log(np.asarray(counts, float))) * self.idf[t]
        return t, w / np.sqrt((w * w).sum())

    def votes(self, terms, counts, without: int = -1) -> tuple[float, list[tuple[int, float]]]:
        """Raw score and the neighbours (example number, cosine)."""
        near, sims = self.index.nearest(*self.vector(terms, counts), self.k, without)
        w = sims * self.weight[near]
        raw = float((w @ self.toxic[near] + PRIOR_VOTES * self.base) / (w.sum() + PRIOR_VOTES))
        return raw, list(zip(near.tolist(), sims.tolist()))

    def score(self, terms, counts) -> tuple[float, list[tuple[int, float]]]:
        if not len(terms):
            return self.silent, []
        raw, near = self.votes(terms, counts)
        return float(np.clip(np.interp(raw, *self.curve), 0.0, 1.0)), near


def choose_examples(labels: DataFrame, id_col: str, label_col: str, max_examples: int) -> DataFrame:
    """(id, ``toxic`` 0/1, ``stands_for``): about ``max_examples`` ids of each label."""
    rows = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(id_col).agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("toxic")))
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = [min(1.0, max_examples / counts.get(y, 1)) for y in (0, 1)]
    part = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_000)) / 1_000_000
    return rows.withColumn("stands_for", 1.0 / part).where(place < part)


def choose_terms(examples: DataFrame, text_col: str, max_terms: int) -> list[str]:
    """Words typical of toxic examples, strongest first (then alphabetical)."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in set(_WORD.findall((text or "").lower())):
                    seen.setdefault(w, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()),
                 pa.array([v[0] for v in seen.values()], pa.int64())], ["word", "a", "b"])

    totals = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    counted = (examples.select(text_col, "toxic").mapInArrow(words, "word string, a bigint, b bigint")
               .groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    p = (F.col("a") + F.col("b")) / (n1 + n0)

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    g2 = 2 * (part(F.col("a"), n1 * p) + part(F.col("b"), n0 * p)
              + part(n1 - F.col("a"), n1 * (1 - p)) + part(n0 - F.col("b"), n0 * (1 - p)))
    rows = (counted.where(F.col("a") * n0 >= MIN_LIFT * F.col("b") * n1).select("word", g2.alias("g2"))
            .where(F.col("g2") >= MIN_G2).orderBy(F.desc("g2"), "word").limit(max_terms).collect())
    return [r.word for r in rows]


def term_counts(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id, ``terms``, ``counts``) per row over the whole text."""
    place = {w: i for i, w in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = Counter(filter(place.__contains__, _WORD.findall((text.as_py() or "").lower())))
                rows.append(sorted((place[w], n) for w, n in found.items()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[t for t, _ in r] for r in rows], pa.list_(pa.int32())),
                 pa.array([[n for _, n in r] for r in rows], pa.list_(pa.int64()))], [id_col, "terms", "counts"])

    schema = T.StructType([docs.schema[id_col], T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("counts", T.ArrayType(T.LongType()))])
    return only(docs, [id_col, text_col]).mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", k: int = 25, max_examples: int = 10_000,
                   max_terms: int = 4096) -> DataFrame:
    """(id, ``score``, ``evidence``) per row of ``docs``.

    ``labels`` has the labelled rows to learn from (id, ``label_col``); an id
    labelled twice is toxic if any label says so; null ids or labels teach
    nothing. ``max_examples`` bounds the examples of each label (about),
    ``max_terms`` the words of a vector. ``evidence`` lists up to three nearest
    examples (id, cosine, label). Null texts count as empty; a text without any
    term gets the toxic share of such examples; without usable labels every
    score is the toxic share, or 0.0 without labels. Ids of ``docs`` may be
    null or repeated (of an example's texts under one id the one with the
    smallest vector is the example); other columns are not looked at.
    """
    spark = docs.sparkSession
    examples = written(choose_examples(labels, id_col, label_col, max_examples), "tox-examples")
    n_examples = examples.count()
    taught = only(docs, [id_col, text_col]).join(
        F.broadcast(examples) if n_examples <= 4 * max_examples else examples, id_col)
    terms = choose_terms(taught, text_col, max_terms)
    vectors = written(term_counts(docs, terms, id_col, text_col), "tox-vectors")

    total = vectors.count()
    freq = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    idf = np.array([np.log((1 + total) / (1 + freq.get(t, 0))) + 1 for t in range(len(terms))])
    known = (vectors.join(F.broadcast(examples) if n_examples <= 4 * max_examples else examples, id_col)
             .groupBy(id_col).agg(F.min(F.struct("terms", "counts", "toxic", "stands_for")).alias("own"))
             .select(id_col, "own.*").orderBy(id_col).collect())
    toxic = np.array([r.toxic for r in known], float)
    weight = np.array([r.stands_for for r in known], float)
    base = float(toxic @ weight / weight.sum()) if len(known) else 0.0
    quiet = np.array([not r.terms for r in known], bool)
    silent = float((toxic[quiet] @ weight[quiet] + base) / (weight[quiet].sum() + 1)) if len(known) else 0.0
    model = Model({w: i for i, w in enumerate(terms)}, idf, None, [r[id_col] for r in known],
                  toxic, weight, k, base, silent)
    own = [model.vector(r.terms, r.counts) for r in known]
    model.index = BlockMaxIndex.build(
        len(known), len(terms), np.concatenate([t for t, _ in own]) if own else np.empty(0, np.int64),
        np.repeat(np.arange(len(own)), [len(t) for t, _ in own]).astype(np.int64),
        np.concatenate([w for _, w in own]) if own else np.empty(0))
    loud = np.flatnonzero(~quiet)
    if len(loud):
        shared_raw = spark.sparkContext.broadcast(model)

        def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared_raw.value
            for batch in batches:
                raw = [m.votes(t, c, n)[0] for n, t, c in zip(*(c.to_pylist() for c in batch.columns))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.float64())], ["n", "raw"])

        asked = spark.createDataFrame([(int(i), known[i].terms, known[i].counts) for i in loud],
                                      "n int, terms array<int>, counts array<bigint>")
        got = asked.repartition(spark.sparkContext.defaultParallelism).mapInArrow(leave_one_out, "n int, raw double").collect()
        at = np.array([r.n for r in got])
        model.curve = monotone(np.array([r.raw for r in got]), toxic[at], weight[at])
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType
    evidence = T.ArrayType(T.StructType([T.StructField(id_col, id_type), T.StructField("cosine", T.DoubleType()),
                                         T.StructField("toxic", T.IntegerType())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, why = [], []
            for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                value, near = m.score(t, c)
                scores.append(value)
                why.append([{id_col: m.ids[n], "cosine": s, "toxic": int(m.toxic[n])} for n, s in near[:3]])
            kind = pa.list_(pa.struct([(id_col, batch.schema.field(0).type), ("cosine", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(why, kind)], [id_col, "score", "evidence"])

    return vectors.mapInArrow(score, T.StructType([
        docs.schema[id_col], T.StructField("score", T.DoubleType()), T.StructField("evidence", evidence)]))
