"""Benchmark decontamination by latent semantic retrieval.

1. One pass over the texts keeps, per document, the places of the benchmark's
   words (two packed arrays; all later steps read that table, not the texts).
2. Document frequencies over the whole corpus give the content words (in few
   documents, and at least the ``CONTENT_LEAST`` rarest of every item) and
   their weights. All corpus passages, as TF-IDF rows over these words, form a
   matrix whose leading right singular vectors come from a distributed
   randomised sketch: one pass computes A'(A W) for a random W, and the
   single-pass Nystroem formula turns it into the basis (Tropp et al. 2017).
3. Items (cut into passages of at most ``PASSAGE`` words) and sliding document
   windows of matching size are compared by cosine in that space; windows
   reaching ``min_cosine`` are candidates.
4. A candidate counts if the longest common word subsequence covers
   ``exact_lcs`` of the item's passage, or ``paraphrase_lcs`` of it while
   ``answer_share`` of the item's whole answer, however long, stands around it
   in order as well.

What the driver and each task hold is bounded by the benchmark: its words,
its passages and the (words x rank) basis.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.llm.common import only, written

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.!?\n]+\s*")
WINDOWS = (24, 48, 96)      # words; windows overlap by half
PASSAGE = 64                # longest item passage
CONTENT_SHARE = 0.005       # words in more of the documents are not content words
CONTENT_LEAST = 8           # but a passage's rarest ones always are
RANK, EXTRA = 128, 32
MIN_CONTENT = 3             # content words a window needs (fewer if the passage has fewer)
BLOCK = 4096                # content words projected at a time


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def lcs_length(a_places: dict[int, int], n: int, b: list[int]) -> int:
    """Longest common subsequence, bit-parallel; a_places maps a word to its bits."""
    mask = (1 << n) - 1
    row = mask
    for word in b:
        hit = a_places.get(word)
        if hit:
            common = row & hit
            row = ((row + common) | (row - common)) & mask
    return n - row.bit_count()


@dataclass
class Passage:
    item: object
    words: list[int]
    places: dict[int, int]
    answer: list[int]
    answer_places: dict[int, int]


def _places(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def answer_of(text: str) -> list[str]:
    """The item's last sentence: where its answer stands unless given apart."""
    parts = [words_of(p) for p in _SENTENCE.split(text)]
    return next((p for p in reversed(parts) if p), [])


class Benchmark:
    """The benchmark's words and passages (driver side)."""

    def __init__(self, items: list[tuple[object, str, str | None]]):
        texts = [(item, words_of(text or ""), words_of(answer) if answer else answer_of(text or ""))
                 for item, text, answer in items]
        self.place: dict[str, int] = {}
        self.passages: list[Passage] = []
        for item, words, answer in texts:
            number = [self.place.setdefault(w, len(self.place)) for w in words]
            own = [self.place.setdefault(w, len(self.place)) for w in answer] if words else []
            parts = -(-len(number) // PASSAGE)
            for p in range(parts):
                part = number[p * len(number) // parts:(p + 1) * len(number) // parts]
                self.passages.append(Passage(item, part, _places(part), own, _places(own)))

    def weights(self, seen: np.ndarray, total: int) -> np.ndarray:
        """Inverse document frequency of the content words, 0 for the others."""
        content = np.zeros(len(self.place), bool)
        rare = seen <= CONTENT_SHARE * total
        for p in self.passages:
            words = sorted(set(p.words), key=lambda w: (seen[w], w))
            content[words[:CONTENT_LEAST]] = True
            content[[w for w in words if rare[w]]] = True
        return np.where(content, np.log((1 + total) / (1 + seen)) + 1, 0.0)


def word_places(docs: DataFrame, place: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """(id, ``pos``, ``word``): where benchmark words stand, as packed int32 arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = place.get
        for batch in batches:
            pos, word = [], []
            for text in batch.column(1):
                ids = np.array([get(w, -1) for w in _WORD.findall((text.as_py() or "").lower())], np.int32)
                at = np.flatnonzero(ids >= 0)
                pos.append(at.astype(np.int32).tobytes())
                word.append(ids[at].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pos, pa.binary()), pa.array(word, pa.binary())], [id_col, "pos", "word"])

    schema = T.StructType([docs.schema[id_col], T.StructField("pos", T.BinaryType()),
                           T.StructField("word", T.BinaryType())])
    return only(docs, [id_col, text_col]).mapInArrow(run, schema)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All int32 values packed in a binary column, and where each row's begin (one more at the end)."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(np.int32) if data is not None else np.empty(0, np.int32)
    return values, (ends - ends[0]) // 4


def document_frequency(places: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Documents having each benchmark word, and all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            word, begin = _joined(batch.column(0))
            row = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(begin))
            last = np.full(size, -1, np.int64)
            for lo in range(0, len(word), 1 << 20):
                both = np.unique(row[lo:lo + (1 << 20)] * size + word[lo:lo + (1 << 20)])
                r, w = both // size, both % size
                fresh = last[w] != r            # a row may go on from the part before
                seen += np.bincount(w[fresh], minlength=size)
                last[w] = r
        got = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[got, -1], pa.int32()), pa.array(np.r_[seen[got], rows], pa.int64())],
                                         ["word", "n"])

    found = dict(places.select("word").mapInArrow(run, "word int, n bigint").groupBy("word").agg(F.sum("n")).collect())
    total = found.pop(-1, 0)
    return np.array([found.get(i, 0) for i in range(size)], float), total


def latent_basis(places: DataFrame, weight: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (words x rank) of all corpus passages' TF-IDF rows."""
    own = np.flatnonzero(weight > 0)        # the matrix has content words only
    n = len(own)
    width = min(n, rank + EXTRA)
    if not n:
        return np.zeros((len(weight), 0))
    omega = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0].astype(np.float32)
    column = np.full(len(weight), -1)
    column[own] = np.arange(n)
    step = WINDOWS[1]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixed = (omega.T * weight[own].astype(np.float32)).T
        total = np.zeros((n, width), np.float32)
        for batch in batches:
            pos, begin = _joined(batch.column(0))
            word, _ = _joined(batch.column(1))
            col = column[word]
            mine = np.flatnonzero(col >= 0)
            if not len(mine):
                continue
            doc = np.searchsorted(begin, mine, side="right")
            key = doc.astype(np.int64) << 32 | pos[mine] // step
            row, col = np.cumsum(np.r_[0, key[1:] != key[:-1]]), col[mine]
            lo = 0
            while lo < len(row):                # whole rows, about 65,536 cells at a time
                hi = min(len(row), lo + (1 << 16))
                if hi < len(row):
                    hi = int(np.searchsorted(row, row[hi]))
                    if hi <= lo:
                        hi = int(np.searchsorted(row, row[lo], side="right"))
                r, c = row[lo:hi], col[lo:hi]
                start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                image = np.add.reduceat(mixed[c], start, axis=0)
                spread = np.repeat(image, np.diff(np.r_[start, len(r)]), axis=0)
                order = np.argsort(c, kind="stable")
                first = np.flatnonzero(np.r_[True, c[order][1:] != c[order][:-1]])
                total[c[order][first]] += np.add.reduceat(spread[order], first, axis=0)
                lo = hi
        got = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(got, pa.int32()), pa.array([total[i].tobytes() for i in got], pa.binary())], ["word", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for w, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = np.frombuffer(part.as_buffer(), np.float32).astype(np.float64)
                sums[w] = sums[w] + value if w in sums else value
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["word", "part"])

    kind = "word int, part binary"
    y = np.zeros((n, width))
    for r in places.select("pos", "word").mapInArrow(sketch, kind).repartition("word").mapInArrow(add, kind).collect():
        y[r.word] = np.frombuffer(r.part) * weight[own[r.word]]
    scale = np.linalg.norm(y)
    basis = np.zeros((len(weight), min(width, rank)))
    if not scale:                           # no corpus passage has a content word
        return basis
    nu = 1e-7 * scale
    y = y + nu * omega
    core = omega.T.astype(float) @ y
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    keep = values > 1e-9 * values[-1]
    half = y @ (vectors[:, keep] / np.sqrt(values[keep]))
    left = np.linalg.svd(half, full_matrices=False)[0][:, :rank]
    basis[own, :left.shape[1]] = left
    return basis


def _window_of(n: int) -> int:
    return next((w for w in WINDOWS if w >= n), WINDOWS[-1])


@dataclass
class Searcher:
    """Finds an item's passages in one document's word places."""

    bench: Benchmark
    weight: np.ndarray
    basis: np.ndarray
    min_cosine: float
    exact_lcs: float
    paraphrase_lcs: float
    answer_share: float

    def prepare(self) -> Searcher:
        self.content = self.weight > 0
        self.vectors = (self.basis * self.weight[:, None]).astype(np.float32)
        self.groups = []
        for size in WINDOWS:
            mine = [p for p in self.bench.passages if _window_of(len(p.words)) == size]
            if mine:
                z = np.array([self.vectors[p.words].sum(axis=0) for p in mine], np.float32)
                norm = np.linalg.norm(z, axis=1, keepdims=True)
                least = min(MIN_CONTENT, *(int(self.content[p.words].sum()) for p in mine))
                self.groups.append((size, mine, (z / np.where(norm > 0, norm, 1)).T, max(1, least)))
        return self

    def find(self, pos: np.ndarray, word: np.ndarray) -> list[tuple[Passage, float, int]]:
        """(passage, share found, window start) of every verified window.

        ``pos`` rises over several documents, which lie far enough apart that
        no window reaches from one to the next.
        """
        mine = np.flatnonzero(self.content[word])
        at, content = pos[mine], word[mine]
        out: list[tuple[Passage, float, int]] = []
        for lo in range(0, len(at), BLOCK):
            hi = min(len(at), lo + BLOCK)
            reach = int(np.searchsorted(at, at[hi - 1] + WINDOWS[-1], side="right"))
            sums = np.zeros((reach - lo + 1, self.vectors.shape[1]), np.float32)
            np.cumsum(self.vectors[content[lo:reach]], axis=0, out=sums[1:])
            for size, passages, items, least in self.groups:
                step = size // 2
                cell = at[lo:hi] // step
                starts = np.unique(np.concatenate([cell, cell - 1])) * step
                a = np.maximum(np.searchsorted(at, starts), lo) - lo
                b = np.minimum(np.searchsorted(at, starts + size), reach) - lo
                full = b - a >= least
                if not full.any():
                    continue
                starts, z = starts[full], sums[b[full]] - sums[a[full]]
                norm = np.linalg.norm(z, axis=1, keepdims=True)
                for w, p in zip(*np.nonzero((z / np.maximum(norm, 1e-12)) @ items >= self.min_cosine)):
                    share = self._verify(passages[p], int(starts[w]), size, pos, word)
                    if share:
                        out.append((passages[p], share, int(starts[w])))
        return out

    def _verify(self, passage: Passage, start: int, size: int, pos, word) -> float:
        n = len(passage.words)
        i, j = np.searchsorted(pos, [start - n // 2, start + size + n // 2])
        region = word[i:j].tolist()
        share = lcs_length(passage.places, n, region) / n
        if share < self.paraphrase_lcs:
            return 0.0
        if share < self.exact_lcs:
            m = len(passage.answer)
            if m > n // 2:                      # a long answer reaches further than the passage
                i, j = np.searchsorted(pos, [start - m, start + size + m])
                region = word[i:j].tolist()
            if not m or lcs_length(passage.answer_places, m, region) < self.answer_share * m:
                return 0.0
        return share


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None,
                       min_cosine: float = 0.45, exact_lcs: float = 0.75, paraphrase_lcs: float = 0.6,
                       answer_share: float = 0.75, keep_all: bool = False) -> DataFrame:
    """One row per document row and benchmark item found in it.

    Columns: id, ``item`` (the item's id), ``share`` (of the item's passage),
    ``first_word`` and ``end_word`` of the window. With ``keep_all`` one row per
    document row: id and ``found``, the array of these. Null and empty texts or
    items match nothing, an empty benchmark finds nothing; repeated documents
    are found each time, repeated item ids once per id. Null ids stay null.
    Other columns are not looked at. The benchmark is collected: it is the
    small side by its nature, and the broadcast grows with it alone.
    """
    spark = docs.sparkSession
    wanted = [item_col, item_text_col] + ([answer_col] if answer_col else [])
    items = [(r[0], r[1], r[2] if answer_col else None) for r in only(benchmark, wanted).collect()]
    bench = Benchmark(items)
    places = written(word_places(docs, bench.place, id_col, text_col), "decon-places")
    weight = bench.weights(*document_frequency(places, len(bench.place)))
    basis = latent_basis(places, weight)
    shared = spark.sparkContext.broadcast(
        Searcher(bench, weight, basis, min_cosine, exact_lcs, paraphrase_lcs, answer_share))
    hit = T.StructType([T.StructField("item", benchmark.schema[item_col].dataType), T.StructField("share", T.DoubleType()),
                        T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.prepare()
        kind = pa.list_(pa.struct([("item", item_type), ("share", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())]))
        longest = max((len(p.answer) for p in own.bench.passages), default=0)
        apart, passage_reach = 4 * WINDOWS[-1] + longest, WINDOWS[-1]
        for batch in batches:
            pos, begin = _joined(batch.column(1))
            word, _ = _joined(batch.column(2))
            sizes = np.diff(begin)
            last = np.where(sizes > 0, pos[np.maximum(begin[1:] - 1, 0)] if len(pos) else 0, 0)
            base = np.cumsum(last + apart, dtype=np.int64) - last       # where each document begins
            found: list[dict] = [{} for _ in range(batch.num_rows)]
            for passage, share, start in own.find(pos + np.repeat(base, sizes), word):
                row = int(np.searchsorted(base, start + passage_reach, side="right")) - 1
                if share > found[row].get(passage.item, (0.0,))[0]:
                    first = max(0, start - int(base[row]))
                    found[row][passage.item] = (share, first, first + _window_of(len(passage.words)))
            rows = [[{"item": k, "share": v[0], "first_word": v[1], "end_word": v[2]} for k, v in f.items()] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], [id_col, "found"])

    from pyspark.sql.pandas.types import to_arrow_type
    item_type = to_arrow_type(hit["item"].dataType)
    found = places.mapInArrow(search, T.StructType([docs.schema[id_col], T.StructField("found", T.ArrayType(hit))]))
    if keep_all:
        return found
    return found.select(F.col(id_col), F.explode("found").alias("hit")).select(id_col, "hit.*")
