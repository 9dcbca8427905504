"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public
vocabulary. A word's probability in a language is the sum over all its
segmentations into pieces, by the forward algorithm; a text's is the product
over its words, so each distinct word of a batch is summed once. The piece
probabilities are learned by expectation maximisation (forward and backward
sums of expected piece counts) on the labelled rows given.

The vocabulary file's path is a parameter. The driver reads it; tasks get the
pieces (bounded by the vocabulary) with the function they run.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.llm.common import forget, only, written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNDETERMINED = "und"
SPACE = "▁"            # word start, as the vocabulary writes it
SMOOTHING = 0.02            # pseudo-count of a piece, per language
CACHE_WORDS = 300_000       # distinct words whose sums a task keeps
LEARN_WORD_CHARS = 40       # longer words are scored, but not learned from
GROUP_WORDS = 4096

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, _WORD.findall(text)))


def read_vocabulary(path: str = VOCABULARY) -> list[str]:
    """Ordinary pieces of a sentencepiece model, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = (i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return list(dict.fromkeys(model.id_to_piece(i) for i in kept))


_MIX = np.uint64(0x9E3779B97F4A7C15)     # odd multiplier (golden ratio) of the rolling hash
_SLOT_BITS = 18


class Lattices:
    """Piece ids of words of one length: ids[w, j, k] ends at j, k+1 characters long.

    Row ``size`` of a probability table is zero (no such piece), row
    ``size + 1`` stands for a single character outside the vocabulary. Pieces
    are looked up for many substrings at once: a rolling 64-bit hash of each
    substring and an open-addressing table of the pieces' (distinct) hashes.
    """

    def __init__(self, place: dict[str, int], longest: int):
        self.place, self.longest, self.size = place, longest, len(place)
        bits = max(_SLOT_BITS, (4 * len(place)).bit_length())
        self._shift, self._last = np.uint64(64 - bits), (1 << bits) - 1
        self._slot = np.full(1 << bits, self.size, np.int32)
        self._hash = np.zeros(self.size + 1, np.uint64)
        for piece, number in place.items():
            h = np.zeros(1, np.uint64)
            for c in piece:
                h = (h + np.uint64(ord(c))) * _MIX
            self._hash[number] = h[0]
            at = int(h[0] >> self._shift)
            while self._slot[at] != self.size:
                at = (at + 1) & self._last
            self._slot[at] = number
        if len(np.unique(self._hash[:-1])) != self.size:
            raise ValueError("two pieces share a hash; choose another multiplier")

    def _find(self, h: np.ndarray) -> np.ndarray:
        at = (h >> self._shift).astype(np.int64)
        found = self._slot[at]
        open_ = np.nonzero((found != self.size) & (self._hash[found] != h))
        while len(open_[0]):
            at[open_] = (at[open_] + 1) & self._last
            found[open_] = self._slot[at[open_]]
            still = (found[open_] != self.size) & (self._hash[found[open_]] != h[open_])
            open_ = tuple(x[still] for x in open_)
        return found

    def ids(self, words: list[str]) -> np.ndarray:
        n = len(words[0]) + 1
        chars = np.empty((len(words), n), np.uint64)
        chars[:, 0] = ord(SPACE)
        chars[:, 1:] = np.array(words).view(np.uint32).reshape(len(words), n - 1)
        out = np.full((len(words), n + 1, self.longest), self.size, np.int32)
        h = np.zeros((len(words), n), np.uint64)
        for k in range(1, min(n, self.longest) + 1):
            h = (h[:, :n + 1 - k] + chars[:, k - 1:]) * _MIX
            out[:, k:, k - 1] = self._find(h)
        single = out[:, 1:, 0]
        single[single == self.size] = self.size + 1
        return out


def forward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """log of the summed probability of each prefix: (words, length + 1, languages)."""
    w, n, m = ids.shape
    logs = np.zeros((w, n, table.shape[1]))
    for j in range(1, n):
        total = 0.0
        for k in range(1, min(j, m) + 1):
            p = table[ids[:, j, k - 1]]
            total = total + (p if k == 1 else p * np.exp(logs[:, j - k] - logs[:, j - 1]))
        logs[:, j] = logs[:, j - 1] + np.log(total)
    return logs


def backward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """log of the summed probability of each suffix, same shape as ``forward``."""
    w, n, m = ids.shape
    logs = np.zeros((w, n, table.shape[1]))
    for i in range(n - 2, -1, -1):
        total = 0.0
        for k in range(1, min(n - 1 - i, m) + 1):
            p = table[ids[:, i + k, k - 1]]
            total = total + (p if k == 1 else p * np.exp(logs[:, i + k] - logs[:, i + 1]))
        logs[:, i] = logs[:, i + 1] + np.log(total)
    return logs


def _by_length(words: list[str]) -> Iterator[list[int]]:
    """Positions of words of equal length, at most so many that a group stays small."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    start = 0
    while start < len(order):
        n = len(words[order[start]])
        most = max(1, GROUP_WORDS * 16 // max(16, n))
        end = start
        while end < len(order) and end - start < most and len(words[order[end]]) == n:
            end += 1
        yield order[start:end]
        start = end


@dataclass
class Model:
    pieces: list[str]
    langs: list[str]
    table: np.ndarray           # (pieces + 2, languages)

    def lattices(self) -> Lattices:
        return Lattices({p: i for i, p in enumerate(self.pieces)}, max(map(len, self.pieces), default=1))


def word_logs(lattices: Lattices, table: np.ndarray, words: list[str]) -> np.ndarray:
    """log P(word | language) for each word, all segmentations summed."""
    out = np.empty((len(words), table.shape[1]))
    for at in _by_length(words):
        group = [words[i] for i in at]
        out[at] = forward(lattices.ids(group), table)[:, -1]
    return out


# --- learning ---------------------------------------------------------------

def labelled_sample(docs: DataFrame, id_col: str, lang_col: str, max_docs: int) -> tuple[DataFrame, list[str]]:
    """About ``max_docs`` documents of each language, chosen by a hash of the id.

    One pass over ids and labels counts the languages (few rows); the sample
    is a filter, so no text moves.
    """
    counts = {r[0]: r[1] for r in docs.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()}
    langs = sorted(counts)
    if not langs:
        return docs.limit(0), langs
    share = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, max_docs / counts[lang])))])
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_000)) / 1_000_000
    return docs.where(F.col(lang_col).isNotNull() & (place < share[F.col(lang_col)])), langs


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          vocabulary: str = VOCABULARY, max_docs: int = 1500, rounds: int = 2) -> Model:
    """Piece probabilities per language from the rows given.

    ``max_docs`` bounds the labelled documents per language that are learned
    from (about; chosen by a hash of the id). Rows with a null label or text
    teach nothing. The driver receives one number per piece and language.
    """
    pieces = read_vocabulary(vocabulary)
    chosen, langs = labelled_sample(only(docs, [id_col, text_col, lang_col]), id_col, lang_col, max_docs)
    size, n_langs = len(pieces), len(langs)
    table = np.full((size + 2, n_langs), 1.0 / (size + 1))
    table[size] = 0.0
    if not langs:
        return Model(pieces, langs, table)
    number = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(words_of(text or "")).items():
                    if len(word) <= LEARN_WORD_CHARS:
                        seen[number[lang], word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    words = written(chosen.select(text_col, lang_col).mapInArrow(count, "lang int, word string, n bigint")
                    .groupBy("word", "lang").agg(F.sum("n").alias("n")), "langid-words")
    for _ in range(rounds):
        current = table

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattices = Model(pieces, langs, current).lattices()
            sums = np.zeros_like(current)
            for batch in batches:
                lang = np.asarray(batch.column(0))
                text = batch.column(1).to_pylist()
                n = np.asarray(batch.column(2)).astype(float)
                for at in _by_length(text):
                    ids = lattices.ids([text[i] for i in at])
                    pick = lang[at]
                    for x in np.unique(pick):
                        mine = np.flatnonzero(pick == x)
                        own = ids[mine]
                        p = current[:, x:x + 1]
                        ahead, behind = forward(own, p)[..., 0], backward(own, p)[..., 0]
                        weight = n[at][mine]
                        for j in range(1, own.shape[1]):
                            for k in range(1, min(j, own.shape[2]) + 1):
                                piece = own[:, j, k - 1]
                                share = np.exp(ahead[:, j - k] + behind[:, j] - ahead[:, -1]) * current[piece, x]
                                np.add.at(sums[:, x], piece, share * weight)
            piece, lang = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(sums[piece, lang])],
                ["piece", "lang", "n"])

        got = (words.select("lang", "word", "n").mapInArrow(expect, "piece int, lang int, n double")
               .groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect())
        counts = np.full((size + 2, n_langs), SMOOTHING)
        for r in got:
            counts[r.piece, r.lang] += r.n
        counts[size] = 0.0
        table = counts / counts.sum(axis=0)
    forget(words)
    return Model(pieces, langs, table)


# --- scoring ----------------------------------------------------------------

def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ``lang_pred``, ``score``) per row, over the whole text.

    ``score`` is the predicted language's share among all learned ones at equal
    priors. A text that is null or has no letter, and every text if nothing was
    learned, gives ``und`` and 0.0; equal languages give the alphabetically
    first. Rows are scored one by one, ids may repeat or be null, and columns
    other than the two named are not looked at.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        lattices, langs = own.lattices(), own.langs
        place: dict[str, int] = {}
        rows = np.empty((0, len(langs)))
        for batch in batches:
            preds, scores = [], []
            for lo in range(0, batch.num_rows, 256):
                texts = batch.column(1).slice(lo, 256).to_pylist()
                split = [words_of(t) if has_letter(t) and langs else [] for t in texts]
                new = list({w for ws in split for w in ws} - place.keys())
                if len(place) + len(new) > CACHE_WORDS:
                    place, rows = {}, rows[:0]
                    new = list({w for ws in split for w in ws})
                if new:
                    place.update(zip(new, range(len(rows), len(rows) + len(new))))
                    rows = np.concatenate([rows, word_logs(lattices, own.table, new)])
                for ws in split:
                    if not ws:
                        preds.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    total = rows[[place[w] for w in ws]].sum(axis=0)
                    best = int(total.argmax())
                    preds.append(langs[best])
                    scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                [id_col, "lang_pred", "score"])

    schema = T.StructType([docs.schema[id_col], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return only(docs, [id_col, text_col]).mapInArrow(run, schema)
