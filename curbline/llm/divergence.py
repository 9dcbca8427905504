"""How far the sources of a language differ in their words.

1. Tokenizer: ``bytes.translate`` lowers A-Z and blanks every other ASCII byte
   that is no letter in one pass over the UTF-8 text, ``bytes.split`` cuts the
   words (bytes of 0x80 and more belong to words), a ``Counter`` per document
   gives its frequencies and, by its keys, the documents a word is in.
2. Sparse aggregation: a task adds the counters of its documents up per
   (language, source), hands them on when ``MOST_HELD`` words are held, and
   Spark sums the rows: no text is shuffled, and a hot source is a row per word
   and task.
3. Divergence of two smoothed distributions, in whole numbers: a word's share is
   p = 1 + floor(10^9 (count + 2) / (N + 2 V)), two shares differ by
   f = floor((p - q)^2 / (p + q)). Words that a source lacks all have one share,
   so a pair of sources needs the words both have (one join on the word), and
   for each side how many of its words have which count.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import forget, only, sized_broadcast, written

MOST_HELD = 200_000     # words held by a task before their counts are handed on
PIECE = 1 << 20         # bytes of a text that are split at a time
PER_SALT = 1_000        # groups of a language whose pairs one key holds at most, on average
SCALE = 1_000_000_000

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b in _LETTERS else 32 for b in range(256))


def word_counts(text: bytes) -> Counter:
    """Frequencies of a UTF-8 text's words (bytes, A-Z lowered)."""
    blanked = text.translate(WORD_BYTES)
    if len(blanked) <= PIECE:
        return Counter(blanked.split())
    found: Counter = Counter()
    at = 0
    while at < len(blanked):
        end = blanked.find(b" ", at + PIECE)
        end = len(blanked) if end < 0 else end
        found.update(blanked[at:end].split())
        at = end
    return found


_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                      ("n", pa.int64()), ("docs", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict = defaultdict(Counter)
    docs: dict = defaultdict(Counter)

    def rows() -> pa.RecordBatch:
        cols: tuple = ([], [], [], [], [])
        for (lang, source), counts in words.items():
            own = docs[lang, source]
            cols[0].extend([lang] * len(counts))
            cols[1].extend([source] * len(counts))
            cols[2].extend(w.decode() for w in counts)
            cols[3].extend(counts.values())
            cols[4].extend(own[w] for w in counts)
        words.clear()
        docs.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _COUNTED)], schema=_COUNTED)

    held = 0
    for batch in batches:
        lang, source, text = (batch.column(i) for i in range(3))
        for where, t in zip(zip(lang.to_pylist(), source.to_pylist()), text.cast(pa.binary())):
            own = word_counts(t.as_buffer().to_pybytes())
            group, seen = words[where], docs[where]
            held -= len(group)
            group.update(own)
            seen.update(own.keys())
            held += len(group)
            if held > MOST_HELD:
                yield rows()
                held = 0
    if words:
        yield rows()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n``, ``docs``): occurrences, and documents with the term, per group."""
    filled = only(docs, [lang_col, source_col, text_col]).toDF("lang", "source", "text").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return (filled.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(count: Column, total: Column, words: Column) -> Column:
    """p of a word counted so often; the product may pass 64 bits."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(words > 0, 1 + F.call_function("div", wide, (total + 2 * words).cast("decimal(20,0)")))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence_tables(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      min_docs: int = 10) -> tuple[DataFrame, DataFrame]:
    """(kept words per group, groups).

    words: ``lang``, ``source``, ``term``, ``n``, ``p`` (the group's share), ``q``
    (the language's share). groups: ``lang``, ``source``, ``total`` (occurrences of
    kept words), ``present`` (kept words it has), ``words`` (those the language
    keeps), ``p0`` (share of a word it lacks; null where nothing is kept).
    """
    counts = written(term_counts(docs, lang_col, source_col, text_col), "divergence-counts")
    kept = written(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                   .where(F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("words"), F.sum("lang_n").alias("lang_total"))
    own = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-own")
    occurring = only(docs, [lang_col, source_col]).toDF("lang", "source").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    groups = written(
        occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "present", "words", "lang_total")])
        .withColumn("p0", _share(F.lit(0).cast("long"), F.col("total"), F.col("words"))), "divergence-groups")
    small = sized_broadcast(groups, groups.count(), 256)
    words = own.join(small, ["lang", "source"]).select(
        "lang", "source", "term", "n", _share(F.col("n"), F.col("total"), F.col("words")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("words")).alias("q"))
    words = written(words, "divergence-words")
    for table in (counts, kept, own):
        forget(table)
    return words, groups


def _salted(rows: DataFrame, salts: int, all_of_them: bool) -> DataFrame:
    """Each row under one salt by its source, or under all."""
    if all_of_them:
        return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(salts)).cast("int"))


def source_pairs(words: DataFrame, groups: DataFrame) -> DataFrame:
    """(``lang``, ``source``, ``other``, ``value``) of every two sources of a language, both ways.

    f is 0 between equal shares and the same both ways, so it is summed for
    source < other only: over the words of either side as if the other lacked
    them, over the words both lack, and corrected at the words both have.
    """
    n_groups = groups.count()
    salts = max(1, -(-n_groups // PER_SALT))
    mine = groups.select("lang", "source", "present", "words", "p0")

    def sides(rows: DataFrame, keys: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
        left = _salted(rows, salts, False).select("salt", *keys, F.col("source"), *[F.col(c).alias(f"{c}_a") for c in columns])
        right = _salted(rows, salts, True).select("salt", *keys, F.col("source").alias("other"), *[F.col(c).alias(f"{c}_b") for c in columns])
        return left, right

    small = sized_broadcast(mine, n_groups, 256)
    have = words.join(small, ["lang", "source"]).select("lang", "source", "term", "p", "p0")
    a, b = sides(have, ["lang", "term"], ["p", "p0"])
    p, q, p0, q0 = F.col("p_a"), F.col("p_b"), F.col("p0_a"), F.col("p0_b")
    both = (a.join(b, ["salt", "lang", "term"]).where("source < other")
            .select("lang", "source", "other", (_apart(p, q) - _apart(p, q0) - _apart(p0, q) + _apart(p0, q0)).alias("v")))

    # words of one side by share: a share seen m times counts m times
    shares = words.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    x = _salted(shares, salts, False)
    y = _salted(mine, salts, True).select("salt", "lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    y = sized_broadcast(y, n_groups * salts, 128)
    alone = (x.join(y, ["salt", "lang"]).where("source <> other")
             .select("lang", F.least("source", "other").alias("source"), F.greatest("source", "other").alias("other"),
                     (F.col("m") * _apart(F.col("p"), F.col("q0"))).alias("v")))

    a, b = sides(mine, ["lang"], ["words", "present", "p0"])
    b = sized_broadcast(b, n_groups * salts, 128)
    lacked = a.join(b, ["salt", "lang"]).where("source < other").select(
        "lang", "source", "other",
        F.coalesce((F.col("words_a") - F.col("present_a") - F.col("present_b")) * _apart(p0, q0), F.lit(0).cast("long")).alias("v"))
    summed = both.union(alone).union(lacked).groupBy("lang", "source", "other").agg(F.sum("v").alias("value"))
    return summed.union(summed.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      min_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """(``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``) for every (language, source) of ``docs``.

    Part ``pair``: every other source of the language with the divergence summed
    over the language's kept words (those in ``min_docs`` documents; 0 where none
    is kept). Part ``term``: the group's own ``top_terms`` words whose share is over the
    language's, by divergence from it. Ranks from 1, value descending, then
    item by its UTF-8 bytes.

    A null text, language or source counts as ''. Empty texts make a group
    without words. Repeated rows count each. Very long texts are split piece by
    piece. An empty table gives no rows; other columns are not looked at.
    """
    words, groups = divergence_tables(docs, lang_col, source_col, text_col, min_docs)
    pairs = written(source_pairs(words, groups), "divergence-pairs").select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    terms = words.where("n > 0 AND p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    # ranked apart: the words' rank limit then works before their shuffle
    ranked = pairs.withColumn("rank", place).union(terms.withColumn("rank", place).where(F.col("rank") <= top_terms))
    return ranked.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
