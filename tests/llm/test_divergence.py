import random
import re
from collections import Counter, defaultdict

from curbline.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, min_docs):
    """The contract, word by word and group by group."""
    groups, docs, totals = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(found.keys())
    kept = {lang: [t for t, n in c.items() if n >= min_docs] for lang, c in docs.items()}
    for (lang, _), c in groups.items():
        totals[lang].update(c)

    def shares(c, lang):
        n, v = sum(c[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept[lang]}

    out = []
    for (lang, source), c in groups.items():
        p, q = shares(c, lang), shares(totals[lang], lang)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(s, sum(f(p[t], x) for t, x in shares(o, lang).items())) for (g, s), o in groups.items() if g == lang and s != source]
        terms = [(t, f(p[t], q[t])) for t in kept[lang] if c[t] and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, i) for i, (t, v) in enumerate(items, 1) if part == "pair" or i <= 10]
    return sorted(out)


def got(spark, rows, **more):
    found = divergence.source_divergence(spark.createDataFrame(rows, SCHEMA), **more).collect()
    assert found == [] or list(found[0].asDict()) == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found)


def made(seed, n, sources):
    rng = random.Random(seed)
    words = ["Ab", "ab", "x", "ÄÖ", "äö", "日本", "don't", "A1b", "É", "é", " y", "z\u0085", "٣"] + [f"w{c}" for c in "abcdefghij"]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(0, 30))), rng.choice(["en", "fr"]), rng.choice(sources)) for i in range(n)]


def test_words_are_the_contracts():
    for text in ("", "A\x00b\x7fC ÀÉ_x", "İK ſ", "a" * 10, "1 2 3", "x y z\u0085", "a\tb\nc@[`{d"):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        assert divergence.word_counts(text.encode()) == Counter(
            t.encode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))


def test_long_texts_are_split_piece_by_piece(monkeypatch):
    text = ("word Other éé " * 3000 + "z" * 5000 + " end").encode()
    whole = divergence.word_counts(text)
    monkeypatch.setattr(divergence, "PIECE", 64)
    assert divergence.word_counts(text) == whole == Counter({b"word": 3000, b"other": 3000, "éé".encode(): 3000, b"z" * 5000: 1, b"end": 1})


def test_against_brute_force(spark):
    rows = made(1, 300, ["s1", "s2", "s3", "hot", "hot", "hot"])
    assert got(spark, rows) == plain(rows, 10)
    assert got(spark, rows, min_docs=90) == plain(rows, 90)


def test_salts_and_early_hand_on_change_nothing(spark, monkeypatch):
    rows = made(2, 200, [f"s{i}" for i in range(12)])
    monkeypatch.setattr(divergence, "PER_SALT", 5)
    assert got(spark, rows, min_docs=5) == plain(rows, 5)


def test_hand_on_in_one_task():
    import pyarrow as pa
    rows = made(3, 60, ["s", "t"])
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in (2, 3, 1)], ["lang", "source", "text"])
    summed = []
    for held in (200_000, 3):
        old, divergence.MOST_HELD = divergence.MOST_HELD, held
        try:
            total = defaultdict(lambda: [0, 0])
            for out in divergence._counted(iter([batch])):
                for r in out.to_pylist():
                    total[r["lang"], r["source"], r["term"]][0] += r["n"]
                    total[r["lang"], r["source"], r["term"]][1] += r["docs"]
            summed.append(dict(total))
        finally:
            divergence.MOST_HELD = old
    assert summed[0] == summed[1]


def test_edge_rows(spark):
    rows = [(None, None, None, None), (1, "", "en", None), (2, "only once here", "en", "a"), (2, "only once here", "en", "a"),
            (3, "1 2 3", "en", "b"), (4, "x " * 50_000, "en", "b")]
    assert got(spark, rows) == plain(rows, 10)              # nothing kept: pairs of value 0
    assert got(spark, rows, min_docs=1) == plain(rows, 1)
    assert got(spark, []) == []
    clash = spark.createDataFrame([(1, "a b", "en", "s", "t", 5, 2)], SCHEMA + ", term string, n int, docs int")
    assert [tuple(r) for r in divergence.source_divergence(clash, min_docs=1).collect()] == []
    same = [(i, f"a a b {'c' * (i % 2)}", "en", "s1") for i in range(20)] + [(i, "a b b", "en", "s2") for i in range(20)]
    assert got(spark, same) == plain(same, 10)
