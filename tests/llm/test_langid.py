import zlib

import numpy as np

from curbline.llm import langid, queries

SF = "/root/testdata/sf0.01"


def plain_sum(word, place, table):
    """Sum over every segmentation, by recursion."""
    text = langid.SPACE + word
    size = len(place)

    def rest(i):
        if i == len(text):
            return np.ones(table.shape[1])
        total = 0.0
        for j in range(i + 1, len(text) + 1):
            piece = place.get(text[i:j], size + 1 if j == i + 1 else None)
            if piece is not None:
                total = total + table[piece] * rest(j)
        return total

    return rest(0)


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "aba", langid.SPACE + "a", langid.SPACE, "ba", "bab"]
    rng = np.random.default_rng(3)
    table = np.r_[rng.random((len(pieces), 3)) / 10, np.zeros((1, 3)), np.full((1, 3), 1e-4)]
    lattices = langid.Model(pieces, list("xyz"), table).lattices()
    words = ["a", "ab", "abab", "babab", "zz", "abzab", "aaaaaaa", "babbabab"]
    got = langid.word_logs(lattices, table, words)
    for row, word in zip(got, words):
        assert np.allclose(np.exp(row), plain_sum(word, lattices.place, table))
    for word in words:
        ids = lattices.ids([word])
        assert np.allclose(langid.forward(ids, table)[:, -1], langid.backward(ids, table)[:, 0])
    long = langid.word_logs(lattices, table, ["ab" * 20_000])
    assert np.isfinite(long).all()


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op10_langid(spark, SF).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in held]
    assert np.mean(right) > 0.95, np.mean(right)
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(spark):
    rows = [(1, "the cat and the dog", "en", 1), (2, "der Hund und die Katze", "de", 2), (3, None, "en", 3),
            (4, "12 345 _ ?!", "en", 4), (5, "", None, 5), (None, "und der Hund", "de", 6), (6, "und der Hund", None, 7),
            (6, "und der Hund", None, 7), (7, "the " * 100_000, None, 8), (8, "x" * 50_000, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.learn(docs)
    assert model.langs == ["de", "en"]
    assert np.allclose(model.table.sum(axis=0), 1)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(docs, model).collect()}
    assert got >= {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "de"), (6, "de"), (7, "en")}
    assert langid.identify(docs.limit(0), model).collect() == []
    untaught = langid.learn(docs.where("lang is null"))
    assert {r.lang_pred for r in langid.identify(docs, untaught).collect()} == {"und"}
