import random

import numpy as np

from curbline.llm import decontaminate as dc
from curbline.llm import queries

SF = "/root/testdata/sf0.01"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_bit_parallel_lcs():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randrange(8) for _ in range(rng.randrange(1, 60))]
        b = [rng.randrange(10) for _ in range(rng.randrange(0, 80))]
        assert dc.lcs_length(dc._places(a), len(a), b) == plain_lcs(a, b)


def contained(text, item):
    """Brute force: the item's words stand in the text as they are."""
    return " " + " ".join(item) + " " in " " + " ".join(dc.words_of(text or "")) + " "


def test_every_verbatim_item_is_found_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = {r.item_id: dc.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.share for r in queries.op8_decontaminate(spark, SF).collect()}
    want = {(d.doc_id, i) for d in docs for i, w in items.items() if contained(d.text, w)}
    assert want and want <= set(got), want - set(got)
    text = {d.doc_id: dc.words_of(d.text) for d in docs}
    for d, i in set(got) - want:        # near copies: the words stand there in order
        assert plain_lcs(items[i], text[d]) >= 0.6 * len(items[i])
    print(len(want), len(got))


def test_basis_equals_a_direct_decomposition(spark):
    rng = np.random.default_rng(2)
    rows, dense = [], []
    for i in range(300):
        topic = rng.integers(0, 6)
        words = np.sort(rng.choice(np.arange(topic * 5, topic * 5 + 5), 12)).astype(np.int32)
        pos = np.arange(12, dtype=np.int32)
        rows.append((pos.tobytes(), words.tobytes()))
        dense.append(np.bincount(words, minlength=30))
    weight = rng.random(30) + 0.5
    places = spark.createDataFrame([(bytearray(p), bytearray(w)) for p, w in rows], "pos binary, word binary")
    basis = dc.latent_basis(places, weight, rank=6)
    exact = np.linalg.svd(np.array(dense) * weight, full_matrices=False)[2][:6].T
    assert np.allclose(basis @ basis.T, exact @ exact.T, atol=1e-2)


def bench(spark, extra=()):
    rng = random.Random(1)
    items = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(30)) + ". The answer is " + f"a{i} b{i} c{i}") for i in range(30)]
    return items, spark.createDataFrame(items + list(extra), "item_id long, text string")


def test_paraphrases_and_clean_texts(spark):
    items, table = bench(spark)
    rng = random.Random(2)
    noise = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    words = items[7][1].split()
    edited = [("zz" if i % 6 == 5 else w) for i, w in enumerate(words)]
    rows = [(1, noise(300) + " " + items[3][1] + " " + noise(300)), (2, noise(50) + " " + " ".join(edited) + " " + noise(9)),
            (3, noise(600)), (4, " ".join(sorted(words))), (5, noise(100_000) + " " + items[4][1])]
    got = {(r.doc_id, r.item) for r in dc.find_contamination(spark.createDataFrame(rows, "doc_id long, text string"), table).collect()}
    assert got == {(1, 3), (2, 7), (5, 4)}


def test_recall_of_edited_items(spark):
    """Items of the given benchmark with a share of their words replaced, dropped or swapped, inside given documents."""
    rng = random.Random(11)
    table = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r.item_id, r.text.split()) for r in table.collect() if r.text and len(r.text.split()) >= 8]
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text and len(r.text) > 200]
    clean = [t for t in texts if not any(contained(t, dc.words_of(" ".join(w))) for _, w in items)]
    other = [w for t in rng.sample(clean, 50) for w in t.split()[:100]]
    for share in (0.1, 0.2):
        rows, planted = [], {}
        while len(rows) < 240:
            item, words = items[len(rows) % len(items)]
            words = list(words)
            for at in rng.sample(range(len(words) - 1), round(share * len(words))):
                kind = rng.randrange(3)
                if kind == 0:
                    words[at] = rng.choice(other)
                elif kind == 1:
                    words[at] = ""
                else:
                    words[at], words[at + 1] = words[at + 1], words[at]
            host = rng.choice(clean).split()
            cut = rng.randrange(len(host))
            planted[len(rows)] = item
            rows.append((len(rows), " ".join(host[:cut] + words + host[cut:])))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {(r.doc_id, r.item) for r in dc.find_contamination(docs, table).collect()}
        recall = sum((d, i) in got for d, i in planted.items()) / len(planted)
        print("share edited", share, "recall", recall, "others", len({d for d, i in got if planted[d] != i}))
        assert recall >= 0.9


def test_an_answer_longer_than_a_passage_counts_whole(spark):
    rng = random.Random(5)
    question, answer = [f"q{i}" for i in range(40)], [f"a{i}" for i in range(150)]
    table = spark.createDataFrame([(1, " ".join(question), " ".join(answer))], "item_id long, text string, answer string")
    near = [("zz" if i % 3 == 2 else w) for i, w in enumerate(question)]          # a paraphrase: needs the answer
    noise = [f"n{rng.randrange(2000)}" for _ in range(400)]
    rows = [(1, near + answer), (2, near + answer[:64] + noise), (3, near), (4, question), (5, noise[:90]), (6, answer + near)]
    rows += [(i, noise[i % 300:i % 300 + 20]) for i in range(7, 2000)]        # a corpus in which the item's words are rare
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = {r.doc_id for r in dc.find_contamination(docs, table, answer_col="answer").collect()}
    assert got == {1, 4, 6}


def test_edge_rows(spark):
    items, table = bench(spark, [(77, None), (78, ""), (None, "entirely unheard words stand in this very odd item of ours")])
    rows = [(None, items[0][1], "x"), (1, None, "y"), (2, "", "z"), (3, items[1][1], "q"), (3, items[1][1], "q"),
            (4, "entirely unheard words stand in this very odd item of ours", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item string").selectExpr("*", "1 AS word", "2 AS pos", "3 AS share")
    got = sorted(((r.doc_id, r.item) for r in dc.find_contamination(docs, table).collect()), key=str)
    assert got == sorted([(None, 0), (3, 1), (3, 1), (4, None)], key=str)
    assert dc.find_contamination(docs.limit(0), table).collect() == []
    assert dc.find_contamination(docs, table.limit(0)).collect() == []
    assert dc.find_contamination(docs, table, keep_all=True).count() == len(rows)
