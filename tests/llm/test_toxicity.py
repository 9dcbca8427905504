import zlib

import numpy as np

from curbline.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def random_index(rng, n=500, n_terms=40):
    term, example, weight, rows = [], [], [], []
    for i in range(n):
        t = np.sort(rng.choice(n_terms, rng.integers(0, 6), replace=False))
        w = rng.choice([0.5, 1.0, 2.0], len(t))
        w = w / np.sqrt((w * w).sum()) if len(t) else w
        rows.append(dict(zip(t.tolist(), w.tolist())))
        term += t.tolist()
        example += [i] * len(t)
        weight += w.tolist()
    return rows, toxicity.BlockMaxIndex.build(n, n_terms, np.array(term), np.array(example), np.array(weight))


def test_block_max_search_is_exact():
    rng = np.random.default_rng(7)
    rows, index = random_index(rng)
    for _ in range(200):
        t = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        q = rng.random(len(t))
        q /= np.sqrt((q * q).sum())
        sims = np.array([sum(q[j] * r.get(int(x), 0.0) for j, x in enumerate(t)) for r in rows])
        want = [i for i in sorted(range(len(rows)), key=lambda i: (-round(sims[i], 9), i)) if sims[i] > 0][:10]
        got, s = index.nearest(t, q, 10)
        assert got.tolist() == want
        assert np.allclose(s, sims[want])


def test_monotone_fit():
    x = np.array([1.0, 2, 3, 4, 5])
    points, values = toxicity.monotone(x, np.array([0.0, 1, 0, 1, 1]), np.ones(5))
    assert (np.diff(values) > 0).all() and np.isclose(np.interp(2.5, points, values), 0.5)


def test_query_separates_the_labels(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op7_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    print("auc", auc, len(pos), len(neg))
    assert auc > 0.6


def toy(spark):
    rows = [(i, ("you stupid moron " if i % 4 == 0 else "a calm note ") + f"word{i} word{i + 1}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    return docs, labels


def test_held_out_toy(spark):
    docs, labels = toy(spark)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels.where("doc_id < 120")).collect()}
    assert all((got[i].score >= 0.7) == (i % 4 == 0) for i in range(120, 200))
    assert all(e.toxic for e in got[160].evidence) and len(got[160].evidence) == 3


def test_one_id_with_several_texts_is_the_same_example_in_every_order(spark):
    docs, labels = toy(spark)
    again = docs.where("doc_id % 5 = 0").selectExpr("doc_id", "concat('moron moron note ', text) AS text")
    runs = [sorted((str(r.doc_id), r.score, str(r.evidence)) for r in toxicity.score_toxicity(d, labels).collect())
            for d in (docs.union(again).repartition(3), again.union(docs).repartition(7, "text"))]
    assert runs[0] == runs[1]


def test_edge_rows(spark):
    docs, labels = toy(spark)
    odd = spark.createDataFrame([(None, "stupid moron"), (500, None), (501, ""), (502, "moron " * 100_000), (0, "moron"), (0, "moron")],
                                docs.schema)
    more = docs.union(odd).selectExpr("doc_id", "text", "1 AS score", "2 AS terms", "3 AS toxic", "4 AS counts")
    twice = labels.union(labels).union(spark.createDataFrame([(None, 1), (3, None)], labels.schema)).selectExpr(
        "doc_id", "toxic", "'x' AS text", "1 AS stands_for")
    got = toxicity.score_toxicity(more, twice).collect()
    assert len(got) == 206
    by = {r.doc_id: r.score for r in got}
    assert by[None] > 0.7 and by[502] > 0.7 and by[500] == by[501] < 0.3
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
