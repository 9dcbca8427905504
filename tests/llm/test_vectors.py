import numpy as np

from curbline.llm import queries, vectors

SF = "/root/testdata/sf0.01"


def brute(ids, v, asked, k):
    out = []
    for q in asked:
        d = np.sqrt(((v - v[ids.index(q)]) ** 2).sum(axis=1))
        near = sorted((x, i) for x, i in zip(d.tolist(), ids) if i != q)[:k]
        out += [(q, n + 1, i, x) for n, (x, i) in enumerate(near)]
    return out


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = brute(ids, v, sorted(i for i in ids if i % 100 == 0), 10)
    got = sorted(tuple(r) for r in queries.op9_vectors(spark, SF).collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-14)


def test_bounds_hold_and_spare_most_distances():
    rng = np.random.default_rng(0)
    v = rng.standard_normal((6000, 64)) + 3
    code, norm, along = vectors.encode(v, v.mean(axis=0), vectors.rotation(64))
    assert code.shape == (6000, 8)
    s = vectors.Searcher(np.arange(20), v[:20], v.mean(axis=0), 10)
    low, high = s.bounds(code, norm, along)
    exact = ((v[:20, None] - v) ** 2).sum(axis=2)
    assert np.mean((low <= exact) & (exact <= high)) > 0.999
    taken = sum(s.add(np.arange(lo, lo + 1500), code[lo:lo + 1500], norm[lo:lo + 1500], along[lo:lo + 1500], v[lo:lo + 1500])
                for lo in range(0, 6000, 1500))
    want = np.array([[x[2] for x in brute(list(range(6000)), v, [q], 10)] for q in range(20)])
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(s.near_id, want)]) >= 0.99
    assert taken < 20 * 6000


def search(spark, rows, asked, k=3, schema="vec_id long, embedding array<float>"):
    index = vectors.build_index(spark.createDataFrame(rows, schema))
    return sorted(tuple(r) for r in vectors.nearest(index, index.where(asked).select("vec_id", "v"), k).collect())


def test_edge_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (9, [4.0, 4.0]), (10, [])]
    assert search(spark, rows, "vec_id = 0") == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 2, 0.0)]
    assert search(spark, rows, "vec_id = 2") == [(2, 1, 0, 0.0), (2, 2, 1, 0.0), (2, 3, 9, 5.0)]
    assert search(spark, rows[:1], "vec_id = 0") == []
    assert search(spark, [], "vec_id = 0") == []
    assert search(spark, [(0, [2.0]), (1, [5.0]), (2, [3.0])], "vec_id = 0") == [(0, 1, 2, 1.0), (0, 2, 1, 3.0)]
    monkeypatch.setattr(vectors, "QUERY_BLOCK_BYTES", 16)     # one query a block
    many = [(i, [float(i), 1.0]) for i in range(12)]
    got = search(spark, many, "vec_id % 4 = 0", 2)
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 2.0), (4, 1, 3, 1.0), (4, 2, 5, 1.0), (8, 1, 7, 1.0), (8, 2, 9, 1.0)]
    clash = search(spark, [(0, [1.0, 1.0], 1, b"x"), (1, [1.0, 2.0], 2, b"y")], "vec_id = 0", 3, "vec_id long, embedding array<float>, norm int, code binary")
    assert clash == [(0, 1, 1, 1.0)]
