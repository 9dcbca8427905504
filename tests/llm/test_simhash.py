import re

import numpy as np
import xxhash

from curbline.llm import simhash

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, distance=4):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    v = np.array(fps, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= distance):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[find(i)] = min(x, low.get(find(i), x))
    return [low.get(find(i)) for i in range(len(ids))]


def check(spark, rows, schema="doc_id long, text string", **options):
    docs = spark.createDataFrame(rows, schema)
    got = simhash.simhash_groups(docs, **options).collect()
    fps = [plain_fingerprint(r.text) for r in docs.collect()]
    ids = [r.doc_id for r in docs.collect()]
    want = sorted(zip(ids, fps, plain_components(ids, fps)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want
    return got


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in docs.collect()])


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (5, "a B"), (None, "a b"), (None, "only null ids here x"),
            (6, long), (7, long + " end"), (8, "École École École École École"), (9, "a b c d e")]
    got = check(spark, rows)
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.fp == 0} == {1}


def test_empty_table_and_clashing_columns(spark):
    assert check(spark, []) == []
    rows = [(2, "one two three four five", 7, 8, 9, 1), (1, "one two three four five", 7, 8, 9, 1)]
    check(spark, rows, "doc_id long, text string, fp long, a long, b long, component long")


def test_dense_group_with_slices(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = [int(b) for b in base]
    for b in base[:4]:
        for _ in range(300):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            fps.append(int(b) ^ sum(1 << int(f) for f in flips))
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = plain_components(list(range(len(fps))), fps)
    for rows in (20_000, 50):
        links = simhash.fingerprint_links(nodes, 4, rows).collect()
        place = {f: i for i, f in enumerate(signed)}
        for r in links:
            pass
        label = simhash.forest(len(fps), np.array([place[r.a] for r in links]), np.array([place[r.b] for r in links]))
        assert label.tolist() == want
        assert len(links) <= 15 * len(fps) * (1 if rows > 50 else 40)


def test_index_prunes_but_loses_nothing():
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 14, 3000, dtype=np.uint64))
    fp = fp[np.argsort(simhash.gray_rank(fp))]
    a, b = simhash.near_links(np.zeros(len(fp), int), fp, 1)
    assert (np.bitwise_count(fp[a] ^ fp[b]) <= 1).all()
    want = plain_components(list(range(len(fp))), fp.tolist(), 1)
    assert simhash.forest(len(fp), a, b).tolist() == want
