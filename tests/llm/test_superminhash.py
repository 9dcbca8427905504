import random

import numpy as np
import pytest

from curbline.llm import superminhash as sm

SF = "/root/testdata/sf0.01"


def plain_set(text, width=5):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(b" ".join(words[i:i + width]) for i in range(len(words) - width + 1))


def plain(rows, percent=85):
    """(id, set size, component, kept) by comparing all texts that share a shingle."""
    sets = [plain_set(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in holders[g]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i)), d is not None and low.get(find(i)) == d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(spark, rows, **more):
    found = sm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect()
    return sorted((tuple(r) for r in found), key=str)


def sequential(elements, slots):
    """SuperMinHash one element and one step at a time, without early stopping."""
    best = [1 << 64] * slots
    for x in elements:
        p = list(range(slots))
        for j in range(slots):
            z = int(sm._mixed(np.array([(int(x) + sm._GOLDEN * (j + 1)) % 2**64], np.uint64))[0])
            w = int(sm._mixed(np.array([z], np.uint64) ^ sm._STEP)[0])
            k = j + ((w >> 32) * (slots - j) >> 32)
            p[j], p[k] = p[k], p[j]
            best[p[j]] = min(best[p[j]], (j << 53) | (z >> 11))
    return best


@pytest.mark.parametrize("n", [1, 2, 7, 60, 700])
def test_signature_equals_the_sequential_one(n, monkeypatch):
    x = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    monkeypatch.setattr(sm, "BLOCK", 64)        # blocks change nothing
    assert sm.signature(x, 31).tolist() == sequential(x, 31)


def test_estimate_is_unbiased_with_lower_variance():
    rng = np.random.default_rng(5)
    off, few = [], []
    for _ in range(300):
        x = rng.integers(0, 2**63, 115).astype(np.uint64)       # 100 common, 15 differ: 0.87
        a, b = sm.signature(x[:107]), sm.signature(np.r_[x[:100], x[107:]])
        off.append((a == b).mean() - 100 / 115)
        few.append((sm.band_hashes(a) == sm.band_hashes(b)).any())
    assert abs(np.mean(off)) < 0.01 and np.var(off) < (100 / 115) * (15 / 115) / sm.SLOTS
    assert all(few)


def test_no_pair_at_the_similarity_is_lost():
    rng = np.random.default_rng(6)
    for n in (6, 12, 17, 40, 200, 900):
        limit = sm.most_apart(85)
        for _ in range(200):
            d = n - -(-n * 85 // 100)
            x = rng.integers(0, 2**63, n).astype(np.uint64)
            a, b = sm.signature(x), sm.signature(x[:n - d])
            assert (sm.band_hashes(a) == sm.band_hashes(b)).any()
            assert np.bitwise_count((sm.sketch(a) ^ sm.sketch(b)).view(np.uint64)).sum() <= limit


def test_whole_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(spark, rows) == plain(rows)


def near_copies(n_copies=300, length=120):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    base = [word() for _ in range(length)]
    copies = []
    for _ in range(n_copies):
        own = list(base)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(length)] = word()
        copies.append(" ".join(own))
    half = [" ".join(base[:length * 7 // 10] + [word() for _ in range(length * 3 // 10)]) for _ in range(80)]
    chain, own = [], list(base)
    for i in range(60):         # each links with the next, the ends do not link
        own[i * 2 % length] = word()
        chain.append(" ".join(own))
    return copies + half + chain


def test_near_copies_passages_and_chains(spark, monkeypatch):
    texts = near_copies()
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    assert got(spark, rows) == plain(rows)
    monkeypatch.setattr(sm, "SMALL", 2)         # representatives and rare shingles do it all
    monkeypatch.setattr(sm, "ORDERS", 1)
    assert got(spark, rows) == plain(rows)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (None, "one two"),
            (7, "É a b c d e"), (8, "é a b c d e"), (9, long), (10, long.replace("w30000 ", "x ")), (9, long), (11, "a b c"),
            (None, "only null ids here"), (None, "only null ids here"), (12, "k " * 1000), (13, "k " * 7)]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == []
    clash = spark.createDataFrame([(1, "a b c", "k", 5, [1])], "doc_id long, text string, key string, n int, bands array<int>")
    assert [tuple(r) for r in sm.near_duplicates(clash).collect()] == [(1, 1, 1, True)]
    named = spark.createDataFrame([("b", "x y"), ("a", "x y")], "id string, text string")
    assert sorted(tuple(r) for r in sm.near_duplicates(named, id_col="id").collect()) == [("a", 1, "a", True), ("b", 1, "a", False)]
