import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from curbline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The contract, prefix by prefix. Turn numbers of a conversation must differ (but for equal turns)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        hundred = c - (c % 100 if c >= 0 else -(-c % 100))
        paths[c] = tuple(own.get(hundred, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        w = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += w
            leaves[p[:d]] += not kids[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert not found or list(found[0].asDict()) == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found), key=str)


def made(seed, n, turns, texts):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(0, 400), rng.randrange(0, 400) // 100 * 100, -rng.randrange(0, 300), rng.randrange(10**9)])
        if any(r[0] == c for r in rows):
            continue
        rows += [(c, t if t else None, rng.choice(["user", None, ""]), rng.choice(texts)) for t in range(rng.randrange(1, turns + 1))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1, 4])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = made(1, 150, 14, ["a", "b" * 3, None, ""])
    assert got(spark, rows) == plain(rows)


def test_long_conversations_are_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 5)
    monkeypatch.setattr(prefix_trie, "ENDS_BYTES", 8)
    long = [(7, t, "user", f"turn {t % 3}") for t in range(-40, 60)]
    rows = [*long, *[(c, t - 3, r, x) for c in (8, 9, 107, 200) for _, t, r, x in long[:90 + c % 7]], *made(2, 30, 9, ["x", "yy"])]
    rows = [r for i, r in enumerate(rows) if r[0] not in {7, 8, 9, 107, 200} or i < len(long) + 4 * 97]
    seen = {}
    rows = [seen.setdefault((r[0], r[1]), r) for r in rows if (r[0], r[1]) not in seen]
    assert got(spark, rows) == plain(rows)


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(9)] + [(c, t, "user", f"same {t % 5}") for c in range(300, 350) for t in range(7)]
    assert got(spark, rows) == plain(rows)


def test_edge_rows(spark):
    for rows in ([], [(None, 0, "user", "x")], [(5, 0, None, None)], [(c, 0, "u", "x") for c in (1, 2, 3, 4, 5, 6, 99, 101)],
                 [(100, 1, "u", "a"), (100, 2, "u", "b"), (101, None, "u", "z" * 100_000), (101, 1, "u", "b"), (150, 1, "u", "a"), (150, 1, "u", "a")]):
        assert got(spark, rows) == plain(rows)
    clash = spark.createDataFrame([(0, 0, "u", "abc", 1, "k", 2)], SCHEMA + ", depth int, c string, n int")
    assert len(prefix_trie.prefix_trie(clash).collect()) == 2
