import random

from curbline.llm import packing, queries

SF = "/root/testdata/sf0.01"


def plain_best_fit(sizes, lengths, least):
    """Looks at every open bin; of equal rooms the one used last."""
    room, used, out, filled = [], [], [], []
    for step, n in enumerate(sizes):
        fits = [b for b in range(len(room)) if room[b] >= n]
        if fits:
            b = min(fits, key=lambda b: (room[b], -used[b]))
        else:
            b = len(room)
            room.append(max(least, min(c for c in lengths if c >= n)))
            used.append(0)
            filled.append(0)
        room[b] -= n
        used[b] = step
        filled[b] += n
        out.append(b)
    return out, filled


def test_best_fit_equals_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        lengths = tuple(sorted(rng.sample(range(8, 200), 4)))
        sizes = sorted((rng.randrange(1, lengths[-1] + 1) for _ in range(rng.randrange(1, 120))), reverse=True)
        for least in lengths:
            assert packing.best_fit(sizes, lengths, least) == plain_best_fit(sizes, lengths, least)
        bins, final = packing.pack(sizes, lengths)
        tries = []
        for least in lengths:
            filled = plain_best_fit(sizes, lengths, least)[1]
            tries.append(sum(packing.cost(min(c for c in lengths if c >= n)) for n in filled))
        assert abs(sum(map(packing.cost, final)) - min(tries)) < 1e-6


def check_packing(rows, tokens, lengths):
    """Every token once, no bin over its length, every bin as small as permitted."""
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.row_key, []).append((r.first_token, r.n_tokens, r.doc_id))
        if r.n_tokens:
            bins.setdefault(r.bin_id, []).append((r.bin_offset, r.n_tokens, r.capacity))
        else:
            assert r.bin_id is None and r.capacity is None
    got = []
    for parts in pieces.values():
        at = 0
        for first, n, _ in sorted(parts):
            assert first == at
            at += n
        got.append((parts[0][2], at))
    assert sorted(got, key=str) == sorted(tokens, key=str)
    for parts in bins.values():
        at = 0
        for offset, n, _ in sorted(parts):
            assert offset == at
            at += n
        assert {c for _, _, c in parts} == {min(c for c in lengths if c >= at)}
    return sum(n for _, n in tokens), sum(parts[0][2] for parts in bins.values())


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs).collect()
    used, room = check_packing(rows, [(r.doc_id, len((r.text or "").split())) for r in docs.collect()], packing.LENGTHS)
    assert used / room > 0.97, used / room
    got = queries.op4_packing(spark, SF).collect()
    assert len(got) == len(rows)


def test_edge_rows(spark):
    rows = [(None, "a b", 1, 2), (1, None, 1, 2), (2, "", 1, 2), (3, "w " * 10_000, 1, 2), (3, "w " * 10_000, 1, 2), (4, "x", 1, 2), (4, "x", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid int, bin_id int")
    got = packing.pack_documents(docs, lengths=(16, 64), shard_pieces=50).collect()
    check_packing(got, [(r[0], len((r[1] or "").split())) for r in rows], (16, 64))
    assert packing.pack_documents(docs.limit(0)).collect() == []
    characters = packing.pack_documents(docs, count=len).where("doc_id = 4").collect()
    assert [r.n_tokens for r in characters] == [1, 1]
