"""Every stage of the pipeline against a plain version of its decision."""

import corpus_pipeline as cp
import pytest
from test_decontaminate import contained
from test_lines import classes
from test_simhash import plain_components, plain_fingerprint

from curbline.llm import decontaminate, packing, queries
from curbline.llm.common import table, written

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows that go into each stage, and what the last returns."""
    docs, seen = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        seen.append(docs.collect())
        docs = written(stage(spark, docs, SF), f"test-{name}")
    return [*seen, docs.collect()]


def test_stages_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for rows in stages[:5]:
        assert list(rows[0].asDict()) == COLUMNS


def test_toxic_documents_go_and_nothing_else(spark, stages):
    scores = {r.doc_id: r.predicted for r in queries.op7_toxicity(spark, SF).collect()}
    assert {r.doc_id for r in stages[1]} == {r.doc_id for r in stages[0] if not scores[r.doc_id]}
    assert {r.doc_id: r.text for r in stages[0]}.items() >= {r.doc_id: r.text for r in stages[1]}.items()


def test_one_line_of_each_component_stays(stages):
    before = {r.doc_id: r.text.split("\n") for r in stages[1]}
    after = {r.doc_id: r.text for r in stages[2]}
    assert before.keys() == after.keys()
    truth, _ = classes([x.strip(" ").lower() for text in before.values() for x in text], 0.8)
    seen, cut, want_cut = set(), 0, 0
    for doc_id in sorted(before):
        kept = []
        for x in before[doc_id]:
            norm = x.strip(" ").lower()
            if norm and truth[norm] in seen:
                want_cut += 1
                continue
            if norm:
                seen.add(truth[norm])
            kept.append(x)
        own = after[doc_id].split("\n")
        cut += len(before[doc_id]) - len(own if kept or after[doc_id] else [])
        assert set(kept) <= set(own)            # nothing else is cut
    assert cut >= 0.97 * want_cut > 0           # MinHash misses few
    assert all(r.n_chars == len(r.text) for r in stages[2])


def test_one_document_of_each_simhash_component_stays(stages):
    rows = stages[2]
    ids = [r.doc_id for r in rows]
    groups = plain_components(ids, [plain_fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in stages[3]) == sorted(set(groups))


def test_contaminated_documents_go_and_clean_ones_stay(spark, stages):
    items = [decontaminate.words_of(r.text) for r in table(spark, SF, "benchmark").collect()]
    gone = {r.doc_id for r in stages[3]} - {r.doc_id for r in stages[4]}
    leaks = {r.doc_id for r in stages[3] if any(contained(r.text, w) for w in items)}
    assert leaks <= gone
    text = {r.doc_id: set(decontaminate.words_of(r.text)) for r in stages[3]}
    for doc_id in gone - leaks:
        assert any(len(set(w) & text[doc_id]) >= 0.6 * len(set(w)) for w in items)


def test_every_word_is_packed_once(stages):
    words = {r.doc_id: len(r.text.split()) for r in stages[4]}
    packed = {}
    for r in stages[5]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.n_tokens
    assert packed == words
    assert {r.capacity for r in stages[5]} <= {*packing.LENGTHS, None}


def test_empty_odd_and_repeated_rows(spark, tmp_path):
    for name in ("labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    schema = table(spark, SF, "documents").schema
    rows = [(1, None, None, None, None), (None, "a b c d e", "en", "s", 9), (2, "", "en", "s", 0), (3, "one line of text", "en", "s", 16),
            (3, "one line of text", "en", "s", 16), (None, "a b c d e", None, None, None)]
    for data in (rows, []):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        got = cp.run(spark, str(tmp_path)).collect()
        # the empty texts (null, empty, emptied by line dedup) are one SimHash group
        assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted([("1", 0), ("3", 4), ("None", 5)] if data else [])
