import base64
import gzip
import hashlib

import pytest

from curbline.llm import queries, warc

SF = "/root/testdata/sf0.01"


def expected(rows):
    by = {}
    for page_id, _, html in rows:
        by.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        keep = max((i for i in by[body] if i is not None), default=None)
        first = keep is None or page_id == keep
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "response" if first else "revisit", None if first else keep))
    return sorted(out, key=str)


def digest_rows(records):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str)


def test_round_trip_of_the_whole_table(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert digest_rows(queries.op1_warc(spark, SF).collect()) == expected(pages)


ODD = [(1, "http://A.Example.com:80/x?q=1#frag", "same"), (2, "https://example.com:8443/", "same"), (3, None, None), (4, "", ""),
       (5, "http://[broken", "é" * 50_000), (6, "http://b.example.com/a\r\nb", "WARC/1.1\r\n\r\nnested"), (6, "http://b.example.com/a\r\nb", "WARC/1.1\r\n\r\nnested"),
       (None, "http://b.example.com/", "same"), (None, "http://c.org/", "only null"), (None, "http://c.org/", "only null")]


def odd(spark):
    return spark.createDataFrame([(*r, "x", 9) for r in ODD], "page_id long, url string, html string, sha string, keep int")


def test_edge_rows(spark):
    got = warc.read_records(warc.index_lines(warc.write_archive(odd(spark)))).collect()
    assert digest_rows(got) == expected(ODD)
    assert sorted(str(r.url) for r in got) == sorted(str(u) for _, u, _ in ODD)
    assert sorted(r.payload.decode() for r in got if r.record_type == "response") == sorted(
        [h or "" for i, _, h in ODD if i not in (1, None, 3)] + ["only null"] * 2)
    assert warc.read_records(warc.index_lines(warc.write_archive(odd(spark).limit(0)))).collect() == []
    assert {r.record_type for r in warc.read_records(warc.index_lines(warc.write_archive(odd(spark), least_bytes=5))).collect()
            if r.payload_bytes == 4} == {"response"}


def test_url_keys_sort_by_reversed_host():
    assert warc.url_key("http://A.Example.com:80/x?q=1#frag") == "com,example,a)/x?q=1"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/"
    assert warc.url_key(None) == ")" and warc.url_key("http://[broken") == ")http://[broken"


def test_lookup_through_both_levels(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rows = [(i, f"http://h{i % 13}.example.org/p{i % 50}", f"body {i}") for i in range(600)]
    rows += [(1000 + i, "http://hot.example.org/", f"hot {i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        directory = warc.write_archive(pages)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert directory.count() > 100 and directory.select("file").distinct().count() > 3
    wanted = ["http://hot.example.org/", "http://h3.example.org/p3", "http://none.example.org/", None, "http://h12.example.org/p49", "http://a.a/", "http://z.zz/"]
    asked = spark.createDataFrame([(w,) for w in wanted], "url string")
    got = sorted((r.wanted, r.page_id, bytes(r.payload).decode()) for r in warc.lookup(directory, asked).collect())
    assert got == sorted((u, i, h) for i, u, h in rows if u in wanted)
    keys = [r.first_key for r in directory.orderBy("first_key").collect()]
    assert keys == sorted(keys)


def test_damage_is_noticed():
    data = warc.record(1, "http://a/", b"abc", 3, warc.digest_of(b"abc"), None)
    assert warc.parse(gzip.decompress(gzip.compress(data)))["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"abc", b"abd"))
