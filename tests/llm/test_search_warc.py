from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairforge.functions.scratch import scratch_path
from pairforge.llm import hamming_search as S, warc as W
from pairforge.llm.queries import QUERIES


def brute_top(rows, k, every):
    out = set()
    for i, code in rows.items():
        if i % every == 0:
            near = sorted((bin((code ^ c) & (1 << 64) - 1).count("1"), j) for j, c in rows.items() if j != i)[:k]
            out |= {(i, rank + 1, j, d) for rank, (d, j) in enumerate(near)}
    return out


@pytest.mark.parametrize("kind", ["random", "close", "equal", "few"])
def test_search_equals_brute_force(spark, kind):
    rng = random.Random(kind)
    center = rng.getrandbits(64)
    make = {
        "random": lambda i: rng.getrandbits(64), "close": lambda i: center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)),
        "equal": lambda i: center if i % 3 else rng.getrandbits(64), "few": lambda i: rng.getrandbits(64),
    }[kind]
    rows = {i: make(i) for i in range(4 if kind == "few" else 400)}
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in rows.items()]
    codes = spark.createDataFrame(signed + signed[:20], "id bigint, code bigint")
    found = {tuple(r) for r in S.nearest_codes(codes, 5, 10).collect()}
    assert found == brute_top(rows, 5, 10)


def test_vectors_of_all_kinds(spark):
    schema = "vec_id bigint, embedding array<float>, label int, code string"
    rows = [(0, [1.0, -1.0, 0.5], 1, "own"), (1, [1.0, 1.0, None], 1, ""), (2, None, 1, ""), (None, [1.0], 1, ""), (3, [], 0, ""), (4, [0.0] * 63 + [2.0], 0, "")]
    codes = {r.id: r.code for r in S.sign_codes(spark.createDataFrame(rows, schema)).collect()}
    assert codes == {0: 0b101, 1: 0b11, 2: None, 3: 0, 4: -(1 << 63)}
    found = sorted(tuple(r) for r in S.top_k(spark.createDataFrame(rows, schema), 2, 100).collect())
    assert found == [(0, 1, 1, 2), (0, 2, 3, 2)]
    # Every vector of an id is indexed and asked; a query without vector or neighbour is told.
    several = [*rows, (1, [1.0, -1.0, 0.5, -1.0], 2, ""), (100, None, 1, ""), (3, [1.0], 0, "")]
    found = sorted((tuple(r) for r in S.top_k(spark.createDataFrame(several, schema), 2, 100).collect()), key=str)
    assert found == [(0, 1, 1, 0), (0, 2, 3, 1), (100, None, None, None)]
    assert [tuple(r) for r in S.top_k(spark.createDataFrame([(0, [1.0], 1, "")], schema)).collect()] == [(0, None, None, None)]
    with pytest.raises(PySparkException, match="more than 64 components"):
        S.top_k(spark.createDataFrame([(1, [1.0] * 65, 1, "")], schema)).collect()
    assert S.top_k(spark.createDataFrame([], schema)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9).map(lambda x: (x,)), max_size=8).map(sorted), max_size=9))
def test_loser_tree_merges(runs):
    assert list(W.LoserTree(runs)) == sorted(x for run in runs for x in run)


def pages_of(spark):
    body = "<p>same body that is long enough to be stored once only, by the rules of the contract on payloads é</p>"
    rows = [
        (5, "http://www.B.example/x?q=1#f", body), (2, "https://a.example/", body), (9, "http://b.example/x", body), (2, "https://a.example/", body),
        (None, "http://c.example", body), (7, None, None), (8, "", ""), (3, "http://a.b\r\nc.example/", "short"), (4, "http://z.example", "short"),
        (6, "http://z.example", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9), (10, "http://z.example", "x" * 300_000),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return rows, pages.withColumn("captured", F.timestamp_seconds(F.when(F.col("page_id") != 4, 1_700_000_000 - F.col("page_id")))).withColumn("payload", F.lit("own"))


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(W, "ROWS_PER_RANGE", 4)
    rows, pages = pages_of(spark)
    path = scratch_path(spark, "archives")
    W.write_archives(pages.repartition(3), path, records_per_archive=2)
    runs = W.read_archives(spark, path)
    found = W.merge_index(runs, rows_per_range=4).orderBy("history_order").collect()
    assert len(found) == len(rows)
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in found]
    assert keys == sorted(keys)
    for r in found:
        payload = next(((h or "").encode() for i, _, h in rows if i == r.page_id))
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in found), key=str)
    assert kinds == sorted([
        (2, "response", None), (2, "response", None), (5, "revisit", 2), (9, "revisit", 2), (None, "revisit", 2), (7, "response", None),
        (8, "response", None), (3, "response", None), (4, "response", None), (6, "response", None), (10, "response", None),
    ], key=str)
    assert {r.url_key for r in found} >= {"example,b)/x?q=1", "example,a)/", "example,b)/x", ""}


def test_archives_are_read_by_their_offsets(spark):
    _, pages = pages_of(spark)
    path = scratch_path(spark, "archives")
    W.write_archives(pages.coalesce(1), path)
    data = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()}
    for r in W.read_archives(spark, path).collect():
        own = data[r.archive][r.record_offset : r.record_offset + r.record_length]
        assert own.startswith(b"WARC/1.1\r\n") and own.endswith(b"\r\n\r\n")
        (_, _, fields, block), = W.parse_records(own)
        assert fields["WARC-Type"] == r.record_type
        if r.record_type == "response":
            assert len(block.split(b"\r\n\r\n", 1)[1]) == r.payload_bytes


def test_no_pages(spark):
    _, pages = pages_of(spark)
    assert W.capture_histories(pages.where("false")).collect() == []


def test_damaged_archives_are_refused():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [b for *_, b in W.parse_records(good * 2)] == [b"ab", b"ab"]
    with pytest.raises(ValueError):
        list(W.parse_records(good.replace(b": 2", b": 1")))
    assert np.array_equal([o for o, *_ in W.parse_records(good * 2)], [0, len(good)])


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_captures_do_not_depend_on_the_time_zone(spark, zone):
    times = [0, 1_700_000_000, 1_699_164_000, -1, 951_782_400]
    before = spark.conf.get("spark.sql.session.timeZone")
    pages = spark.createDataFrame([(i, "http://a.example/", t) for i, t in enumerate(times)], "page_id bigint, url string, t bigint")
    pages = pages.select("page_id", "url", F.timestamp_seconds("t").alias("captured"), F.lit("x").alias("html"), F.lit("own").alias("payload_digest"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = {r.page_id: r.t for r in W.capture_histories(pages).select("page_id", F.unix_seconds("captured").alias("t")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == dict(enumerate(times))


def test_query_equals_brute_force_on_all_pages(spark):
    sf_dir = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    payloads = {r.page_id: (r.html or "").encode() for r in pages}
    first = {}
    for i in sorted(payloads):
        first.setdefault(payloads[i], i)
    expected = set()
    for i, payload in payloads.items():
        revisit = len(payload) >= 100 and first[payload] != i
        expected.add((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first[payload] if revisit else None))
    rows = QUERIES["op9_warc_index_merge"](spark, sf_dir).collect()
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(pages)
    ordered = sorted(rows, key=lambda r: r.history_order)
    assert [(r.url_key, r.captured, r.page_id) for r in ordered] == sorted((r.url_key, r.captured, r.page_id) for r in rows)
