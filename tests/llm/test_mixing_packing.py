from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pairforge.llm import best_fit_packing as P, hilbert_shards as H, poisson_mixing as M
from tests.check_oracles import compare, connect, plan

SF = "/root/testdata/sf0.001"
PYTHON = ["ArrowEvalPython", "BatchEvalPython", "InPandas", "InArrow", "CartesianProduct"]


def inverse_poisson(u, rate):
    log_p, total, k = -rate, math.exp(-rate), 0
    while total <= u and k < rate + 12 * math.sqrt(rate) + 31:
        k += 1
        log_p += math.log(rate) - math.log(k)
        total += math.exp(log_p)
    return k


def test_copies_equal_brute_force(spark, documents):
    rows = [(i, "word " * (i % 50 + 1)) for i in range(400)] + [(None, "no id"), (7, None), (7, ""), (3, "word word word word ")]
    docs = documents(*rows, clash=True).withColumn(
        "source", F.expr("CASE WHEN doc_id % 3 = 0 THEN 'big' WHEN doc_id % 50 = 1 THEN 'rare' WHEN doc_id % 7 > 0 THEN 'mid' END")
    )
    mixed = M.mix_sources(docs)
    assert not [word for word in PYTHON if word in plan(mixed)]
    rows = docs.collect()
    size = lambda r: 1 + len((r.text or "").encode())
    own = Counter()
    for r in rows:
        own[r.source] += size(r)
    weight = {s: n**0.5 for s, n in own.items()}
    rate = {s: weight[s] / sum(weight.values()) * sum(own.values()) / own[s] for s in own}
    expected = Counter()
    for r in rows:
        name = "null" if r.doc_id is None else r.doc_id
        u = int(hashlib.md5(f"{M.SEED}:{name}".encode()).hexdigest()[:13], 16) / 16**13
        for copy in range(inverse_poisson(u, rate[r.source])):
            expected[r.doc_id, r.text, copy + 1] += 1
    found = mixed.collect()
    assert Counter((r.doc_id, r.text, r.copy) for r in found) == expected
    assert [r.order_key for r in found] == sorted(r.order_key for r in found)


def test_large_rates_do_not_underflow(spark):
    steps = spark.range(1).select(M.poisson_steps(F.lit(2000.0)).alias("s")).first().s
    assert abs(steps[-1] - 1) < 1e-9 and steps == sorted(steps)
    assert abs(np.searchsorted(steps, 0.5) - 2000) < 3


def test_mix_of_nothing(spark, documents):
    assert M.mix_sources(documents((1, "x")).where("false")).collect() == []


@pytest.mark.parametrize("name", sorted(set(entry.LLM_ORACLES)))
def test_query_equals_its_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), name) == ""


def slow_best_fit(lengths, capacities, preferred):
    """The same rule by looking at every open bin; of equally full ones the last one touched."""
    bins, touched = [], []
    for step, length in enumerate(sorted(lengths, reverse=True)):
        room = [(size - load, -touched[b], b) for b, (size, load) in enumerate(bins) if size - load >= length]
        if room:
            b = min(room)[2]
        else:
            b = len(bins)
            bins.append((max(preferred, min(c for c in capacities if c >= length)), 0))
            touched.append(step)
        bins[b] = (bins[b][0], bins[b][1] + length)
        touched[b] = step
    return sorted(load for _, load in bins)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80), st.sampled_from([(64,), (16, 64), (8, 16, 32, 64)]))
def test_packing_equals_brute_force(lengths, capacities):
    array = np.array(sorted(lengths, reverse=True), np.int64)
    for preferred in capacities:
        _, _, loads = P.pack_with(array, capacities, preferred)
        assert sorted(loads) == slow_best_fit(lengths, capacities, preferred)
    bins, offsets, sizes = P.pack(np.array(lengths, np.int64), capacities)
    cheapest = min(sum(P.sequence_cost(min(c for c in capacities if c >= n)) for n in slow_best_fit(lengths, capacities, p)) for p in capacities)
    assert abs(sum(P.sequence_cost(int(sizes[bins == b][0])) for b in set(bins.tolist())) - cheapest) < 1e-6
    for b in set(bins.tolist()):
        spans = sorted((int(o), n) for o, n, x in zip(offsets, lengths, bins, strict=True) if x == b)
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]


def check_packing(rows, tokens, capacities):
    """All tokens once, bins not over full and no larger than their contents need."""
    assert sum(r.piece_tokens for r in rows) == sum(tokens)
    loads = Counter()
    for r in rows:
        loads[r.bin] += r.piece_tokens
    for r in rows:
        assert r.capacity == min(c for c in capacities if c >= loads[r.bin])
        assert 0 <= r.bin_offset and r.bin_offset + r.piece_tokens <= loads[r.bin]


def test_packing_of_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "w " * 20_000), (4, "a b c"), (4, "a b c")]
    docs = documents(*rows, clash=True)
    found = P.pack_documents(docs, pieces_per_shard=3).collect()
    check_packing(found, [len((t or "").split()) + 1 for _, t in rows], P.CAPACITIES)
    assert [r.piece for r in sorted((r for r in found if r.doc_id == 3), key=lambda r: r.piece_start)] == list(range(5))
    assert P.pack_documents(docs.where("false")).collect() == []


def test_packing_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = P.pack_documents(docs).collect()
    check_packing(found, [len(r.text.split()) + 1 for r in docs.collect()], P.CAPACITIES)


@pytest.mark.parametrize("bits,n", [(2, 2), (3, 2), (2, 3), (3, 3)])
def test_curve_visits_neighbours(spark, bits, n):
    """Every cell once, and each step moves by one along one axis."""
    size = 1 << bits
    cells = spark.range(size**n).select(*[F.expr(f"int(id div {size**i} % {size})").alias(f"x{i}") for i in range(n)])
    axes = [F.col(f"x{i}") for i in range(n)]
    rows = sorted((r[-1], tuple(r[:-1])) for r in cells.select(*axes, H.hilbert_index(axes, bits).alias("h")).collect())
    assert [h for h, _ in rows] == list(range(size**n))
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for (_, x), (_, y) in zip(rows, rows[1:], strict=False))


def test_shards(spark, documents):
    import zlib

    rows = [(i % 90 if i % 11 else None, "t" * (i % 13) if i % 5 else None) for i in range(331)] + [(1, "same")] * 60
    docs = documents(*rows, clash=True)
    axes = [H.category_axis("lang"), H.category_axis("source"), H.magnitude_axis("n_chars")]
    sharded = H.shard_by_curve(docs, axes)
    assert not [word for word in PYTHON if word in plan(sharded)]
    found = sharded.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = {s: sorted(r.slot for r in found if r.shard == s) for s in range(40)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert {len(v) for v in slots.values()} <= {len(rows) // 40, len(rows) // 40 + 1}
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in found)
    assert H.shard_by_curve(docs.where("false"), axes).collect() == []
    assert {len([r for r in H.shard_by_curve(docs.limit(7), axes).collect() if r.shard == s]) for s in range(40)} == {0, 1}


def test_mixing_returns_clashing_columns_and_large_rates(spark, documents):
    """A tiny source beside a hot one is repeated several hundred times; columns of any names come back."""
    rows = [(i, "x" * 40_000) for i in range(60)]
    docs = documents(*rows).selectExpr("*", "doc_id AS copy", "'k' AS order_key", "1 AS _source", "2 AS _n", "3 AS _steps", "4 AS _u", "5 AS _row")
    docs = docs.union(documents((99, "y")).selectExpr("doc_id", "text", "lang", "'tiny' AS source", "n_chars", "doc_id AS copy", "'k' AS order_key", "1", "2", "3", "4", "5"))
    found = M.mix_sources(docs).where("source = 'tiny' or doc_id < 3").collect()
    assert {(r.copy_in, r.order_key_in, r._source, r._n, r._steps, r._u, r._row) for r in found} == {(r.doc_id, "k", 1, 2, 3, 4, 5) for r in found}
    tiny = sorted(r.copy for r in found if r.source == "tiny")
    assert len(tiny) > 400 and tiny == list(range(1, len(tiny) + 1))
