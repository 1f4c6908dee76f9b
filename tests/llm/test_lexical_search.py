from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pairforge.llm import lexical_search as L
from pairforge.llm.queries import QUERIES
from tests.check_oracles import compare, connect

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k=10):
    told = [(i, Counter(terms(t))) for i, t in docs]
    told = [(i, c) for i, c in told if c]
    n_docs, n_terms = len(told), sum(c.total() for _, c in told)
    df = Counter(t for _, c in told for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in told:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, documents, docs, items, **more):
    asked = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS key", "2 AS rank")
    clashing = documents(*docs).selectExpr("*", "1 AS key", "2 AS digest", "3 AS rank", "4 AS item", "5 AS _last")
    return sorted(map(tuple, L.search(clashing, asked, **more).collect()), key=repr)


def corpus(seed, n=400):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "中文", "don't", "x_y", "A1"]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(draw.choices(vocabulary, weight, k=draw.choice([1, 5, 40, 300])))) for i in range(n)]
    items = [(i, " ".join(draw.choices(vocabulary, weight, k=12))) for i in range(25)]
    copies = [(n + i, docs[7][1]) for i in range(40)]  # more copies than ranks
    return docs + copies + [(None, docs[3][1]), (None, None), (5, None), (6, ""), (8, "-- ##"), (9, docs[9][1]), (9, docs[9][1])], items


@pytest.mark.parametrize("more", [{}, {"item_block": 7}, {"k": 3}])
def test_equals_brute_force(spark, documents, more):
    docs, items = corpus(1)
    items += [(30, docs[7][1]), (31, None), (32, "!!"), (33, "unheard of"), (None, "w1 w2")]
    assert found(spark, documents, docs, items, **more) == brute_force(docs, items, more.get("k", 10))


def test_very_long_texts_and_ties(spark, documents):
    docs = [(i, "same words here") for i in range(30, 0, -1)] + [(100, "w " * 200_000 + "here"), (101, " ".join(f"v{i}" for i in range(60_000)))]
    items = [(1, "here w"), (2, "v59999 same"), (2, "v59999 same")]
    assert found(spark, documents, docs, items) == brute_force(docs, items[:2])


def test_empty_tables(spark, documents):
    assert found(spark, documents, [], [(1, "a")]) == []
    assert found(spark, documents, [(1, "a")], []) == []
    assert found(spark, documents, [(1, None)], [(1, "a")]) == []


def test_bounds_are_never_below_scores():
    docs, items = corpus(2)
    texts = [t or "" for _, t in docs]
    block = L.ItemBlock.of([(i, L.terms_of(t)) for i, t in items])
    told = [Counter(terms(t)) for t in texts]
    block.n_docs, block.n_terms = sum(map(bool, told)), sum(c.total() for c in told)
    block.weights = np.arange(1, len(block.terms) + 1)
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["key", "text"])
    number = {t: n for (_, text), at, size in zip(items, block.item_starts, block.item_sizes) for t, n in zip(L.terms_of(text), block.item_terms[at : at + size])}
    seen, skipped = 0, 0
    for part in L.index_documents(iter([batch])):
        row = part.to_pylist()[0]
        bounds = block.bounds(np.array(row["lengths"]), row["width"], row["slices"])
        for d, key in enumerate(row["keys"]):
            m = 10 + 90 * row["lengths"][d] * block.n_docs // block.n_terms
            for q, (_, text) in enumerate(items):
                score = sum(int(block.weights[number[t]]) * (10**9 * told[key][t] // (1000 * told[key][t] + 8 * m)) for t in L.terms_of(text))
                assert bounds[q, d] >= score
                seen, skipped = seen + 1, skipped + (bounds[q, d] == score)
    assert seen == 25 * sum(map(bool, told)) and skipped > seen / 4


def test_only_near_winners_are_scored(spark, documents):
    docs, items = corpus(3, 2_000)
    block = L.ItemBlock.of([(i, L.terms_of(t)) for i, t in items])
    rows = documents(*docs).selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS key")
    L.corpus_counts(rows, block)
    shared = spark.sparkContext.broadcast(block)
    index = rows.where("text is not null").select("key", "text").mapInArrow(L.index_documents, L.INDEX).cache()
    tenth = {q: s for q, (i, _) in enumerate(items) for item, r, _, s in brute_force(docs, items) if item == i and r == 10}
    reaching = L.reaching_bounds(index, shared, np.array([tenth[q] for q in range(len(items))])).count()
    assert len(items) * 10 <= reaching < len(items) * len(docs) / 5


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(QUERIES["op12_ranked_search"](spark, sf_dir), connect(sf_dir), "op12_ranked_search") == ""


def test_search_bounds_its_batches(spark):
    """A batch holds as few texts as in the other operators, whatever the session had before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "10000")
    docs = spark.createDataFrame([(i, f"common word{i}") for i in range(20)], "doc_id bigint, text string")
    found = L.search(docs, spark.createDataFrame([(1, "word3 common")], ITEMS))
    assert found.count() == 10 and found.where("rank = 1 and doc_id = 3").count() == 1
    assert int(spark.conf.get(name)) <= 1000
