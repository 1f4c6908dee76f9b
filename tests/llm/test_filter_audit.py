from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import pytest

from pairforge.llm import filter_audit as A
from pairforge.llm.queries import ORACLES, QUERIES
from tests.check_oracles import compare, connect

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(60))
LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, source string"


def fails(rows, i):
    doc_id, text, _ = rows[i]
    text = text or ""
    words = SPACE.findall(text)
    copied = doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in rows)
    return [
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        bool(set("#$%&*|") & set(text)),
        copied,
    ]


def simulated(rows, labels):
    """Filters run one after the other over all documents, once for each order."""
    out, shapley = {}, defaultdict(int)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = defaultdict(list)
    for i, row in enumerate(rows):
        parts[row[2] or ""].append((row[0], fails(rows, i)))
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                k = "ABCDE".index(x)
                gone = [d for d in left if d[1][k]]
                left = [d for d in left if not d[1][k]]
                shapley[part, x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(d[1][k] for d in docs) - len(gone),
                    sum(d[1][k] and sum(d[1]) == 1 for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


CASES = {
    "mixed": (
        [
            (5, LONG, "a"), (3, LONG, "b"), (9, LONG, "a"), (9, LONG, "a"), (4, "short", "a"), (1, LONG + " #", None),
            (6, "x " * 60, ""), (7, "X " * 60, "a"), (None, LONG, "a"), (None, None, "b"), (8, None, "b"), (2, "", "b"),
            (10, LONG.upper() + "é" * 10, "c"), (11, "a b" + "\v\f\r" * 30 + "c|", "c"), (12, "\x1c".join("ab" * 60), "c"),
        ],
        [(5, 1, 0), (9, 1, 1), (9, 0, 1), (4, 0, None), (None, 1, 1), (7, None, 1), (99, 1, 1), (10, 1, 0)],
    ),
    "very long": ([(1, "a " * 300_000, "a"), (2, "B" * 500_000, "a"), (3, "a " * 300_000, "b")], [(3, 1, 1)]),
}


@pytest.mark.parametrize("case", CASES)
def test_equals_filters_run_in_every_order(spark, case):
    rows, labels = CASES[case]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS part", "1 AS fails", "2 AS n", "3 AS digest")
    got = A.audit_filters(docs, spark.createDataFrame(labels, LABELS).selectExpr("*", "'y' AS text")).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == simulated(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert A.audit_filters(docs, spark.createDataFrame([], LABELS)).count() == 0
    some = spark.createDataFrame([(1, LONG, "a")], DOCS)
    assert {r["kept"] for r in A.audit_filters(some, spark.createDataFrame([], LABELS)).collect()} == {1}


def test_any_number_of_filters(spark):
    counts = spark.createDataFrame([("p", 3, 6, 0, 0), ("p", 1, 2, 0, 0), ("p", 0, 1, 0, 0)], "part string, fails int, n bigint, good bigint, toxic bigint")
    got = {(r["filter_order"], r["step"]): (r["removed"], r["shapley"]) for r in A.removal_audit(counts, "XY").collect()}
    assert got == {("XY", 1): (8, 10), ("XY", 2): (0, 6), ("YX", 1): (6, 6), ("YX", 2): (2, 10)}


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(QUERIES["op13_filter_audit"](spark, sf_dir), connect(sf_dir), "op13_filter_audit") == ""
    assert "op13_filter_audit" in ORACLES
