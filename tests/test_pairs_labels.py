from __future__ import annotations

import hashlib
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pairforge.functions import joins, scratch
from pairforge.functions.scratch import stage
from pairforge.operators import pairs as P
from pairforge.plans import label_job as L
from workload.corpus import label_catalogs

PAIRS = [
    ("train", 0, 0, "sales", "  q1 \n", "SELECT c_name FROM customer WHERE c_custkey = 1 "),
    ("train", 1, 0, "sales", "q1", "SELECT c_name FROM customer WHERE c_custkey = 1"),
    ("val", 0, 0, "sales", "q1", "SELECT c_name FROM customer WHERE c_custkey = 1"),
    ("train", 0, 1, "sales", " \t", "SELECT 1"),
    ("train", 0, 2, "web", "q2", "SELEC name FORM sessions, WHERE session_id = 5"),
    ("train", 0, 3, "web", "q3", "SELECT ((( FROM nowhere"),
    ("train", 0, 4, "none", "q4", "SELECT a FROM b"),
    ("train", 0, 5, "sales", "q5", "SELECT c.c_name FROM customer c JOIN orders o WHERE o.o_totalprice > 5"),
    ("train", 0, 6, "sales", "q6", "SELECT count(*) FROM Orders"),
]


@pytest.fixture
def unique(spark):
    rows = spark.createDataFrame(
        PAIRS, "split string, source_ord int, row_ord int, db_id string, question string, query string"
    ).withColumn("source", F.lit("a.json"))
    return P.pairs_dedup(P.with_pair_id(P.pairs_clean(rows)))


def test_ids_and_duplicates(unique):
    rows = unique.collect()
    assert len(rows) == 7
    digest = hashlib.sha256(
        "sales\0q1\0SELECT c_name FROM customer WHERE c_custkey = 1".encode()
    ).hexdigest()[:16]
    q1 = {(r.split, r.source_ord) for r in rows if r.id == digest}
    assert q1 == {("train", 0), ("val", 0)}
    again = P.pairs_dedup(unique)
    assert sorted(again.collect()) == sorted(rows)
    assert [r.id for r in P.split_leakage(unique).collect()] == [digest]


def as_dict(df):
    return {(r.split, r.question): r for r in df.collect()}


def test_labels(spark, unique):
    labels = L.label_pairs(unique, label_catalogs(spark, ""))
    rows = as_dict(labels)
    assert rows["train", "q1"].method == "parser"
    assert rows["train", "q2"].method == "fallback"
    assert (rows["train", "q3"].method, rows["train", "q3"].reason) == (
        None, "fallback found no tables: unbalanced parentheses"
    )
    assert (rows["train", "q4"].known, rows["train", "q4"].reason) == (False, "unknown db_id")
    labelled = as_dict(L.label_rows(labels))
    assert labelled["train", "q5"].columns == {
        "customer": ["c_custkey", "c_name"], "orders": ["o_orderkey", "o_custkey", "o_totalprice"]
    }
    assert [k.column for k in labelled["train", "q5"].pruned_schema.foreign_keys] == ["o_custkey"]
    assert labelled["train", "q6"].columns == {"orders": ["o_orderkey"]}
    report = {r.split: r for r in L.label_report(labels).collect()}
    assert report["train"].asDict() == {
        "split": "train", "total": 6, "labeled": 4, "parser": 3, "fallback": 1,
        "extraction_failed": 1, "unknown_db": 1,
    }
    assert [r.question for r in L.failure_sample(labels, ["row_ord"], 1).collect()] == ["q3"]


def test_used_within_pruned_within_catalog(spark, unique):
    catalogs = {
        r.db_id: {(t.name, c.name) for t in r.tables for c in t.columns}
        for r in label_catalogs(spark, "").collect()
    }
    for row in L.label_pairs(unique, label_catalogs(spark, "")).where("method IS NOT NULL").collect():
        pruned = {(t.name, c.name) for t in row.pruned_schema.tables for c in t.columns}
        used = {(u.table_name, u.column_name) for u in row.used if u.column_name}
        assert used <= pruned <= catalogs[row.db_id]


def test_options(spark, unique):
    options = L.LabelOptions(
        enable_fallback=False, include_primary_keys=False, include_foreign_keys=False
    )
    rows = as_dict(L.label_pairs(unique, label_catalogs(spark, ""), options))
    assert (rows["train", "q2"].method, rows["train", "q2"].reason) == (None, "not a query")
    pruned = rows["train", "q5"].pruned_schema
    assert {(t.name, c.name) for t in pruned.tables for c in t.columns} == {
        ("customer", "c_name"), ("orders", "o_totalprice")
    }


def test_same_result_without_broadcast(spark, unique, monkeypatch):
    small = sorted(L.label_pairs(unique, label_catalogs(spark, "")).collect(), key=str)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 2)
    shuffled = unique.orderBy(F.rand(3)).repartition(5)
    large = sorted(L.label_pairs(shuffled, label_catalogs(spark, "")).collect(), key=str)
    assert [str(r) for r in small] == [str(r) for r in large]


def test_duplicate_database_fails(spark, unique):
    twice = label_catalogs(spark, "")
    twice = twice.union(twice.where("db_id = 'geo'"))
    with pytest.raises(ValueError, match="duplicate db_id geo"):
        L.label_pairs(unique, twice).collect()


def test_hot_key_is_spread_by_its_count(spark, monkeypatch):
    """One key with 90% of the facts: no task joins more than a bounded share, for growing input."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 500)
    lookup = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    for n in (2_000, 20_000):
        facts = spark.range(n).select("id", F.when(F.col("id") % 10 > 0, 3).otherwise(F.col("id") % 50).alias("k"))
        joined = joins.lookup_join(facts, lookup, ["k"], "left", salt_on=["id"])
        assert joined.where("v is null or v <> k * 7").count() == 0 and joined.count() == n
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            spark.conf.set("spark.sql.shuffle.partitions", "200")
            most = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert most <= 5 * 500


def test_small_file_with_large_rows_is_not_broadcast(spark):
    """Catalogs that repeat take few bytes as files, and hundreds of times as many as rows."""
    columns = F.expr("transform(sequence(1, 400), i -> named_struct('name', concat('a_long_column_name_', i)))")
    lookup = stage(spark.range(4_000).coalesce(1).select(F.col("id").alias("k"), columns.alias("columns")), "repeated")
    assert lookup.stage_bytes * joins.FILE_TO_MEMORY < joins.BROADCAST_BYTES
    assert not joins.fits_broadcast(lookup)
    assert joins.fits_broadcast(stage(lookup.limit(50), "few"))
    many = stage(spark.range(600_000).select(F.lit("a").alias("text")), "many")
    assert not joins.fits_broadcast(many)


def test_lookup_with_small_file_and_large_rows_meets_in_a_shuffle(spark):
    """Spark takes a table for its files, so once no key proves heavy it would broadcast one measured as too large."""
    columns = F.expr("transform(sequence(1, 400), i -> concat('a_long_column_name_', i))")
    lookup = stage(spark.range(4_000).coalesce(1).select(F.col("id").alias("k"), columns.alias("columns")), "repeated")
    assert lookup.stage_bytes < 10 * 1024 * 1024 and not joins.fits_broadcast(lookup)
    facts = stage(spark.range(10_000).select("id", (F.col("id") % 5_000).alias("k")), "facts")
    counted = stage(lookup.withColumn("n", F.lit(2)), "counted")
    for joined, rows in (
        (joins.lookup_join(facts, lookup, ["k"], "left", salt_on=["id"]), 10_000),
        (joins.lookup_join(facts, lookup, ["k"], "inner", salt_on=["id"]), 8_000),
        (joins.weighted_join(facts, counted, "k", weight="n", salt_on="id"), 8_000),
    ):
        sizes = joined.select("id", F.size("columns").alias("n"))
        found = sizes.collect()
        assert len({r["id"] for r in found}) == len(found) == rows
        assert sum(r["n"] == 400 for r in found) == 8_000
        final = sizes._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "isFinalPlan=true" in final and "SortMergeJoin" in final and "BroadcastHashJoin" not in final


def test_stage_table_has_bounded_row_groups(spark):
    """A writer holds one row group in memory; eight tasks with the usual 128 MB fill a heap of 1 GB."""
    text = F.concat_ws("", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(8)])
    table = stage(spark.range(60_000).coalesce(1).select("id", text.alias("text")), "wide")
    (path,) = Path(table.stage_path.removeprefix("file:")).glob("*.parquet")
    meta = pq.ParquetFile(path).metadata
    sizes = [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert table.count() == 60_000 and len(sizes) > 1 and max(sizes) < 2 * scratch.ROW_GROUP_BYTES
