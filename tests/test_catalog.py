from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pairforge.operators import catalog as C

ENTRY = {
    "db_id": "geo", "table_names_original": ["region", "nation"],
    "column_names_original": [[-1, "*"], [0, "r_regionkey"], [0, "r_name"], [1, "n_nationkey"],
                              [1, "n_name"], [1, "n_regionkey"]],
    "column_types": ["text", "number", "text", "number", "text", "number"],
    "primary_keys": [1, [3]], "foreign_keys": [[5, 1]],
}


@pytest.fixture
def entries(spark):
    rows = spark.createDataFrame([(json.dumps(ENTRY),)], "body string")
    return rows.select(F.from_json("body", C.RAW_ENTRY).alias("e")).select("e.*")


def test_flat_catalog(entries):
    rows = C.catalog_columns(entries).orderBy("col_idx").collect()
    assert [(r.table_name, r.column_name) for r in rows] == [
        ("region", "r_regionkey"), ("region", "r_name"), ("nation", "n_nationkey"),
        ("nation", "n_name"), ("nation", "n_regionkey"),
    ]
    assert [r.column_name for r in rows if r.is_primary_key] == ["r_regionkey", "n_nationkey"]
    key = C.catalog_foreign_keys(entries).first()
    assert (key.table_name, key.column_name, key.ref_table, key.ref_column) == (
        "nation", "n_regionkey", "region", "r_regionkey"
    )


def test_nested_forms_agree(entries):
    flat = C.nest_catalog(C.catalog_columns(entries), C.catalog_foreign_keys(entries))
    assert flat.collect() == C.catalogs_from_entries(entries).collect()


def test_schema_text(entries):
    nested = C.catalogs_from_entries(entries)
    tables, keys = F.col("tables"), F.col("foreign_keys")
    row = nested.select(
        C.schema_text(tables, keys).alias("v"),
        C.schema_text(tables, keys, style="compact").alias("c"),
        C.schema_text(tables, keys, include_types=False).alias("n"),
    ).first()
    assert row.v == (
        "table region (r_regionkey number primary key, r_name text)\n"
        "table nation (n_nationkey number primary key, n_name text, n_regionkey number)\n"
        "foreign key nation.n_regionkey references region.r_regionkey"
    )
    assert row.c == "region(r_regionkey, r_name) | nation(n_nationkey, n_name, n_regionkey)"
    assert row.n.splitlines()[0] == "table region (r_regionkey primary key, r_name)"
    with pytest.raises(ValueError):
        C.schema_text(tables, keys, style="tall")


def test_unique_databases(entries):
    assert C.require_unique_databases(entries).count() == 1
    assert C.duplicate_databases(entries.union(entries)).first()["entries"] == 2
    with pytest.raises(ValueError, match="duplicate db_id geo"):
        C.require_unique_databases(entries.union(entries)).collect()


def test_sql_types(one):
    for given, expected in {"number": "NUMERIC", "time": "TIMESTAMP", "odd": "TEXT"}.items():
        assert one(C.sql_type(F.col("t")), t=given) == expected


def test_flatten_settings(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 1, 'b', named_struct('c', 'x')) AS s")
    rows = C.flatten_settings(df, ["id"], ["s"]).collect()
    assert {(r.key, r.value) for r in rows} == {("s.a", "1"), ("s.b.c", "x")}
