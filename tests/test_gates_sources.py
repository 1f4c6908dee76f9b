from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairforge.operators import gates as G, training as T
from pairforge.sources import json_files as J
from workload.corpus import label_catalogs

ROW = "id string, split string, db_id string, question string, query string, tables array<string>, columns map<string,array<string>>"


@pytest.mark.parametrize("db,question,tables,columns,error", [
    ("geo", "q", ["region"], {"region": ["r_name"]}, None),
    ("geo", "q", ["REGION"], {"REGION": ["R_NAME"]}, None),
    ("nope", "q", ["region"], {}, "unknown db_id nope"),
    ("geo", "q", [], {}, "no tables in label"),
    ("geo", "q", None, None, "no tables in label"),
    ("geo", "q", ["region", "x", "y"], {"region": ["r_name"]}, "table x not in schema"),
    ("geo", "q", ["region", "x"], {"region": ["a", "b"]}, "column region.a not in schema"),
    ("geo", " ", ["region"], {"Region": ["zz"]}, "empty question or query"),
])
def test_validation(spark, db, question, tables, columns, error):
    rows = spark.createDataFrame([("i", "train", db, question, "s", tables, columns)], ROW)
    assert G.validate_rows(rows, label_catalogs(spark, "")).first()["error"] == error


def rates(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "split string, examples bigint, failure_rate double, fallback_rate double, invalid_examples bigint",
    )


def test_gates(spark):
    good = rates(spark, ("train", 100, 0.02, 0.05, 0))
    assert G.violations(good).count() == 0
    assert G.gate_verdict(good).first()["passed"]
    G.require_passed(G.gate_verdict(good))
    bad = rates(spark, ("val", 99, 0.02004, 0.05004, 2), ("train", 500, 0.0, 0.0, 0))
    verdict = G.gate_verdict(bad)
    row = verdict.first()
    assert not row.passed and row.violations == [
        "val: only 99 examples (min 100)", "val: extraction failure rate 0.0200 > 0.02",
        "val: fallback rate 0.0500 > 0.05", "val: 2 structurally invalid examples",
    ]
    assert [(s.split, s.extraction_failure_rate) for s in row.splits] == [("train", 0.0), ("val", 0.02)]
    with pytest.raises(G.GateFailed, match="only 99"):
        G.require_passed(verdict)


def test_rates_in_one_pass(spark):
    rows = spark.createDataFrame(
        [("train", True, "parser", None), ("train", True, "fallback", "bad"), ("train", True, None, "no tables in label"), ("train", False, None, None), ("val", False, None, None)],
        "split string, known boolean, method string, error string",
    )
    got = {r.split: tuple(r)[1:] for r in G.split_rates(rows).collect()}
    assert got == {"train": (2, 0.5, 0.25, 1), "val": (0, 1.0, 0.0, 0)}


def test_model_gates(spark):
    runs = spark.createDataFrame(
        [(1, 0.9, 0.8, 0.01), (2, 0.89, 0.79, 0.02)],
        "run_id int, table_recall double, column_recall double, unparseable_rate double",
    )
    got = [(r.run_id, r.message) for r in G.model_gates(runs).orderBy("gate_ord").collect()]
    assert got == [
        (2, "table_recall 0.8900 < 0.9"), (2, "column_recall 0.7900 < 0.8"),
        (2, "unparseable_rate 0.0200 > 0.01"),
    ]


def test_missing_catalog_fails(spark):
    rows = spark.createDataFrame([("i", "train", "nope", "q", "s", ["a"], {"a": ["b"]})], ROW).withColumns(
        {"pruned_schema": F.lit(None).cast("struct<tables:array<struct<name:string,columns:array<struct<name:string,type:string,is_primary_key:boolean>>>>,foreign_keys:array<struct<table:string,column:string,ref_table:string,ref_column:string>>>"),
         "extraction_method": F.lit("parser"), "source": F.lit("a")}
    )
    with pytest.raises(PySparkException, match="no catalog for nope"):
        T.model_ready_rows(rows, label_catalogs(spark, "")).collect()


def test_json_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é\n", None, "train"), (2, "b", 3, "val")], "a int, b string, c int, split string")
    assert J.jsonl_sink(rows, f"{tmp_path}/l") == 2
    back = J.jsonl_scan(spark, f"{tmp_path}/l", rows.schema)
    assert sorted(back.collect()) == sorted(rows.collect())
    text = [r.value for r in spark.read.text(f"{tmp_path}/l").collect()]
    assert '{"a":1,"b":"é\\n","c":null,"split":"train"}' in text
    J.split_sink(rows, f"{tmp_path}/s")
    J.split_sink(rows.where("split = 'val'").withColumn("b", F.lit("new")), f"{tmp_path}/s")
    got = {r.split: r.b for r in J.jsonl_scan(spark, f"{tmp_path}/s", rows.schema).collect()}
    assert got == {"train": "é\n", "val": "new"}


def test_report_of_several_rows_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        J.json_report_sink(spark.range(5), f"{tmp_path}/r")
    assert not (tmp_path / "r").exists()
    J.json_report_sink(spark.range(1), f"{tmp_path}/r")
    assert J.jsonl_scan(spark, f"{tmp_path}/r", "id bigint").count() == 1


def test_report_is_one_file_and_survives_a_failed_write(spark, tmp_path):
    path = tmp_path / "deep" / "er" / "report.json"
    for n in (1, 2):
        J.json_report_sink(spark.range(1).selectExpr(f"{n} AS n", "cast(null as string) AS note"), str(path))
        assert json.loads(path.read_text()) == {"n": n, "note": None}
    with pytest.raises(PySparkException):
        J.json_report_sink(spark.range(1).selectExpr("raise_error('no') AS n"), str(path))
    assert json.loads(path.read_text())["n"] == 2
    assert [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["report.json"]


def test_all_missing_files_are_named(spark):
    wanted = [f"f{i:02}.json" for i in range(30)]
    listing = spark.createDataFrame([("a/f00.json",)], "path string")
    with pytest.raises(FileNotFoundError) as error:
        J.require_complete(J.landing_manifest(listing, wanted))
    assert all(name in str(error.value) for name in wanted[1:]) and "f00" not in str(error.value)


def test_fingerprint_of_many_rows(spark):
    """Sums stay exact beyond 64 bits."""
    rows = spark.range(64).select(F.lit("s").alias("split"), F.lit("x").alias("v"))
    one = int(T.dataset_fingerprint(rows.limit(1), ["v"], ["split"]).first().hash_sum)
    assert 64 * one > 2**62 and int(T.dataset_fingerprint(rows, ["v"], ["split"]).first().hash_sum) == 64 * one


def test_json_documents_keep_order(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"x": 3},\n {"x": 1}, {"x": 2, "y": 1}]')
    rows = J.json_doc_scan(spark, str(tmp_path / "d.json"), "x INT").orderBy("row_ord").collect()
    assert [(r.source, r.row_ord, r.x) for r in rows] == [("d.json", 0, 3), ("d.json", 1, 1), ("d.json", 2, 2)]


def test_broken_json_fails(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"x": 1}\n\n   \n{"x": 2}\n')
    assert J.jsonl_scan(spark, str(tmp_path / "l.json"), "x INT").count() == 2
    (tmp_path / "l.json").write_text('{"x": 1}\n{"x": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        J.jsonl_scan(spark, str(tmp_path / "l.json"), "x INT").collect()
    (tmp_path / "d.json").write_text('[{"x": 1}')
    with pytest.raises(Exception, match="(?i)malformed"):
        J.json_doc_scan(spark, str(tmp_path / "d.json"), "x INT").collect()


def test_manifest_and_limit(spark, tmp_path):
    listing = spark.createDataFrame(
        [("a/tables.json",), ("b/tables.json",), ("__MACOSX/dev.json",), ("x/other.json",)], "path string"
    )
    manifest = J.landing_manifest(listing, ["tables.json", "dev.json"])
    got = {r.name: (r.path, r.missing) for r in manifest.collect()}
    with pytest.raises(FileNotFoundError, match="dev.json"):
        J.require_complete(manifest)
    assert got == {"tables.json": ("b/tables.json", False), "dev.json": (None, True)}
    (tmp_path / "f.bin").write_bytes(b"x")
    assert J.file_listing(spark, str(tmp_path)).first()["path"].endswith("f.bin")
    assert J.limit_scan(spark.range(5), ["id"], 0).count() == 0
    assert J.limit_scan(spark.range(5), ["id"]).count() == 5
