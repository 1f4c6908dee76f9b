"""Queries over sources, catalogs and pairs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairforge.functions.scratch import scratch_path
from pairforge.operators import catalog as C, pairs as P
from pairforge.sources import json_files as J
from workload.inputs import table
from workload.registry import query

PAIR_SCHEMA = "row_ord BIGINT, split STRING, source STRING, db_id STRING, question STRING, query STRING"
PAIR_COLUMNS = ["row_ord", "split", "source", "db_id", "question", "query"]


def ordered_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with the order of their source within the split."""
    source_ord = F.when(F.col("source") == "b.json", 1).otherwise(0)
    return table(spark, sf, "pairs").withColumn("source_ord", source_ord)


def clean_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return P.with_pair_id(P.pairs_clean(ordered_pairs(spark, sf)))


def unique_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return P.pairs_dedup(clean_pairs(spark, sf))


def base_entries(spark: SparkSession) -> DataFrame:
    bodies = [F.lit(json.dumps({"db_id": name, **entry})) for name, entry in ENTRIES.items()]
    rows = spark.range(1).select(F.explode(F.array(*bodies)).alias("body"))
    return rows.select(F.from_json("body", C.RAW_ENTRY, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def label_catalogs(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogs of all databases that pairs ask: the base ones under every block number, or as they are without data."""
    base = C.catalogs_from_entries(base_entries(spark))
    if not sf:
        return base
    blocks = table(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 20).cast("string").alias("block")).distinct()
    every = F.explode(F.array(*[F.lit(name) for name in ENTRIES]))
    numbered = blocks.select("block", every.alias("base"))
    named = numbered.join(F.broadcast(base.withColumnRenamed("db_id", "base")), "base")
    return named.withColumn("db_id", F.concat_ws("_", "base", "block")).select(*base.columns)


# ---- sources and sinks

TURN = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


@query(
    "json_doc_scan",
    """SELECT conv_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id // 100, turn // 100 ORDER BY conv_id, turn) - 1 AS row_ord
    FROM conversations""",
)
def json_doc_scan(spark, sf):
    path = scratch_path(spark, "documents")
    turn = F.struct("conv_id", "turn", "role", "text")
    # A document holds at most 100 turns of each of 100 conversations.
    ranges = [F.floor(F.col(c) / 100).alias(f"{c}_range") for c in ("conv_id", "turn")]
    docs = table(spark, sf, "conversations").groupBy(*ranges).agg(
        F.to_json(F.array_sort(F.collect_list(turn))).alias("value")
    )
    # Several documents per folder, each in a file of its own.
    docs.select("value", F.pmod(F.xxhash64("conv_id_range", "turn_range"), F.lit(16)).alias("folder")).write.option(
        "maxRecordsPerFile", 1
    ).partitionBy("folder").text(path)
    return J.json_doc_scan(spark, path, TURN).drop("source")


@query("jsonl_scan", "SELECT row_ord, split, source, db_id, question, query FROM pairs")
def jsonl_scan(spark, sf):
    path = scratch_path(spark, "lines")
    J.jsonl_sink(table(spark, sf, "pairs").select(*PAIR_COLUMNS), path)
    return J.jsonl_scan(spark, path, PAIR_SCHEMA)


@query(
    "json_report_sink",
    """SELECT count(*) AS total, count(DISTINCT db_id) AS databases,
    cast(sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS val_rows FROM pairs""",
)
def json_report_sink(spark, sf):
    path = scratch_path(spark, "report")
    report = table(spark, sf, "pairs").agg(
        F.count("*").alias("total"), F.count_distinct("db_id").alias("databases"),
        F.struct(F.count_if(F.col("split") == "val").alias("val")).alias("rows"),
    )
    J.json_report_sink(report, path)
    schema = "total BIGINT, databases BIGINT, rows STRUCT<val: BIGINT>"
    return J.jsonl_scan(spark, path, schema).select(
        "total", "databases", F.col("rows.val").alias("val_rows")
    )


@query("jsonl_sink", "SELECT count(*) AS written, count(*) AS read_back FROM pairs")
def jsonl_sink(spark, sf):
    path = scratch_path(spark, "lines")
    written = J.jsonl_sink(table(spark, sf, "pairs").select(*PAIR_COLUMNS), path)
    return J.jsonl_scan(spark, path, PAIR_SCHEMA).agg(
        F.lit(written).cast("bigint").alias("written"), F.count("*").alias("read_back")
    )


@query("split_sink", "SELECT row_ord, split, source, db_id, question, query FROM pairs")
def split_sink(spark, sf):
    path = scratch_path(spark, "splits")
    J.split_sink(table(spark, sf, "pairs").select(*PAIR_COLUMNS), path)
    return J.jsonl_scan(spark, path, PAIR_SCHEMA)


WANTED = [f"{lang}_{i}.json" for lang in ("en", "fr", "de", "es") for i in range(20)] + ["none.json"]


@query(
    "landing_manifest",
    """SELECT w.name AS name, f.path AS path, f.path IS NULL AS missing
    FROM wanted w LEFT JOIN found f ON w.name = f.name""",
    wanted="SELECT unnest([" + ", ".join(f"'{w}'" for w in WANTED) + "]) AS name",
    found="""SELECT regexp_extract(path, '([^/]+)$', 1) AS name, max_by(path, ord) AS path FROM landing
    WHERE NOT starts_with(path, '__MACOSX') GROUP BY 1""",
)
def landing_manifest(spark, sf):
    return J.landing_manifest(table(spark, sf, "landing"), WANTED, "ord")


@query(
    "limit_scan",
    """SELECT row_ord, split, source, question FROM pairs WHERE split = 'train'
    ORDER BY CASE source WHEN 'b.json' THEN 1 ELSE 0 END, row_ord LIMIT 200""",
)
def limit_scan(spark, sf):
    rows = ordered_pairs(spark, sf).where("split = 'train'")
    return J.limit_scan(rows, ["source_ord", "row_ord"], 200).select(
        "row_ord", "split", "source", "question"
    )


# ---- catalogs

# The base catalogs as index-coded entries; keys come as numbers and as lists.
ENTRIES = {
    "sales": {
        "table_names_original": ["customer", "orders", "lineitem"],
        "column_names_original": [
            [-1, "*"], [0, "c_custkey"], [0, "c_name"], [0, "c_nationkey"], [0, "c_mktsegment"],
            [0, "c_acctbal"], [1, "o_orderkey"], [1, "o_custkey"], [1, "o_orderstatus"],
            [1, "o_totalprice"], [1, "o_orderdate"], [1, "o_orderpriority"], [2, "l_orderkey"],
            [2, "l_linenumber"], [2, "l_partkey"], [2, "l_quantity"], [2, "l_extendedprice"],
            [2, "l_shipdate"],
        ],
        "column_types": [
            "text", "number", "text", "number", "text", "number", "number", "number", "text",
            "number", "time", "text", "number", "number", "number", "number", "number", "time",
        ],
        "primary_keys": [1, 6, [12, 13]],
        "foreign_keys": [[7, 1], [12, 6]],
    },
    "geo": {
        "table_names_original": ["region", "nation", "supplier"],
        "column_names_original": [
            [-1, "*"], [0, "r_regionkey"], [0, "r_name"], [1, "n_nationkey"], [1, "n_name"],
            [1, "n_regionkey"], [2, "s_suppkey"], [2, "s_name"], [2, "s_nationkey"], [2, "s_acctbal"],
        ],
        "column_types": [
            "text", "number", "text", "number", "text", "number", "number", "text", "number", "number",
        ],
        "primary_keys": [1, 3, 6],
        "foreign_keys": [[5, 1], [8, 3]],
    },
    "web": {
        "table_names_original": ["events", "sessions"],
        "column_names_original": [
            [-1, "*"], [0, "event_id"], [0, "user_id"], [0, "event_type"], [0, "value"], [0, "ts"],
            [0, "name"], [1, "session_id"], [1, "user_id"], [1, "name"],
        ],
        "column_types": [
            "text", "number", "number", "text", "number", "time", "others", "number", "number", "text",
        ],
        "primary_keys": [[1], 7],
        "foreign_keys": [],
    },
}


def raw_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Index-coded catalog entries, one per database."""
    base = base_entries(spark).withColumnRenamed("db_id", "base")
    named = table(spark, sf, "dbs").join(F.broadcast(base), "base")
    return named.select("db_id", *[c for c in base.columns if c != "base"])


@query(
    "catalog_columns",
    """SELECT db_id, table_ord, table_name, cast(col_idx AS INTEGER) AS col_idx, column_name, column_type,
    is_primary_key FROM db_columns""",
)
def catalog_columns(spark, sf):
    return C.catalog_columns(raw_entries(spark, sf))


@query(
    "catalog_primary_keys",
    """SELECT db_id, table_name, column_name, cast(col_idx AS INTEGER) AS col_idx
    FROM db_columns WHERE is_primary_key""",
)
def catalog_primary_keys(spark, sf):
    return C.catalog_primary_keys(raw_entries(spark, sf))


@query(
    "catalog_foreign_keys",
    "SELECT db_id, fk_ord, table_name, column_name, ref_table, ref_column FROM db_fks",
)
def catalog_foreign_keys(spark, sf):
    return C.catalog_foreign_keys(raw_entries(spark, sf))


@query(
    "catalog_unique_db",
    """SELECT db_id, count(*) AS entries FROM
    (SELECT db_id FROM dbs UNION ALL SELECT db_id FROM dbs WHERE s_suppkey % 10 = 0) d
    GROUP BY db_id HAVING count(*) > 1""",
)
def catalog_unique_db(spark, sf):
    entries = raw_entries(spark, sf)
    again = entries.where(F.regexp_extract("db_id", "_([0-9]+)$", 1).cast("int") % 10 == 0)
    return C.duplicate_databases(entries.unionByName(again))


@query(
    "catalog_type_map",
    """SELECT db_id, table_name, column_name, CASE column_type WHEN 'number' THEN 'NUMERIC'
    WHEN 'time' THEN 'TIMESTAMP' WHEN 'boolean' THEN 'BOOLEAN' ELSE 'TEXT' END AS sql_type FROM db_columns""",
)
def catalog_type_map(spark, sf):
    return C.catalog_columns(raw_entries(spark, sf)).select(
        "db_id", "table_name", "column_name", C.sql_type(F.col("column_type")).alias("sql_type")
    )


@query(
    "catalog_case_map",
    """SELECT db_id, lower(table_name) AS lookup_name, max_by(table_name, table_ord) AS table_name FROM
    (SELECT db_id, table_ord, table_name FROM db_columns
     UNION ALL SELECT db_id, table_ord + 10, upper(table_name) FROM db_columns WHERE db_id LIKE 'geo%') t
    GROUP BY 1, 2""",
)
def catalog_case_map(spark, sf):
    tables = C.catalog_columns(raw_entries(spark, sf)).select("db_id", "table_ord", "table_name")
    doubled = tables.where("db_id LIKE 'geo%'").select(
        "db_id", (F.col("table_ord") + 10).alias("table_ord"), F.upper("table_name").alias("table_name")
    )
    return C.table_lookup(tables.unionByName(doubled))


DB_LINES = """SELECT db_id, table_ord, table_name, string_agg(column_name, ', ' ORDER BY col_idx) AS names,
 string_agg(concat(column_name, ' ', column_type, CASE WHEN is_primary_key THEN ' primary key' ELSE '' END), ', ' ORDER BY col_idx) AS typed
 FROM db_columns GROUP BY db_id, table_ord, table_name"""


@query(
    "schema_text_compact",
    """SELECT db_id, string_agg(concat(table_name, '(', names, ')'), ' | ' ORDER BY table_ord) AS schema_text
    FROM db_lines GROUP BY db_id""",
    db_lines=DB_LINES,
)
def schema_text_compact(spark, sf):
    nested = C.catalogs_from_entries(raw_entries(spark, sf))
    text = C.schema_text(F.col("tables"), F.col("foreign_keys"), style="compact")
    return nested.select("db_id", text.alias("schema_text"))


@query(
    "schema_text_verbose",
    """SELECT db_id, string_agg(line, chr(10) ORDER BY part, ord) AS schema_text FROM (
     SELECT db_id, 0 AS part, table_ord AS ord, concat('table ', table_name, ' (', typed, ')') AS line FROM db_lines
     UNION ALL SELECT db_id, 1, fk_ord, concat('foreign key ', table_name, '.', column_name, ' references ', ref_table, '.', ref_column) FROM db_fks) l
    GROUP BY db_id""",
    db_lines=DB_LINES,
)
def schema_text_verbose(spark, sf):
    nested = C.catalogs_from_entries(raw_entries(spark, sf))
    text = C.schema_text(F.col("tables"), F.col("foreign_keys"))
    return nested.select("db_id", text.alias("schema_text"))


@query(
    "config_flatten",
    """SELECT event_id, 'event.type' AS key, event_type AS value FROM events
    UNION ALL SELECT event_id, 'event.user.id', cast(user_id AS VARCHAR) FROM events
    UNION ALL SELECT event_id, 'props.k', json_extract_string(props, '$.k') FROM events""",
)
def config_flatten(spark, sf):
    nested = table(spark, sf, "events").select(
        "event_id",
        F.struct(
            F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user")
        ).alias("event"),
        F.from_json("props", "k INT").alias("props"),
    )
    return C.flatten_settings(nested, ["event_id"], ["event", "props"])


# ---- pairs

@query(
    "pairs_union",
    """SELECT row_ord, split, source, CASE source WHEN 'b.json' THEN 1 WHEN 'c.json' THEN 2 ELSE 0 END AS source_ord,
    db_id, question, query FROM pairs""",
)
def pairs_union(spark, sf):
    rows = table(spark, sf, "pairs")
    sources = [("train", "a.json"), ("train", "b.json"), ("val", "c.json")]
    return P.pairs_union(
        [(split, name, rows.where(F.col("source") == name)) for split, name in sources]
    )


@query(
    "pairs_clean",
    """SELECT row_ord, db_id, trim(question) AS question, trim(query) AS query FROM pairs
    WHERE trim(question) <> '' AND trim(query) <> ''""",
)
def pairs_clean(spark, sf):
    return P.pairs_clean(ordered_pairs(spark, sf)).select("row_ord", "db_id", "question", "query")


@query("pair_id", "SELECT row_ord, id FROM clean_pairs")
def pair_id(spark, sf):
    return clean_pairs(spark, sf).select("row_ord", "id")


@query("pairs_dedup", "SELECT split, id, source, row_ord, db_id, question, query FROM unique_pairs")
def pairs_dedup(spark, sf):
    return unique_pairs(spark, sf).select(
        "split", "id", "source", "row_ord", "db_id", "question", "query"
    )


@query(
    "split_leakage",
    """SELECT id, count(DISTINCT split) AS splits FROM (
      SELECT split, substr(sha256(concat(db_id, chr(0), regexp_replace(question, '[0-9]+', '#', 'g'), chr(0),
       regexp_replace(query, '[0-9]+', '#', 'g'))), 1, 16) AS id FROM clean_pairs) p
    GROUP BY id HAVING count(DISTINCT split) > 1""",
)
def split_leakage(spark, sf):
    blanked = clean_pairs(spark, sf).withColumns(
        {c: F.regexp_replace(c, "[0-9]+", "#") for c in ("question", "query")}
    )
    return P.split_leakage(P.with_pair_id(blanked))
