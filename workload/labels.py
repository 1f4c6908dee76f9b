"""Queries over column-usage labels, quality gates and training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairforge.functions.joins import lookup_join
from pairforge.operators import catalog as C, gates as G, statements as S, training as T, usage as U
from pairforge.plans import label_job as L
from workload.corpus import clean_pairs, label_catalogs, unique_pairs
from workload.inputs import table
from workload.registry import query

ORDER = ["source_ord", "row_ord"]


def labels(spark: SparkSession, sf: str, catalogs: DataFrame | None = None) -> DataFrame:
    return L.label_pairs(unique_pairs(spark, sf), label_catalogs(spark, sf) if catalogs is None else catalogs)


def details(spark: SparkSession, sf: str, *parts: str) -> DataFrame:
    """Readable statements only, with what was found in them."""
    found = L.statement_details(
        unique_pairs(spark, sf), label_catalogs(spark, sf), ["problem", "tokens", *parts]
    )
    return found.where("problem IS NULL AND tokens IS NOT NULL")


def with_catalog(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    return lookup_join(rows, label_catalogs(spark, sf), ["db_id"], "inner", salt_on=["id"])


# ---- labels

@query(
    "pair_schema_lookup",
    """SELECT id, split, db_id, base IN (SELECT db_id FROM catalog_columns) AS known FROM unique_pairs""",
)
def pair_schema_lookup(spark, sf):
    found = L.pair_schema_lookup(unique_pairs(spark, sf), label_catalogs(spark, sf))
    return found.select("id", "split", "db_id", "known")


SQL_TOKEN = (
    r"--[^\n]*|/\*[\s\S]*?\*/|''[^'']*''|\"[^\"]*\"|`[^`]*`|\[[^\]]*\]"
    r"|[\p{L}_][\p{L}\p{N}_$]*|[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
    r"|<=|>=|<>|!=|==|\|\||\S"
).replace('\\"', '"')
TOKEN_ROWS = f"""SELECT row_ord, generate_subscripts(toks, 1) - 1 AS pos, unnest(toks) AS token FROM
 (SELECT row_ord, regexp_extract_all(query, '{SQL_TOKEN}') AS toks FROM unique_pairs) q"""


@query(
    "sql_tokens",
    """SELECT row_ord, cast(pos AS INTEGER) AS pos, token,
    CASE WHEN token LIKE '''%''' THEN 'string' WHEN token LIKE '"%"' THEN 'quoted'
     WHEN regexp_matches(token, '^[0-9]') THEN 'number' WHEN regexp_matches(token, '^[A-Za-z_]') THEN 'word'
     ELSE 'punct' END AS kind FROM token_rows""",
    token_rows=TOKEN_ROWS,
)
def sql_tokens(spark, sf):
    tokens = unique_pairs(spark, sf).select(
        "row_ord", F.posexplode(S.raw_tokens(F.col("query"))).alias("pos", "token")
    )
    return tokens.withColumn("kind", S.token_kind(F.col("token")))


@query(
    "sql_sources",
    "SELECT id, split, alias, table_name FROM unique_pairs p JOIN by_template t ON p.k = t.k",
    by_template="""SELECT * FROM (VALUES
    (0,'customer','customer'),(1,'t1','customer'),(1,'t2','orders'),(2,'orders','orders'),(3,'customer','customer'),
    (4,'customer','customer'),(4,'orders','orders'),(5,'c','customer'),(5,'o','orders'),(6,'nation','nation'),(6,'region','region'),
    (7,'supplier','supplier'),(7,'n','nation'),(8,'nation','nation'),(9,'supplier','supplier'),(10,'s','supplier'),(10,'n','nation'),
    (11,'events','events'),(11,'sessions','sessions'),(12,'events','events'),(18,'orders','orders'),(18,'lineitem','lineitem'),
    (19,'customer','customer'),(19,'orders','orders')) AS v(k, alias, table_name)""",
)
def sql_sources(spark, sf):
    rows = details(spark, sf, "sources").select("id", "split", F.inline("sources"))
    return rows.where("table_name IS NOT NULL").select("id", "split", "alias", "table_name").distinct()


COLUMNS_SQL = """SELECT id, split, table_name, unnest(string_split(columns, ',')) AS column_name
 FROM unique_pairs p JOIN by_template t ON p.k = t.k"""


@query(
    "sql_qualified_columns",
    COLUMNS_SQL,
    by_template="""SELECT * FROM (VALUES
    (1,'customer','c_name,c_custkey'),(1,'orders','o_totalprice,o_custkey,o_orderkey'),
    (5,'customer','c_name,c_custkey'),(5,'orders','o_custkey,o_orderkey'),(7,'nation','n_name,n_nationkey'),
    (10,'supplier','s_nationkey'),(10,'nation','n_nationkey,n_name'),(11,'events','user_id'),(11,'sessions','user_id'),
    (19,'customer','c_name')) AS v(k, table_name, columns)""",
)
def sql_qualified_columns(spark, sf):
    return details(spark, sf, "qualified").select("id", "split", F.inline("qualified")).distinct()


@query(
    "sql_star",
    COLUMNS_SQL,
    by_template="""SELECT * FROM (VALUES
    (3,'customer','c_custkey,c_name,c_nationkey,c_mktsegment,c_acctbal'),
    (10,'supplier','s_suppkey,s_name,s_nationkey,s_acctbal')) AS v(k, table_name, columns)""",
)
def sql_star(spark, sf):
    return details(spark, sf, "stars").select("id", "split", F.inline("stars")).distinct()


@query(
    "sql_unqualified_columns",
    COLUMNS_SQL,
    by_template="""SELECT * FROM (VALUES
    (0,'customer','c_name,c_custkey'),(3,'customer','c_custkey'),
    (4,'customer','c_name,c_custkey'),(4,'orders','o_custkey,o_orderkey'),(6,'nation','n_name,n_nationkey'),(6,'region','r_name'),
    (7,'supplier','s_nationkey,s_acctbal,s_suppkey'),(8,'nation','n_name,n_regionkey,n_nationkey'),(9,'supplier','s_name'),
    (11,'events','event_id'),(12,'events','event_type,event_id'),
    (18,'orders','o_orderdate,o_orderkey'),(18,'lineitem','l_orderkey,l_quantity'),(19,'orders','o_totalprice'))
    AS v(k, table_name, columns)""",
)
def sql_unqualified_columns(spark, sf):
    return details(spark, sf, "bare").select("id", "split", F.inline("bare")).distinct()


@query(
    "used_columns",
    """SELECT p.id AS id, p.split AS split, table_name, column_name FROM unique_pairs p
    JOIN expected_columns e ON p.k = e.k WHERE e.method = 'parser'""",
)
def used_columns(spark, sf):
    return U.used_rows(details(spark, sf, "used"), "used", ["id", "split"])


@query(
    "token_fallback",
    """SELECT p.row_ord AS row_ord, c.table_name AS table_name, c.column_name AS column_name FROM words p
    JOIN catalog_columns c ON p.base = c.db_id
    WHERE list_contains(words, lower(c.table_name)) AND list_contains(words, lower(c.column_name))
    UNION ALL SELECT p.row_ord, t.table_name, NULL FROM words p
    JOIN (SELECT db_id, table_name, list(lower(column_name)) AS cols FROM catalog_columns GROUP BY db_id, table_name) t ON p.base = t.db_id
    WHERE list_contains(words, lower(t.table_name)) AND NOT list_has_any(words, cols)""",
    words="""SELECT row_ord, base, list_transform(string_split_regex(translate(query, '.=', '  '), '\\s+'),
      lambda w: lower(trim(w, '`"''(),;'))) AS words FROM clean_pairs""",
)
def token_fallback(spark, sf):
    catalogs = label_catalogs(spark, sf)
    pairs = lookup_join(clean_pairs(spark, sf), catalogs, ["db_id"], "inner", salt_on=["id"])
    matched = pairs.select(
        "row_ord", U.token_fallback(F.col("query"), C.lower_tables(F.col("tables"))).alias("used")
    )
    return U.used_rows(matched, "used", ["row_ord"])


@query(
    "extraction_route",
    """SELECT id, split, CASE WHEN k = 13 THEN 'fallback' WHEN k IN (14, 15) THEN NULL ELSE 'parser' END AS method,
    CASE k WHEN 14 THEN 'fallback found no tables: unbalanced parentheses' WHEN 15 THEN 'unknown db_id' END AS reason
    FROM unique_pairs""",
)
def extraction_route(spark, sf):
    return labels(spark, sf).select("id", "split", "method", "reason")


@query(
    "fk_closure",
    """SELECT p.id AS id, p.split AS split, c.table_name AS table_name, c.column_name AS column_name
    FROM labeled p JOIN closed c ON p.k = c.k
    WHERE c.column_name IS NOT NULL OR NOT EXISTS (SELECT 1 FROM closed d WHERE d.k = c.k AND d.table_name = c.table_name AND d.column_name IS NOT NULL)""",
)
def fk_closure(spark, sf):
    rows = with_catalog(spark, sf, labels(spark, sf).where("method IS NOT NULL"))
    closed = rows.withColumn("closed", U.fk_closure(F.col("used"), F.col("foreign_keys")))
    return U.used_rows(closed, "closed", ["id", "split"])


@query(
    "pk_retention",
    """SELECT id, split, table_name, column_name FROM labeled p JOIN (
     SELECT k, table_name, column_name FROM expected_columns WHERE column_name IS NOT NULL
     UNION SELECT k, table_name, column_name FROM kept WHERE is_primary_key) u ON p.k = u.k""",
)
def pk_retention(spark, sf):
    rows = with_catalog(spark, sf, labels(spark, sf).where("method IS NOT NULL"))
    kept = rows.withColumn("kept", U.pk_retention(F.col("used"), F.col("tables")))
    return U.used_rows(kept, "kept", ["id", "split"])


@query(
    "prune_catalog",
    """SELECT id, split, cast(dense_rank() OVER (PARTITION BY p.split, p.id ORDER BY table_ord) - 1 AS INTEGER) AS table_ord,
     cast(row_number() OVER (PARTITION BY p.split, p.id, table_ord ORDER BY col_ord) - 1 AS INTEGER) AS col_ord,
     table_name, column_name, column_type, is_primary_key FROM labeled p JOIN kept c ON p.k = c.k""",
)
def prune_catalog(spark, sf):
    tables = labels(spark, sf).where("method IS NOT NULL").select(
        "id", "split", F.posexplode("pruned_schema.tables").alias("table_ord", "t")
    )
    columns = tables.select(
        "id", "split", "table_ord", F.col("t.name").alias("table_name"),
        F.posexplode("t.columns").alias("col_ord", "c"),
    )
    return columns.select(
        "id", "split", "table_ord", "col_ord", "table_name", F.col("c.name").alias("column_name"),
        F.col("c.type").alias("column_type"), F.col("c.is_primary_key").alias("is_primary_key"),
    )


@query(
    "prune_fks",
    """SELECT id, split, cast(row_number() OVER (PARTITION BY p.split, p.id ORDER BY fk_ord) - 1 AS INTEGER) AS fk_ord,
    table_name, column_name, ref_table, ref_column FROM labeled p JOIN kept_fks f ON p.k = f.k""",
)
def prune_fks(spark, sf):
    keys = labels(spark, sf).where("method IS NOT NULL").select(
        "id", "split", F.posexplode("pruned_schema.foreign_keys").alias("fk_ord", "f")
    )
    return keys.select(
        "id", "split", "fk_ord", F.col("f.table").alias("table_name"),
        F.col("f.column").alias("column_name"), F.col("f.ref_table").alias("ref_table"),
        F.col("f.ref_column").alias("ref_column"),
    )


@query(
    "label_rows",
    """SELECT p.id AS id, p.split AS split, p.db_id AS db_id, p.question AS question, p.query AS query, p.source AS source,
    t.tables AS tables, t.target AS columns, p.method AS extraction_method FROM labeled p JOIN targets t ON p.k = t.k""",
)
def label_rows(spark, sf):
    rows = L.label_rows(labels(spark, sf))
    return rows.select(
        "id", "split", "db_id", "question", "query", "source",
        F.array_join("tables", ",").alias("tables"),
        T.target_text(F.col("tables"), F.col("columns")).alias("columns"), "extraction_method",
    )


REPORT = """SELECT split, count(*) AS total,
 cast(sum(CASE WHEN k NOT IN (14, 15) THEN 1 ELSE 0 END) AS BIGINT) AS labeled,
 cast(sum(CASE WHEN k NOT IN (13, 14, 15) THEN 1 ELSE 0 END) AS BIGINT) AS parser,
 cast(sum(CASE WHEN k = 13 THEN 1 ELSE 0 END) AS BIGINT) AS fallback,
 cast(sum(CASE WHEN k = 14 THEN 1 ELSE 0 END) AS BIGINT) AS extraction_failed,
 cast(sum(CASE WHEN k = 15 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_db FROM unique_pairs GROUP BY split"""


@query("label_report", "SELECT * FROM report", report=REPORT)
def label_report(spark, sf):
    return L.label_report(labels(spark, sf))


@query(
    "failure_sample",
    """SELECT split, cast(rn AS INTEGER) AS rank, id, reason FROM (SELECT split, id,
     CASE k WHEN 14 THEN 'fallback found no tables: unbalanced parentheses' ELSE 'unknown db_id' END AS reason,
     row_number() OVER (PARTITION BY split ORDER BY source_ord, row_ord) AS rn FROM unique_pairs WHERE k IN (14, 15)) f
    WHERE rn <= 50""",
)
def failure_sample(spark, sf):
    return L.failure_sample(labels(spark, sf), ORDER).select("split", "rank", "id", "reason")


# ---- gates

def spoiled_rows(found: DataFrame) -> DataFrame:
    """Pairs of the label job, some labels made invalid by template."""
    kept = found.withColumn("_n", U.pruned_names(F.col("pruned_schema")))
    tables, k = F.col("_n.tables"), F.col("k")
    return kept.select(
        "id", "split", "row_ord", "source_ord", "k", "query", "known", "method",
        F.when(k == 12, "gone").otherwise(F.col("db_id")).alias("db_id"),
        F.when(k == 0, " \t ").otherwise(F.col("question")).alias("question"),
        F.when(k == 3, F.slice(tables, 1, 0))
        .when(k == 6, F.transform(tables, lambda t: F.concat(t, F.lit("x"))))
        .otherwise(tables).alias("tables"),
        F.when(k == 8, F.transform_values("_n.columns", lambda t, c: F.concat(c, F.array(F.lit("zz")))))
        .otherwise(F.col("_n.columns")).alias("columns"),
    )


SPOILED = """SELECT id, split, row_ord, source_ord, CASE k WHEN 0 THEN 'empty question or query' WHEN 3 THEN 'no tables in label'
 WHEN 6 THEN 'table regionx not in schema' WHEN 8 THEN 'column nation.zz not in schema'
 WHEN 12 THEN 'unknown db_id gone' END AS error FROM labeled"""
RATES = """SELECT r.split AS split, v.examples AS examples, v.invalid_examples AS invalid_examples,
 (extraction_failed + unknown_db) / greatest(total, 1) AS failure_rate, fallback / greatest(total, 1) AS fallback_rate
 FROM report r JOIN (SELECT split, count(*) AS examples, count(error) AS invalid_examples FROM spoiled GROUP BY split) v
 ON r.split = v.split"""
METRICS = """SELECT split, examples, round_even(failure_rate, 4) AS extraction_failure_rate,
 round_even(fallback_rate, 4) AS fallback_rate, invalid_examples FROM rates"""
BROKEN = """SELECT split, 0 AS rule_ord, 'examples' AS rule, format('{}: only {} examples (min 5000)', split, examples) AS message
 FROM rates WHERE examples < 5000
 UNION ALL SELECT split, 1, 'failure_rate', format('{}: extraction failure rate {:.4f} > 0.02', split, failure_rate) FROM rates WHERE failure_rate > 0.02
 UNION ALL SELECT split, 2, 'fallback_rate', format('{}: fallback rate {:.4f} > 0.05', split, fallback_rate) FROM rates WHERE fallback_rate > 0.05
 UNION ALL SELECT split, 3, 'invalid', format('{}: {} structurally invalid examples', split, invalid_examples) FROM rates WHERE invalid_examples > 0"""


def rates(spark: SparkSession, sf: str) -> DataFrame:
    catalogs = C.staged_catalogs(label_catalogs(spark, sf))
    return G.split_rates(G.validate_rows(spoiled_rows(labels(spark, sf, catalogs)), catalogs))


@query("validate_rows", "SELECT id, split, error FROM spoiled", spoiled=SPOILED)
def validate_rows(spark, sf):
    catalogs = C.staged_catalogs(label_catalogs(spark, sf))
    found = labels(spark, sf, catalogs).where("method IS NOT NULL")
    return G.validate_rows(spoiled_rows(found), catalogs).select("id", "split", "error")


@query("split_metrics", METRICS, report=REPORT, spoiled=SPOILED, rates=RATES)
def split_metrics(spark, sf):
    return G.split_metrics(rates(spark, sf))


@query("violations", BROKEN, report=REPORT, spoiled=SPOILED, rates=RATES)
def violations(spark, sf):
    return G.violations(rates(spark, sf), min_examples=5000)


VERDICT = """SELECT (SELECT string_agg(concat(split, '=', examples), ',' ORDER BY split) FROM metrics) AS splits,
 (SELECT coalesce(string_agg(message, chr(10) ORDER BY split, rule_ord), '') FROM broken) AS violations, (SELECT count(*) = 0 FROM broken) AS passed"""


def shown_verdict(verdict: DataFrame) -> DataFrame:
    shown = F.transform("splits", lambda s: F.concat(s["split"], F.lit("="), s["examples"].cast("string")))
    return verdict.select(
        F.array_join(shown, ",").alias("splits"),
        F.array_join("violations", "\n").alias("violations"), "passed",
    )


@query("gate_verdict", VERDICT, report=REPORT, spoiled=SPOILED, rates=RATES, metrics=METRICS, broken=BROKEN)
def gate_verdict(spark, sf):
    return shown_verdict(G.gate_verdict(rates(spark, sf), min_examples=5000))


@query(
    "gate_verdict_passed", VERDICT,
    report=REPORT, spoiled="SELECT split, CAST(NULL AS VARCHAR) AS error FROM labeled", rates=RATES, metrics=METRICS,
    broken=BROKEN.replace("5000", "1").replace("> 0.02", "> 0.2").replace("> 0.05", "> 0.2"),
)
def gate_verdict_passed(spark, sf):
    """The labels as they are, under limits that they keep."""
    catalogs = C.staged_catalogs(label_catalogs(spark, sf))
    rows = labels(spark, sf, catalogs)
    named = rows.withColumn("_n", U.pruned_names(F.col("pruned_schema"))).withColumns(
        {"tables": F.col("_n.tables"), "columns": F.col("_n.columns")}
    ).drop("_n")
    clean = G.split_rates(G.validate_rows(named, catalogs))
    return shown_verdict(G.gate_verdict(clean, min_examples=1, max_failure_rate=0.2, max_fallback_rate=0.2))


@query(
    "invalid_sample",
    """SELECT split, cast(rn AS INTEGER) AS rank, concat(id, ': ', error) AS line FROM (SELECT *,
     row_number() OVER (PARTITION BY split ORDER BY source_ord, row_ord) AS rn FROM spoiled WHERE error IS NOT NULL) s
    WHERE rn <= 10""",
    spoiled=SPOILED,
)
def invalid_sample(spark, sf):
    catalogs = C.staged_catalogs(label_catalogs(spark, sf))
    found = labels(spark, sf, catalogs).where("method IS NOT NULL")
    validated = G.validate_rows(spoiled_rows(found), catalogs)
    return G.invalid_sample(validated, ORDER)


MODEL_GATES = " UNION ALL ".join(
    f"""SELECT run_id, {i} AS gate_ord, '{m}' AS metric, coalesce(format('{m} {{:.4f}} {sign} {bound}', {m}), '{m} is missing') AS message
 FROM runs WHERE {m} {sign} {bound} OR {m} IS NULL"""
    for i, (m, sign, bound) in enumerate(
        [("table_recall", "<", 0.9), ("column_recall", "<", 0.8), ("unparseable_rate", ">", 0.01)]
    )
)


@query("model_gates", MODEL_GATES)
def model_gates(spark, sf):
    return G.model_gates(table(spark, sf, "runs"))


# ---- training rows

def ready_rows(spark: SparkSession, sf: str) -> DataFrame:
    catalogs = C.staged_catalogs(label_catalogs(spark, sf))
    return T.model_ready_rows(L.label_rows(labels(spark, sf, catalogs)), catalogs)


FULL_TEXT = """SELECT db_id, string_agg(line, chr(10) ORDER BY part, ord) AS full_schema_text FROM (
  SELECT db_id, 0 AS part, table_ord AS ord, concat('table ', table_name, ' (', string_agg(concat(column_name, ' ', column_type,
   CASE WHEN is_primary_key THEN ' primary key' ELSE '' END), ', ' ORDER BY col_ord), ')') AS line
   FROM catalog_columns GROUP BY db_id, table_ord, table_name
  UNION ALL SELECT db_id, 1, fk_ord, concat('foreign key ', table_name, '.', column_name, ' references ', ref_table, '.', ref_column)
   FROM catalog_fks) l GROUP BY db_id"""
PRUNED_TEXT = """SELECT k, string_agg(line, chr(10) ORDER BY part, ord) AS pruned_schema_text FROM (
  SELECT k, 0 AS part, table_ord AS ord, concat('table ', table_name, ' (', typed, ')') AS line FROM kept_lines
  UNION ALL SELECT k, 1, fk_ord, concat('foreign key ', table_name, '.', column_name, ' references ', ref_table, '.', ref_column)
   FROM kept_fks) l GROUP BY k"""


@query(
    "model_ready_rows",
    """SELECT p.id AS id, p.split AS split, p.db_id AS db_id, p.question AS question, p.query AS query,
     f.full_schema_text AS full_schema_text, s.pruned_schema_text AS pruned_schema_text, t.tables AS tables,
     t.target AS columns, p.method AS extraction_method, p.source AS source
    FROM labeled p JOIN full_text f ON p.base = f.db_id JOIN pruned_text s ON p.k = s.k JOIN targets t ON p.k = t.k""",
    full_text=FULL_TEXT, pruned_text=PRUNED_TEXT,
)
def model_ready_rows(spark, sf):
    return ready_rows(spark, sf).select(
        "id", "split", "db_id", "question", "query", "full_schema_text", "pruned_schema_text",
        F.array_join("tables", ",").alias("tables"),
        T.target_text(F.col("tables"), F.col("columns")).alias("columns"),
        "extraction_method", "source",
    )


@query("target_text", "SELECT p.id AS id, p.split AS split, t.target AS target FROM labeled p JOIN targets t ON p.k = t.k")
def target_text(spark, sf):
    rows = L.label_rows(labels(spark, sf))
    return rows.select("id", "split", T.target_text(F.col("tables"), F.col("columns")).alias("target"))


@query(
    "chat_messages",
    """SELECT p.id AS id, p.split AS split, 'system,user,assistant' AS roles, concat('Database schema:', chr(10), f.full_schema_text,
     chr(10), chr(10), 'Question: ', p.question) AS user_text, t.target AS target
    FROM labeled p JOIN full_text f ON p.base = f.db_id JOIN targets t ON p.k = t.k""",
    full_text=FULL_TEXT,
)
def chat_messages(spark, sf):
    target = T.target_text(F.col("tables"), F.col("columns"))
    messages = T.pruner_messages(F.col("question"), F.col("full_schema_text"), target)
    rows = ready_rows(spark, sf).withColumn("messages", messages)
    return rows.select(
        "id", "split", F.array_join("messages.role", ",").alias("roles"),
        F.get("messages.content", F.lit(1)).alias("user_text"),
        F.get("messages.content", F.lit(2)).alias("target"),
    )


MEASURED = r"SELECT doc_id, len(regexp_extract_all(text, '\w+|[^\w\s]')) AS n_tokens FROM documents"


@query(
    "overlength_drop",
    "SELECT doc_id, cast(n_tokens AS INTEGER) AS n_tokens FROM measured WHERE n_tokens <= 1024",
    measured=MEASURED,
)
def overlength_drop(spark, sf):
    kept, _ = T.overlength_drop(table(spark, sf, "documents"), T.token_count(F.col("text")))
    return kept.select("doc_id", "n_tokens")


@query(
    "overlength_report",
    "SELECT count(*) AS total, cast(sum(CASE WHEN n_tokens > 1024 THEN 1 ELSE 0 END) AS BIGINT) AS dropped FROM measured",
    measured=MEASURED,
)
def overlength_report(spark, sf):
    _, report = T.overlength_drop(table(spark, sf, "documents"), T.token_count(F.col("text")))
    return report


@query(
    "prompt_fingerprint",
    """SELECT conv_id, turn, substr(sha256(concat('v1', chr(10), role, chr(10), text)), 1, 16) AS prompt_hash
    FROM conversations""",
)
def prompt_fingerprint(spark, sf):
    prompt_hash = T.prompt_fingerprint(F.lit("v1"), F.col("role"), F.col("text"))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", prompt_hash.alias("prompt_hash")
    )


@query(
    "dataset_fingerprint",
    """SELECT split, count(*) AS n_rows, cast(sum(cast(concat('0x', substr(md5(concat_ws(chr(1), id, db_id, question, query)), 1, 15)) AS BIGINT)) AS VARCHAR) AS hash_sum
    FROM unique_pairs GROUP BY split""",
)
def dataset_fingerprint(spark, sf):
    found = T.dataset_fingerprint(
        unique_pairs(spark, sf), ["id", "db_id", "question", "query"], ["split"]
    )
    return found.withColumn("hash_sum", F.col("hash_sum").cast("string"))
