"""Input tables derived from the given tables, as SQL that Spark and DuckDB share."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()

INPUTS: dict[str, str] = {}

INPUTS["catalog_columns"] = """
SELECT * FROM (VALUES
('sales',0,'customer',0,'c_custkey','number',true),('sales',0,'customer',1,'c_name','text',false),('sales',0,'customer',2,'c_nationkey','number',false),('sales',0,'customer',3,'c_mktsegment','text',false),('sales',0,'customer',4,'c_acctbal','number',false),
('sales',1,'orders',0,'o_orderkey','number',true),('sales',1,'orders',1,'o_custkey','number',false),('sales',1,'orders',2,'o_orderstatus','text',false),('sales',1,'orders',3,'o_totalprice','number',false),('sales',1,'orders',4,'o_orderdate','time',false),('sales',1,'orders',5,'o_orderpriority','text',false),
('sales',2,'lineitem',0,'l_orderkey','number',true),('sales',2,'lineitem',1,'l_linenumber','number',true),('sales',2,'lineitem',2,'l_partkey','number',false),('sales',2,'lineitem',3,'l_quantity','number',false),('sales',2,'lineitem',4,'l_extendedprice','number',false),('sales',2,'lineitem',5,'l_shipdate','time',false),
('geo',0,'region',0,'r_regionkey','number',true),('geo',0,'region',1,'r_name','text',false),
('geo',1,'nation',0,'n_nationkey','number',true),('geo',1,'nation',1,'n_name','text',false),('geo',1,'nation',2,'n_regionkey','number',false),
('geo',2,'supplier',0,'s_suppkey','number',true),('geo',2,'supplier',1,'s_name','text',false),('geo',2,'supplier',2,'s_nationkey','number',false),('geo',2,'supplier',3,'s_acctbal','number',false),
('web',0,'events',0,'event_id','number',true),('web',0,'events',1,'user_id','number',false),('web',0,'events',2,'event_type','text',false),('web',0,'events',3,'value','number',false),('web',0,'events',4,'ts','time',false),('web',0,'events',5,'name','others',false),
('web',1,'sessions',0,'session_id','number',true),('web',1,'sessions',1,'user_id','number',false),('web',1,'sessions',2,'name','text',false)
) AS v(db_id, table_ord, table_name, col_ord, column_name, column_type, is_primary_key)
"""

INPUTS["catalog_fks"] = """
SELECT * FROM (VALUES
('sales',0,'orders','o_custkey','customer','c_custkey'),('sales',1,'lineitem','l_orderkey','orders','o_orderkey'),
('geo',0,'nation','n_regionkey','region','r_regionkey'),('geo',1,'supplier','s_nationkey','nation','n_nationkey')
) AS v(db_id, fk_ord, table_name, column_name, ref_table, ref_column)
"""

INPUTS["templates"] = """
SELECT * FROM (VALUES
(0,'sales','name of customer {n}','SELECT c_name FROM customer WHERE c_custkey = {n}'),
(1,'sales','customer and total of order {n}','SELECT T1.c_name, T2.o_totalprice FROM customer AS T1 JOIN orders AS T2 ON T1.c_custkey = T2.o_custkey WHERE T2.o_orderkey = {n}'),
(2,'sales','orders besides {n}','SELECT count(*) FROM orders'),
(3,'sales','all about customer {n}','SELECT * FROM customer WHERE c_custkey = {n}'),
(4,'sales','who placed order {n}','SELECT c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey = {n})'),
(5,'sales','buyers of order {n}','SELECT c.c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderkey = {n})'),
(6,'geo','nation {n} and all regions','SELECT n_name FROM nation WHERE n_nationkey = {n} UNION SELECT r_name FROM region'),
(7,'geo','balances above supplier {n}','WITH big AS (SELECT s_nationkey, s_acctbal FROM supplier WHERE s_suppkey > {n}) SELECT n.n_name, big.s_acctbal FROM nation n JOIN big ON big.s_nationkey = n.n_nationkey'),
(8,'geo','nations below {n}','SELECT x.n_name FROM (SELECT n_name, n_regionkey FROM nation WHERE n_nationkey < {n}) AS x'),
(9,'geo','supplier called acme {n}','SELECT s_name FROM supplier WHERE s_name = "acme {n}"'),
(10,'geo','suppliers in x{n}','SELECT S.* FROM SUPPLIER AS S JOIN Nation AS N ON S.S_NATIONKEY = N.N_NATIONKEY WHERE N.n_name = ''x{n}'''),
(11,'web','name for event {n}','SELECT name FROM events JOIN sessions ON events.user_id = sessions.user_id WHERE event_id = {n}'),
(12,'web','type of event {n}','SELECT event_type FROM events WHERE event_type = ''from sessions'' AND event_id = {n}'),
(13,'web','broken one {n}','SELEC name FORM sessions, WHERE session_id = {n}'),
(14,'web','hopeless one {n}','SELECT ((( FROM nowhere {n}'),
(15,'nodb','unknown database {n}','SELECT a FROM b WHERE c = {n}'),
(16,'sales','   ','SELECT c_name FROM customer WHERE c_custkey = {n}'),
(17,'sales','  name of customer {n} ','SELECT c_name FROM customer WHERE c_custkey = {n}  '),
(18,'sales','big lines over {n}','SELECT o_orderdate FROM orders, lineitem WHERE l_orderkey = o_orderkey AND l_quantity > {n}'),
(19,'sales','buyers over {n}','SELECT customer.c_name FROM customer JOIN orders WHERE o_totalprice > {n}')
) AS v(k, db_id, question, query)
"""

# A third of the blocks ask the databases numbered 0; each other block has databases of its own.
INPUTS["pairs"] = """
SELECT o_orderkey AS row_ord,
 CASE WHEN cast(floor(o_orderkey / 20) AS BIGINT) % 8 = 0 THEN 'val' ELSE 'train' END AS split,
 CASE WHEN cast(floor(o_orderkey / 20) AS BIGINT) % 8 = 0 THEN 'c.json' WHEN cast(floor(o_orderkey / 20) AS BIGINT) % 2 = 0 THEN 'a.json' ELSE 'b.json' END AS source,
 t.k AS k, t.db_id AS base, concat(t.db_id, '_', cast(CASE WHEN cast(floor(o_orderkey / 20) AS BIGINT) % 3 = 0 THEN 0 ELSE cast(floor(o_orderkey / 20) AS BIGINT) END AS VARCHAR(20))) AS db_id,
 replace(t.question, '{n}', cast(cast(floor(o_orderkey / 20) AS BIGINT) AS VARCHAR(20))) AS question,
 replace(t.query, '{n}', cast(cast(floor(o_orderkey / 20) AS BIGINT) AS VARCHAR(20))) AS query
FROM orders JOIN templates t ON o_orderkey % 20 = t.k
"""

# What a pruner should answer: the label of each template that has one, written by hand.
INPUTS["gold_targets"] = """
SELECT k, replace(gold, '{nl}', chr(10)) AS gold FROM (VALUES
(0,'customer(c_custkey, c_name)'),
(1,'customer(c_custkey, c_name){nl}orders(o_orderkey, o_custkey, o_totalprice)'),
(2,'orders(o_orderkey)'),
(3,'customer(c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal)'),
(4,'customer(c_custkey, c_name){nl}orders(o_orderkey, o_custkey)'),
(5,'customer(c_custkey, c_name){nl}orders(o_orderkey, o_custkey)'),
(6,'region(r_regionkey, r_name){nl}nation(n_nationkey, n_name, n_regionkey)'),
(7,'nation(n_nationkey, n_name){nl}supplier(s_suppkey, s_nationkey, s_acctbal)'),
(8,'nation(n_nationkey, n_name, n_regionkey)'),
(9,'supplier(s_suppkey, s_name)'),
(10,'nation(n_nationkey, n_name){nl}supplier(s_suppkey, s_name, s_nationkey, s_acctbal)'),
(11,'events(event_id, user_id){nl}sessions(session_id, user_id)'),
(12,'events(event_id, event_type)'),
(13,'sessions(session_id, name)'),
(16,'customer(c_custkey, c_name)'),
(17,'customer(c_custkey, c_name)'),
(18,'orders(o_orderkey, o_orderdate){nl}lineitem(l_orderkey, l_linenumber, l_quantity)'),
(19,'customer(c_custkey, c_name){nl}orders(o_orderkey, o_custkey, o_totalprice)')
) AS v(k, gold)
"""

INPUTS["completions"] = """
SELECT p.row_ord AS row_ord, p.split AS split, p.k AS k, cast(floor(p.row_ord / 20) AS BIGINT) % 7 AS variant, g.gold AS gold,
 CASE cast(floor(p.row_ord / 20) AS BIGINT) % 7
  WHEN 0 THEN g.gold
  WHEN 1 THEN concat('```', chr(10), g.gold, chr(10), '```')
  WHEN 2 THEN concat(replace(g.gold, chr(10), concat(',', chr(10))), ',')
  WHEN 3 THEN concat(g.gold, chr(10), 'extra_table(extra_col)')
  WHEN 4 THEN concat('I think: ', g.gold)
  WHEN 5 THEN upper(g.gold)
  ELSE concat('customer(c_name)', chr(10), g.gold, chr(10), 'customer(c_nationkey, c_name)') END AS reply
FROM pairs p JOIN gold_targets g ON p.k = g.k
"""

INPUTS["sql_replies"] = """
SELECT row_ord, k, cast(floor(row_ord / 20) AS BIGINT) % 5 AS variant, query,
 CASE cast(floor(row_ord / 20) AS BIGINT) % 5
  WHEN 0 THEN query
  WHEN 1 THEN concat('```sql', chr(10), query, ';', chr(10), '```')
  WHEN 2 THEN concat('The answer is: ', query, '; hope it helps')
  WHEN 3 THEN concat('With pleasure: ', query)
  ELSE 'no idea' END AS reply
FROM pairs
"""

INPUTS["presentations"] = """
SELECT p_partkey AS id, p_partkey % 8 AS variant, 'p_brand,total' AS cols,
 CASE p_partkey % 8
  WHEN 0 THEN concat('{"chart": {"type": "bar", "x": "p_brand", "y": ["total"], "series": null}, "answer": "part ', p_name, '"}')
  WHEN 1 THEN concat('```json', chr(10), '{"chart": null, "answer": "', p_type, '"}', chr(10), '```')
  WHEN 2 THEN '{"chart": {"type": "radar", "x": "p_brand", "y": ["total"]}, "answer": "a"}'
  WHEN 3 THEN '{"chart": {"type": "line", "x": "p_brand", "y": []}, "answer": "a"}'
  WHEN 4 THEN '{"chart": {"type": "line", "x": "p_brand", "y": ["nope"]}, "answer": "a"}'
  WHEN 5 THEN '{"chart": null, "answer": "  "}'
  WHEN 6 THEN '{"chart": null, "answer": }'
  ELSE 'sorry' END AS reply
FROM part
"""

# Three attempts per request; some come as the fourth, as if one before them was lost. A third of the requests belong to one busy thread.
INPUTS["attempts"] = """
SELECT event_id, CASE WHEN request_ord % 3 = 0 THEN 0 ELSE cast(floor(event_id / 60) AS BIGINT) END AS thread_id, request_ord, cast(event_id % 3 + 1 + CASE WHEN event_id % 3 = 0 AND event_id % 17 = 0 THEN 3 ELSE 0 END AS BIGINT) AS attempt_ord, ts,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE concat('SELECT ', cast(event_id AS VARCHAR(20))) END AS sql_text,
 CASE WHEN event_id % 22 = 0 THEN concat('no SQL in reply ', cast(event_id AS VARCHAR(20))) END AS generator_error,
 CASE event_type WHEN 'view' THEN 200 WHEN 'purchase' THEN 200 WHEN 'error' THEN 503 ELSE 422 END AS http_status,
 CASE event_type WHEN 'view' THEN '' WHEN 'purchase' THEN '' WHEN 'error' THEN 'oops' ELSE concat('{"detail": "no such column: x', cast(event_id AS VARCHAR(20)), '"}') END AS body
FROM (SELECT *, cast(floor(event_id / 3) AS BIGINT) AS request_ord FROM events) e
"""

# A model per customer; a third of the log belongs to one model.
INPUTS["alias_log"] = """
SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 3 = 0 THEN 'm0' ELSE concat('m', cast(o_custkey AS VARCHAR(20))) END AS model,
 CASE o_orderstatus WHEN 'O' THEN 'register' WHEN 'P' THEN 'promote' ELSE 'rejected' END AS action,
 o_orderkey + 1 AS version
FROM orders
"""

INPUTS["runs"] = """
SELECT s_suppkey AS run_id, CASE WHEN s_suppkey % 20 <> 7 THEN cast(85 + s_suppkey % 16 AS DOUBLE) / 100 END AS table_recall,
 CASE WHEN s_suppkey % 20 <> 9 THEN cast(75 + s_suppkey % 11 AS DOUBLE) / 100 END AS column_recall,
 CASE WHEN s_suppkey % 20 <> 11 THEN cast(s_suppkey % 3 AS DOUBLE) / 100 END AS unparseable_rate
FROM supplier
"""

INPUTS["landing"] = """
SELECT doc_id AS ord, concat(CASE WHEN doc_id % 17 = 0 THEN '__MACOSX/' ELSE '' END, source, '/', lang, '_', cast(doc_id % 50 AS VARCHAR(20)), '.json') AS path,
 CASE doc_id % 3 WHEN 0 THEN concat('mlflow-artifacts:/', source, '/model') WHEN 1 THEN concat('s3://bucket/', source) ELSE concat('file:/', source) END AS uri
FROM documents
"""

# What each statement template uses, written by hand: k, method, table, columns.
INPUTS["expected_used"] = """
SELECT * FROM (VALUES
(0,'parser','customer','c_custkey,c_name'),
(1,'parser','customer','c_custkey,c_name'),(1,'parser','orders','o_custkey,o_orderkey,o_totalprice'),
(2,'parser','orders',''),
(3,'parser','customer','c_custkey,c_name,c_nationkey,c_mktsegment,c_acctbal'),
(4,'parser','customer','c_custkey,c_name'),(4,'parser','orders','o_custkey,o_orderkey'),
(5,'parser','customer','c_custkey,c_name'),(5,'parser','orders','o_custkey,o_orderkey'),
(6,'parser','nation','n_name,n_nationkey'),(6,'parser','region','r_name'),
(7,'parser','supplier','s_acctbal,s_nationkey,s_suppkey'),(7,'parser','nation','n_name,n_nationkey'),
(8,'parser','nation','n_name,n_nationkey,n_regionkey'),
(9,'parser','supplier','s_name'),
(10,'parser','supplier','s_suppkey,s_name,s_nationkey,s_acctbal'),(10,'parser','nation','n_name,n_nationkey'),
(11,'parser','events','event_id,user_id'),(11,'parser','sessions','user_id'),
(12,'parser','events','event_id,event_type'),
(13,'fallback','sessions','name,session_id'),
(18,'parser','orders','o_orderdate,o_orderkey'),(18,'parser','lineitem','l_orderkey,l_quantity'),
(19,'parser','customer','c_name'),(19,'parser','orders','o_totalprice')
) AS v(k, method, table_name, columns)
"""

# One database per supplier, a copy of one of the base catalogs.
INPUTS["dbs"] = """
SELECT s_suppkey, concat(base, '_', cast(s_suppkey AS VARCHAR(20))) AS db_id, base
FROM (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'sales' WHEN 1 THEN 'geo' ELSE 'web' END AS base FROM supplier) s
"""

INPUTS["db_columns"] = """
SELECT d.db_id AS db_id, c.table_ord AS table_ord, c.table_name AS table_name,
 row_number() OVER (PARTITION BY d.db_id ORDER BY c.table_ord, c.col_ord) AS col_idx,
 c.column_name AS column_name, c.column_type AS column_type, c.is_primary_key AS is_primary_key
FROM dbs d JOIN catalog_columns c ON d.base = c.db_id
"""

INPUTS["db_fks"] = """
SELECT d.db_id AS db_id, f.fk_ord AS fk_ord, f.table_name AS table_name, f.column_name AS column_name,
 f.ref_table AS ref_table, f.ref_column AS ref_column
FROM dbs d JOIN catalog_fks f ON d.base = f.db_id
"""

INPUTS["clean_pairs"] = """
SELECT row_ord, split, source, source_ord, k, base, db_id, question, query,
 substr(sha256(concat(db_id, chr(0), question, chr(0), query)), 1, 16) AS id
FROM (SELECT row_ord, split, source, CASE source WHEN 'b.json' THEN 1 ELSE 0 END AS source_ord, k, base, db_id,
  trim(question) AS question, trim(query) AS query FROM pairs) p
WHERE question <> '' AND query <> ''
"""

INPUTS["unique_pairs"] = """
SELECT row_ord, split, source, source_ord, k, base, db_id, question, query, id
FROM (SELECT *, row_number() OVER (PARTITION BY split, id ORDER BY source_ord, row_ord) AS rn FROM clean_pairs) p
WHERE rn = 1
"""

INPUTS["expected_columns"] = """
SELECT k, method, table_name, nullif(c, '') AS column_name FROM (
 SELECT k, method, table_name, unnest(string_split(columns, ',')) AS c FROM expected_used) e
"""

INPUTS["template_dbs"] = """
SELECT DISTINCT t.k AS k, t.db_id AS db_id FROM templates t JOIN expected_used e ON t.k = e.k
"""

# Used columns with both ends of every foreign key between used tables.
INPUTS["closed"] = """
SELECT k, table_name, column_name FROM expected_columns
UNION
SELECT d.k, f.table_name, f.column_name FROM template_dbs d JOIN catalog_fks f ON d.db_id = f.db_id
 WHERE EXISTS (SELECT 1 FROM expected_used e WHERE e.k = d.k AND e.table_name = f.table_name)
 AND EXISTS (SELECT 1 FROM expected_used e WHERE e.k = d.k AND e.table_name = f.ref_table)
UNION
SELECT d.k, f.ref_table, f.ref_column FROM template_dbs d JOIN catalog_fks f ON d.db_id = f.db_id
 WHERE EXISTS (SELECT 1 FROM expected_used e WHERE e.k = d.k AND e.table_name = f.table_name)
 AND EXISTS (SELECT 1 FROM expected_used e WHERE e.k = d.k AND e.table_name = f.ref_table)
"""

INPUTS["kept"] = """
SELECT d.k AS k, c.table_ord, c.table_name, c.col_ord, c.column_name, c.column_type, c.is_primary_key
FROM template_dbs d JOIN catalog_columns c ON d.db_id = c.db_id
WHERE EXISTS (SELECT 1 FROM closed u WHERE u.k = d.k AND u.table_name = c.table_name AND u.column_name = c.column_name)
 OR (c.is_primary_key AND EXISTS (SELECT 1 FROM expected_used e WHERE e.k = d.k AND e.table_name = c.table_name))
"""

INPUTS["kept_fks"] = """
SELECT d.k AS k, f.fk_ord, f.table_name, f.column_name, f.ref_table, f.ref_column
FROM template_dbs d JOIN catalog_fks f ON d.db_id = f.db_id
JOIN kept a ON a.k = d.k AND a.table_name = f.table_name AND a.column_name = f.column_name
JOIN kept b ON b.k = d.k AND b.table_name = f.ref_table AND b.column_name = f.ref_column
"""

INPUTS["kept_lines"] = """
SELECT k, table_ord, table_name, string_agg(column_name, ', ' ORDER BY col_ord) AS names,
 string_agg(concat(column_name, ' ', column_type, CASE WHEN is_primary_key THEN ' primary key' ELSE '' END), ', ' ORDER BY col_ord) AS typed
FROM kept GROUP BY k, table_ord, table_name
"""

INPUTS["targets"] = """
SELECT k, string_agg(concat(table_name, '(', names, ')'), chr(10) ORDER BY table_ord) AS target,
 string_agg(table_name, ',' ORDER BY table_ord) AS tables
FROM kept_lines GROUP BY k
"""

INPUTS["labeled"] = """
SELECT p.*, m.method AS method FROM unique_pairs p JOIN (SELECT DISTINCT k, method FROM expected_used) m ON p.k = m.k
"""


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in INPUTS if name in words]


def _ordered(names: list[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        for other in _needs(INPUTS[name]):
            if other != name:
                visit(other)
        if name not in done:
            done.append(name)

    for name in names:
        visit(name)
    return done


def with_inputs(body: str, extra: dict[str, str] | None = None) -> str:
    """DuckDB text of a query over derived inputs."""
    extra = extra or {}
    text = " ".join([body, *extra.values()])
    parts = [f"{name} AS ({INPUTS[name].strip()})" for name in _ordered(_needs(text))]
    parts += [f"{name} AS ({sql.strip()})" for name, sql in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


# Key each table is spread by when its files give fewer splits than there are cores.
KEYS = {
    "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "events": "event_id", "documents": "doc_id", "conversations": "conv_id",
}


def _given(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A view of a given table; one small file is spread over the cores."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in KEYS and rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores, KEYS[name])
    view = f"given_{name}_{zlib.crc32(sf_dir.encode())}"
    rows.createOrReplaceTempView(view)
    return view


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one derived from the given tables."""
    if name not in INPUTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    pieces = re.split(r"('(?:[^']|'')*')", with_inputs(f"SELECT * FROM {name}"))
    given = rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b"
    pieces[::2] = [
        re.sub(given, lambda m: f"{m[1]} {_given(spark, sf_dir, m[2])}", text) for text in pieces[::2]
    ]
    return spark.sql("".join(pieces))
