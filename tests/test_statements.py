from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pairforge.operators.statements import raw_tokens, resolve_statement, statement_shape
from pairforge.operators.catalog import lower_tables
from workload.corpus import label_catalogs

CUSTOMER = "c_custkey c_name c_nationkey c_mktsegment c_acctbal"


def used(**tables: str) -> dict[str, set[str]]:
    return {name: set(columns.split()) for name, columns in tables.items()}


CASES = [
    ("sales", "WITH orders AS (SELECT c_custkey FROM customer) SELECT c_custkey FROM orders",
     used(customer="c_custkey")),
    ("sales", "SELECT c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders UNION "
     "SELECT l_partkey FROM lineitem WHERE l_quantity > c_acctbal)",
     used(customer="c_acctbal c_custkey c_name", lineitem="l_partkey l_quantity", orders="o_custkey")),
    ("sales", "SELECT c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey IN "
     "(SELECT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 1)))",
     used(customer="c_acctbal c_custkey c_name c_nationkey", lineitem="l_orderkey l_partkey",
          orders="o_custkey o_orderkey")),
    ("sales", "SELECT `c_name`, [c_acctbal] FROM `customer`", used(customer="c_acctbal c_name")),
    ("sales", "SELECT c_name, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS m "
     "FROM customer ORDER BY m", used(customer="c_custkey c_name", orders="o_custkey o_totalprice")),
    ("sales", "SELECT o_custkey AS c_name FROM orders, customer ORDER BY c_name",
     used(orders="o_custkey", customer="")),
    ("web", "SELECT event_type FROM events JOIN sessions USING (user_id)",
     used(events="event_type user_id", sessions="user_id")),
    ("sales", "SELECT c_name FROM customer -- FROM orders", used(customer="c_name")),
    ("sales", "SELECT /* , o_orderkey FROM orders */ c_name FROM customer", used(customer="c_name")),
    ("sales", "SELECT a.c_name FROM customer AS a UNION SELECT a.o_orderstatus FROM orders AS a WHERE EXISTS "
     "(SELECT 1 FROM lineitem WHERE l_orderkey = a.o_orderkey)",
     used(customer="c_name", lineitem="l_orderkey", orders="o_orderkey o_orderstatus")),
    ("sales", "SELECT T1.c_name FROM customer T1, orders T2 LEFT JOIN lineitem T3 ON T2.o_orderkey = T3.l_orderkey "
     "GROUP BY T1.c_name HAVING count(DISTINCT T3.l_partkey) > 2 LIMIT 5",
     used(customer="c_name", lineitem="l_orderkey l_partkey", orders="o_orderkey")),
    ("sales", "SELECT CASE WHEN o_totalprice > 1 THEN 1 ELSE 0 END FROM orders WHERE o_orderdate BETWEEN 1 AND 2 "
     "AND o_orderpriority IS NOT NULL", used(orders="o_orderdate o_orderpriority o_totalprice")),
    ("sales", "SELECT x.c_name FROM (SELECT * FROM customer) x WHERE x.c_acctbal > (SELECT avg(c_acctbal) FROM customer)",
     used(customer=CUSTOMER)),
    # A comma after ON goes on with the FROM list; one inside a call does not.
    ("sales", "SELECT 1 FROM orders o JOIN customer c ON coalesce(o.o_custkey, lineitem) = c.c_custkey, lineitem",
     used(orders="o_custkey", customer="c_custkey", lineitem="")),
    ("sales", "SELECT c_name FROM main.customer AS c", used(customer="c_name")),
    ("sales", "SELECT count(*) FROM customer", used(customer="")),
    ("sales", "SELECT c_acctbal * 2 FROM customer", used(customer="c_acctbal")),
    ("sales", "SELECT 'it''s o_orderkey', c_name FROM customer", used(customer="c_name")),
    ("sales", "SELECT c_name FROM customer; DROP TABLE orders", used(customer="c_name")),
    ("sales", "(SELECT c_name FROM customer) EXCEPT (SELECT o_orderstatus FROM orders)",
     used(customer="c_name", orders="o_orderstatus")),
    ("sales", "SELECT rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) AS r, c_name FROM customer",
     used(customer="c_nationkey c_acctbal c_name")),
    # A CTE hides a table of its name, but not inside its own body.
    ("sales", "WITH customer AS (SELECT c_name FROM customer) SELECT c_name FROM customer",
     used(customer="c_name")),
    ("sales", "WITH a AS (SELECT o_custkey AS c_custkey FROM orders), b AS (SELECT c_custkey FROM a) "
     "SELECT b.c_custkey FROM b JOIN customer ON b.c_custkey = customer.c_nationkey",
     used(orders="o_custkey", customer="c_nationkey")),
    # The name comes from the subquery, not from the outer table.
    ("sales", "SELECT c_name FROM customer WHERE EXISTS (SELECT c_acctbal FROM (SELECT c_acctbal FROM customer) d)",
     used(customer="c_name c_acctbal")),
    ("sales", "SELECT d.c_name FROM (SELECT o_custkey AS c_name FROM orders) d, customer",
     used(orders="o_custkey", customer="")),
    ("geo", "SELECT n_name FROM nation NATURAL JOIN region", used(nation="n_name", region="")),
    ("geo", "SELECT n_name FROM (nation JOIN region ON n_regionkey = r_regionkey)",
     used(nation="n_name n_regionkey", region="r_regionkey")),
    ("web", "SELECT name FROM events JOIN sessions ON events.user_id = sessions.user_id",
     used(events="user_id", sessions="user_id")),
]

REFUSED = [
    ("sales", "SELEC c_name FROM customer", "not a query"),
    ("sales", "SELECT ((( FROM customer", "unbalanced parentheses"),
    ("sales", "SELECT c_name) FROM customer (", "unbalanced parentheses"),
    ("sales", "SELECT 'open FROM customer", "unclosed quote"),
    ("sales", "SELECT c_name, FROM customer", "malformed clause"),
    ("sales", "SELECT c_name c_acctbal c_custkey FROM customer", "malformed clause"),
    ("sales", "SELECT c_name FROM customer SELECT o_orderkey FROM orders", "malformed clause"),
    ("sales", "SELECT 1 FROM nowhere", "no catalog table resolved"),
]


@pytest.fixture(scope="module")
def resolved(spark):
    cases = [(db, sql) for db, sql, _ in CASES + REFUSED]
    rows = spark.createDataFrame(cases, "db_id string, sql string").join(
        label_catalogs(spark, "").withColumn("names", lower_tables(F.col("tables"))), "db_id"
    )
    shaped = rows.withColumn("shape", statement_shape(raw_tokens(F.col("sql"))))
    found = shaped.select("sql", resolve_statement(F.col("shape"), F.col("names")).alias("r"))
    return {row.sql: row for row in found.select("sql", "r.problem", "r.used").collect()}


@pytest.mark.parametrize("db,sql,expected", CASES)
def test_used_columns(resolved, db, sql, expected):
    row = resolved[sql]
    got: dict[str, set[str]] = {}
    for use in row.used:
        got.setdefault(use.table_name, set()).update({use.column_name} - {None})
    assert row.problem is None
    assert got == expected


@pytest.mark.parametrize("db,sql,problem", REFUSED)
def test_refused(resolved, db, sql, problem):
    assert resolved[sql].problem == problem


def test_shape_blanks_only_literals(one):
    shape = statement_shape(raw_tokens(F.col("sql")))
    assert one(shape, sql="SELECT T1.x, 'A b', 1.5e3 FROM \"Tab 1\" -- c") == [
        "select", "t1", ".", "x", ",", "?", ",", "?", "from", '"tab 1"'
    ]


def test_long_statement(one):
    values = ", ".join(str(i) for i in range(20_000))
    shape = statement_shape(raw_tokens(F.col("sql")))
    assert len(one(shape, sql=f"SELECT 1 FROM t WHERE x IN ({values}) AND y = '{'z' * 200_000}'")) == 40_012
