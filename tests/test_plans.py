from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pairforge.operators import replies as R, scoring as S
from tests.check_oracles import plan
from workload.inputs import TABLES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", ["failure_sample", "invalid_sample", "result_preview", "attempt_state"])
def test_ranked_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(entry.queries()[name](spark, SF))


def test_scoring_needs_no_shuffle(spark):
    rows = spark.read.parquet(f"{SF}/part.parquet").selectExpr("p_name AS reply")
    parsed = rows.withColumn("p", R.parse_table_lines(F.col("reply")))
    scored = S.set_scores(parsed, F.col("p.entries"), F.col("p.entries"), F.col("p.error").isNull())
    assert "Exchange" not in plan(scored)


def test_inputs_are_the_given_tables():
    assert len(TABLES) == 14
