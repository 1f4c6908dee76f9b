from __future__ import annotations

import pytest

from pairforge.llm.shipping import ship_package

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` pairs, with two columns that operators also make."""
    def make(*rows, **extra):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", "'own' AS kept", "1 AS score", "'x' AS component_id", "2 AS size", "3 AS position") if extra.get("clash") else df

    return make
