"""(question, query) pairs: union of sources, cleaning, ids, duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairforge.functions.joins import first_per_key
from pairforge.functions.text import short_sha256, strip


def pairs_union(sources: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Concatenate (split, source name, rows with ``row_ord``) in the order given."""
    tagged = [
        rows.select(
            F.lit(split).alias("split"), F.lit(name).alias("source"),
            F.lit(i).alias("source_ord"), "row_ord", "db_id", "question", "query",
        )
        for i, (split, name, rows) in enumerate(sources)
    ]
    return reduce(DataFrame.unionByName, tagged)


def pairs_clean(pairs: DataFrame) -> DataFrame:
    """Strip both texts; drop rows where either is empty."""
    stripped = pairs.withColumns(
        {"question": strip(F.col("question")), "query": strip(F.col("query"))}
    )
    return stripped.where((F.col("question") != "") & (F.col("query") != ""))


def pair_id(db_id: Column, question: Column, query: Column) -> Column:
    return short_sha256(F.concat(db_id, F.lit("\0"), question, F.lit("\0"), query))


def with_pair_id(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("id", pair_id(F.col("db_id"), F.col("question"), F.col("query")))


def pairs_dedup(pairs: DataFrame, order: tuple[str, ...] = ("source_ord", "row_ord")) -> DataFrame:
    """First occurrence of each id within a split; duplicates are merged before the shuffle."""
    return first_per_key(pairs, ["split", "id"], list(order))


def split_leakage(pairs: DataFrame) -> DataFrame:
    """Ids present in more than one split."""
    return (
        pairs.groupBy("id")
        .agg(F.count_distinct("split").alias("splits"))
        .where("splits > 1")
    )
