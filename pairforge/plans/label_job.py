"""The label job: pairs and catalogs to labelled rows, failures and a report.

Statements of equal shape use equal columns, so each distinct shape is resolved
once. Its result is written as a stage table, joined back to the pairs, and only
statements the resolver refused are read again, as plain words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.fixed_values import FAILURE_SAMPLE_SIZE
from pairforge.functions.joins import fits_broadcast, lookup_join, weighted_join
from pairforge.functions.scratch import stage
from pairforge.functions.text import built_once
from pairforge.operators.catalog import staged_catalogs
from pairforge.operators.statements import resolve_statement, shape_text, shape_tokens
from pairforge.operators.usage import prune_catalog, pruned_names, token_fallback

PAIRS_PER_TASK = 500


@built_once
def _resolved() -> Column:
    """The resolver over ``shape`` and ``names``."""
    return resolve_statement(F.col("shape"), F.col("names"))


@built_once
def _pruned(used: str, include_primary_keys: bool, include_foreign_keys: bool) -> Column:
    return prune_catalog(
        F.col("db_id"), F.col(used), F.col("tables"), F.col("foreign_keys"),
        include_primary_keys=include_primary_keys, include_foreign_keys=include_foreign_keys,
    )


@built_once
def _words() -> Column:
    return token_fallback(F.col("query"), F.col("names"))


def pair_schema_lookup(pairs: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Pairs with their catalog; ``known`` is false where no database has that id.

    A database that is described twice fails the job.
    """
    table = staged_catalogs(catalogs)
    joined = lookup_join(pairs, table.drop("names"), ["db_id"], "left", salt_on=["id"], small=fits_broadcast(table))
    return joined.withColumn("known", F.col("tables").isNotNull())


def keyed_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with the shape of their statement and its key, tokenised once."""
    shaped = pairs.withColumn("shape_text", shape_text(F.col("query")))
    key = F.concat_ws("\1", F.length("db_id").cast("string"), "db_id", "shape_text")
    return shaped.withColumn("shape_key", F.sha2(key, 256))


def distinct_shapes(keyed: DataFrame) -> DataFrame:
    """Distinct shapes with the number of pairs that have them, counted before the shuffle.

    Resolving costs far more time per byte than anything else here, so the
    shapes are spread by number instead of being coalesced by size. ``keyed``
    is a stage table, whose row count is read from its file footers.
    """
    spark = keyed.sparkSession
    most = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    tasks = max(1, min(most, keyed.count() // PAIRS_PER_TASK))
    counted = keyed.groupBy("shape_key", "db_id", "shape_text").agg(F.count("*").alias("n"))
    return counted.repartition(tasks, "shape_key")


def resolve_shapes(shapes: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Attach each shape's catalog and resolve its names; ``found`` is null without one."""
    split = shapes.withColumn("shape", shape_tokens(F.col("shape_text"))).drop("shape_text")
    attached = lookup_join(split, staged_catalogs(catalogs), ["db_id"], "left", salt_on=["shape_key"])
    return attached.withColumn(
        "found", F.when(F.col("tables").isNotNull(), _resolved())
    )


def statement_details(pairs: DataFrame, catalogs: DataFrame, parts: list[str]) -> DataFrame:
    """Pairs with named parts of what was found in their statement.

    Parts are ``tokens``, ``sources``, ``qualified``, ``stars``, ``bare``,
    ``used`` and ``problem``; all are null for an unknown database.
    """
    keyed = stage(keyed_pairs(pairs), "pairs")
    found = resolve_shapes(distinct_shapes(keyed), catalogs).select(
        "shape_key", "n", *[F.col(f"found.{part}").alias(part) for part in parts]
    )
    joined = weighted_join(
        keyed.drop("shape_text"), stage(found, "found"), "shape_key", weight="n", salt_on="id"
    )
    return joined.drop("n", "shape_key")


@dataclass
class LabelOptions:
    enable_fallback: bool = True
    include_primary_keys: bool = True
    include_foreign_keys: bool = True


def label_pairs(
    pairs: DataFrame,
    catalogs: DataFrame,
    options: LabelOptions = LabelOptions(),
    write: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """Every pair with ``method`` (null when it failed), ``reason``, ``used`` and its label.

    ``write`` writes stage tables; ``Stages().write`` lets the caller delete them.
    """
    def label(used: str) -> Column:
        return _pruned(used, options.include_primary_keys, options.include_foreign_keys)

    catalogs = staged_catalogs(catalogs, write)
    keyed = write(keyed_pairs(pairs), "pairs")
    shapes = resolve_shapes(distinct_shapes(keyed), catalogs).select(
        "shape_key", "n", "db_id", "tables", "foreign_keys", "names",
        F.col("tables").isNotNull().alias("known"),
        F.col("found.problem").alias("problem"),
        F.col("found.used").alias("used"),
    )
    # The catalog travels on only with shapes that still need the word match.
    clean = F.col("problem").isNull() & F.col("known")
    resolved = write(
        shapes.select(
            "shape_key", "n", "known", "problem",
            F.when(clean, F.col("used")).alias("shape_used"),
            F.when(clean, label("used")).alias("shape_pruned"),
            *[F.when(~clean, F.col(c)).alias(c) for c in ("tables", "foreign_keys", "names")],
        ),
        "shapes",
    )
    joined = weighted_join(
        keyed.drop("shape_text"), resolved, "shape_key", weight="n", salt_on="id"
    ).drop("n", "shape_key")

    if options.enable_fallback:
        words = F.when(
            F.col("known") & F.col("problem").isNotNull(), _words()
        )
    else:
        words = F.lit(None).cast("array<struct<table_name:string,column_name:string>>")
    matched = joined.withColumn("word_used", F.when(F.size(words) > 0, words))
    method = (
        F.when(~F.col("known"), F.lit(None).cast("string"))
        .when(F.col("problem").isNull(), "parser")
        .when(F.col("word_used").isNotNull(), "fallback")
    )
    no_tables = "fallback found no tables: " if options.enable_fallback else ""
    reason = F.when(~F.col("known"), "unknown db_id").when(
        F.col("problem").isNotNull() & F.col("word_used").isNull(),
        F.concat(F.lit(no_tables), F.col("problem")),
    )
    return (
        matched.withColumns(
            {
                "method": method,
                "reason": reason,
                "used": F.coalesce("shape_used", "word_used"),
                "pruned_schema": F.coalesce(
                    "shape_pruned", F.when(F.col("word_used").isNotNull(), label("word_used"))
                ),
            }
        )
        .select(*pairs.columns, "known", "method", "reason", "used", "pruned_schema")
    )


def label_rows(labels: DataFrame) -> DataFrame:
    """Labelled pairs only, with table list, column map and pruned catalog."""
    kept = labels.where(F.col("method").isNotNull())
    return kept.withColumn("_names", pruned_names(F.col("pruned_schema"))).select(
        "id", "split", "db_id", "question", "query", "source",
        F.col("_names.tables").alias("tables"), F.col("_names.columns").alias("columns"),
        "pruned_schema", F.col("method").alias("extraction_method"),
    )


def label_report(labels: DataFrame) -> DataFrame:
    """Counts per split."""
    method, known = F.col("method"), F.col("known")
    return labels.groupBy("split").agg(
        F.count("*").alias("total"),
        F.count_if(method.isNotNull()).alias("labeled"),
        F.count_if(method == "parser").alias("parser"),
        F.count_if(method == "fallback").alias("fallback"),
        F.count_if(known & method.isNull()).alias("extraction_failed"),
        F.count_if(~known).alias("unknown_db"),
    )


def failure_sample(
    labels: DataFrame, order: list[str], size: int = FAILURE_SAMPLE_SIZE
) -> DataFrame:
    """First failures per split with their reason."""
    ranked = labels.where(F.col("reason").isNotNull()).withColumn(
        "rank", F.row_number().over(Window.partitionBy("split").orderBy(*order))
    )
    return ranked.where(F.col("rank") <= size)
