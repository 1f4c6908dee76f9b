"""Training rows: full and pruned schema text, chat messages, length limit, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairforge.fixed_values import (
    GENERATOR_RETRY,
    GENERATOR_SYSTEM,
    GENERATOR_USER,
    MAX_SEQ_LEN,
    PRESENTER_SYSTEM,
    PRESENTER_USER,
    PRUNER_SYSTEM,
    PRUNER_USER,
)
from pairforge.functions.joins import lookup_join
from pairforge.functions.scratch import stage
from pairforge.functions.text import fill, message, short_sha256
from pairforge.operators.catalog import CATALOG, schema_text


def model_ready_rows(
    rows: DataFrame, catalogs: DataFrame, *, style: str = "verbose", include_types: bool = True
) -> DataFrame:
    """Labelled rows with the full catalog and both schema texts.

    Full schema text is made once per database, before the join. A row whose
    database is missing fails the job.
    """
    full = F.struct("db_id", "tables", "foreign_keys").cast(CATALOG)
    lookup = catalogs.select(
        "db_id",
        full.alias("full_schema"),
        schema_text(
            F.col("tables"), F.col("foreign_keys"), style=style, include_types=include_types
        ).alias("full_schema_text"),
    )
    # Written once: the size of its files decides how it is joined.
    attached = lookup_join(rows, stage(lookup, "schema-texts"), ["db_id"], "left", salt_on=["id"])
    missing = F.raise_error(F.concat(F.lit("no catalog for "), F.col("db_id"))).cast("string")
    pruned = schema_text(
        F.col("pruned_schema.tables"), F.col("pruned_schema.foreign_keys"),
        style=style, include_types=include_types,
    )
    return attached.select(
        "id", "split", "db_id", "question", "query", "full_schema",
        F.coalesce("full_schema_text", missing).alias("full_schema_text"),
        "pruned_schema", pruned.alias("pruned_schema_text"),
        "tables", "columns", "extraction_method", "source",
    )


def target_text(tables: Column, columns: Column) -> Column:
    """One ``table(c1, c2)`` line per table."""
    none = F.array().cast("array<string>")
    return F.array_join(
        F.transform(
            tables,
            lambda t: F.concat(
                t, F.lit("("),
                F.array_join(F.coalesce(F.try_element_at(columns, t), none), ", "), F.lit(")"),
            ),
        ),
        "\n",
    )


def _with_target(messages: list[Column], target: Column | None) -> Column:
    fixed = F.array(*messages)
    if target is None:
        return fixed
    return F.concat(
        fixed,
        F.when(target.isNotNull(), F.array(message("assistant", target))).otherwise(
            F.array().cast("array<struct<role:string,content:string>>")
        ),
    )


def pruner_messages(question: Column, schema: Column, target: Column | None = None) -> Column:
    user = fill(PRUNER_USER, schema=schema, question=question)
    return _with_target(
        [message("system", F.lit(PRUNER_SYSTEM)), message("user", user)], target
    )


def generator_messages(
    question: Column,
    schema: Column,
    target: Column | None = None,
    *,
    prev_sql: Column | None = None,
    error: Column | None = None,
    history: Column | None = None,
) -> Column:
    """Messages for the SQL generator; a retry needs both the failed SQL and its error."""
    user = fill(GENERATOR_USER, schema=schema, question=question)
    if prev_sql is not None and error is not None:
        retry = fill(
            GENERATOR_RETRY, schema=schema, question=question, prev_sql=prev_sql, error=error
        )
        user = F.when(prev_sql.isNotNull() & error.isNotNull(), retry).otherwise(user)
    none = F.array().cast("array<struct<role:string,content:string>>")
    turns = none
    if history is not None:
        turns = F.coalesce(
            F.flatten(
                F.transform(
                    history,
                    lambda turn: F.concat(
                        F.when(turn["question"] != "", F.array(message("user", turn["question"])))
                        .otherwise(none),
                        F.when(turn["sql"] != "", F.array(message("assistant", turn["sql"])))
                        .otherwise(none),
                    ),
                )
            ),
            none,
        )
    return F.concat(
        F.array(message("system", F.lit(GENERATOR_SYSTEM))),
        turns,
        _with_target([message("user", user)], target),
    )


def presenter_messages(question: Column, n_rows: Column, preview: Column) -> Column:
    user = fill(
        PRESENTER_USER, question=question, n_rows=n_rows.cast("string"), preview=preview
    )
    return F.array(message("system", F.lit(PRESENTER_SYSTEM)), message("user", user))


def token_count(text: Column) -> Column:
    """Default length measure: words and punctuation marks."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]"))


def overlength_drop(
    rows: DataFrame, length: Column, max_length: int = MAX_SEQ_LEN
) -> tuple[DataFrame, DataFrame]:
    """Rows within the budget, never cut short, and how many were dropped."""
    measured = rows.withColumn("n_tokens", length)
    kept = measured.where(F.col("n_tokens") <= max_length)
    report = measured.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("n_tokens") > max_length).alias("dropped"),
    )
    return kept, report


def prompt_fingerprint(version: Column, *texts: Column) -> Column:
    """Hash of a prompt version and its texts in order."""
    return short_sha256(F.concat_ws("\n", version, *texts))


def dataset_fingerprint(rows: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Order-free count and hash sum per output dataset.

    60 bits of each row's hash are summed as decimals, which hold the sum of 10^19 rows.
    """
    digest = F.substring(F.md5(F.concat_ws("\1", *columns)), 1, 15)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.conv(digest, 16, 10).cast("decimal(38,0)")).alias("hash_sum"),
    )
