"""Database catalogs: flattening index-coded entries, nesting, and schema text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairforge.fixed_values import DEFAULT_SQL_TYPE, SQL_TYPES
from pairforge.functions.scratch import stage
from pairforge.functions.text import bind

RAW_ENTRY = """db_id STRING, table_names_original ARRAY<STRING>,
    column_names_original ARRAY<ARRAY<STRING>>, column_types ARRAY<STRING>,
    primary_keys ARRAY<STRING>, foreign_keys ARRAY<ARRAY<INT>>"""

COLUMN = "struct<name:string,type:string,is_primary_key:boolean>"
TABLE = f"struct<name:string,columns:array<{COLUMN}>>"
FOREIGN_KEY = "struct<table:string,column:string,ref_table:string,ref_column:string>"
CATALOG = f"struct<db_id:string,tables:array<{TABLE}>,foreign_keys:array<{FOREIGN_KEY}>>"


def _primary_key_indexes() -> Column:
    """Column indexes named by keys that are ``3`` or ``[3, 4]``."""
    keys = F.coalesce(F.col("primary_keys"), F.array().cast("array<string>"))
    numbers = F.flatten(F.transform(keys, lambda k: F.regexp_extract_all(k, F.lit(r"\d+"), F.lit(0))))
    return numbers.cast("array<int>")


def catalog_columns(entries: DataFrame) -> DataFrame:
    """One row per real column; the ``*`` pseudo-column (table index < 0) is dropped."""
    exploded = entries.select(
        "db_id",
        "table_names_original",
        _primary_key_indexes().alias("_keys"),
        F.posexplode(F.arrays_zip("column_names_original", "column_types")).alias("col_idx", "_c"),
    )
    table_idx = F.get("_c.column_names_original", F.lit(0)).cast("int")
    return exploded.where(table_idx >= 0).select(
        "db_id",
        table_idx.alias("table_ord"),
        F.get("table_names_original", table_idx).alias("table_name"),
        "col_idx",
        F.get("_c.column_names_original", F.lit(1)).alias("column_name"),
        F.col("_c.column_types").alias("column_type"),
        F.array_contains("_keys", F.col("col_idx")).alias("is_primary_key"),
    )


def catalog_primary_keys(entries: DataFrame) -> DataFrame:
    return (
        catalog_columns(entries)
        .where("is_primary_key")
        .select("db_id", "table_name", "column_name", "col_idx")
    )


def catalog_foreign_keys(entries: DataFrame) -> DataFrame:
    """Index pairs turned into table and column names."""
    pairs = entries.select(
        "*", F.posexplode("foreign_keys").alias("fk_ord", "_fk")
    )

    def end(position: int) -> tuple[Column, Column]:
        column = F.get("column_names_original", F.get("_fk", F.lit(position)))
        table = F.get("table_names_original", F.get(column, F.lit(0)).cast("int"))
        return table, F.get(column, F.lit(1))

    (table, column), (ref_table, ref_column) = end(0), end(1)
    return pairs.select(
        "db_id", "fk_ord", table.alias("table_name"), column.alias("column_name"),
        ref_table.alias("ref_table"), ref_column.alias("ref_column"),
    )


def duplicate_databases(entries: DataFrame) -> DataFrame:
    """Databases described more than once."""
    return entries.groupBy("db_id").agg(F.count("*").alias("entries")).where("entries > 1")


def require_unique_databases(entries: DataFrame) -> DataFrame:
    """The entries; the job fails when a ``db_id`` comes twice. Only ids are counted."""
    twice = duplicate_databases(entries).first()
    if twice is not None:
        raise ValueError(f"duplicate db_id {twice['db_id']}")
    return entries


def lower_tables(tables: Column) -> Column:
    """Catalog tables in the lower-case form names are compared in."""
    return F.transform(
        tables,
        lambda t: F.struct(
            F.lower(t["name"]).alias("name"),
            F.transform(t["columns"], lambda c: F.lower(c["name"])).alias("columns"),
        ),
    )


def staged_catalogs(catalogs: DataFrame, write: Callable[[DataFrame, str], DataFrame] = stage) -> DataFrame:
    """Catalogs with their lower-case ``names``, written once for all steps of a job and checked to be unique.

    A staged table is returned as it is, so a job may hand one table to each of its steps.
    """
    if getattr(catalogs, "catalogs_staged", False):
        return catalogs
    table = require_unique_databases(write(catalogs.withColumn("names", lower_tables(F.col("tables"))), "catalogs"))
    table.catalogs_staged = True
    return table


def sql_type(column_type: Column) -> Column:
    pairs = [F.lit(x) for pair in SQL_TYPES.items() for x in pair]
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), column_type), F.lit(DEFAULT_SQL_TYPE)
    )


def table_lookup(columns: DataFrame) -> DataFrame:
    """Lower-case table name -> table as written; the last of equal names wins."""
    return columns.groupBy("db_id", F.lower("table_name").alias("lookup_name")).agg(
        F.max_by("table_name", "table_ord").alias("table_name")
    )


def nest_catalog(columns: DataFrame, foreign_keys: DataFrame, order: str = "col_idx") -> DataFrame:
    """One nested row per database, tables and columns in catalog order."""
    column = F.struct(
        F.col(order).alias("ord"),
        F.struct(
            F.col("column_name").alias("name"),
            F.col("column_type").alias("type"),
            F.col("is_primary_key"),
        ).alias("value"),
    )
    tables = columns.groupBy("db_id", "table_ord", "table_name").agg(
        F.transform(F.array_sort(F.collect_list(column)), lambda c: c["value"]).alias("columns")
    )
    table = F.struct(
        F.col("table_ord").alias("ord"),
        F.struct(F.col("table_name").alias("name"), F.col("columns")).alias("value"),
    )
    nested = tables.groupBy("db_id").agg(
        F.transform(F.array_sort(F.collect_list(table)), lambda t: t["value"]).alias("tables")
    )
    key = F.struct(
        F.col("fk_ord").alias("ord"),
        F.struct(
            F.col("table_name").alias("table"), F.col("column_name").alias("column"),
            F.col("ref_table"), F.col("ref_column"),
        ).alias("value"),
    )
    keys = foreign_keys.groupBy("db_id").agg(
        F.transform(F.array_sort(F.collect_list(key)), lambda k: k["value"]).alias("foreign_keys")
    )
    none = F.array().cast(f"array<{FOREIGN_KEY}>")
    return nested.join(keys, "db_id", "left").select(
        "db_id",
        F.col("tables").cast(f"array<{TABLE}>").alias("tables"),
        F.coalesce(F.col("foreign_keys").cast(f"array<{FOREIGN_KEY}>"), none).alias("foreign_keys"),
    )


def catalogs_from_entries(entries: DataFrame) -> DataFrame:
    """One nested row per entry, built inside the row."""
    def coded(keys: Column) -> Column:
        every = F.transform(
            F.arrays_zip("column_names_original", "column_types"),
            lambda c, i: F.struct(
                F.get(c["column_names_original"], F.lit(0)).cast("int").alias("table_idx"),
                F.get(c["column_names_original"], F.lit(1)).alias("name"),
                c["column_types"].alias("type"),
                F.array_contains(keys, i).alias("is_primary_key"),
            ),
        )
        return F.filter(every, lambda c: c["table_idx"] >= 0)

    def tables(columns: Column) -> Column:
        def columns_of(table_idx: Column) -> Column:
            return F.transform(
                F.filter(columns, lambda c: c["table_idx"] == table_idx),
                lambda c: F.struct(c["name"], c["type"], c["is_primary_key"]),
            )

        return F.transform("table_names_original", lambda t, i: F.struct(t, columns_of(i)))

    def end(key: Column, position: int) -> tuple[Column, Column]:
        column = F.get("column_names_original", F.get(key, F.lit(position)))
        return F.get("table_names_original", F.get(column, F.lit(0)).cast("int")), F.get(column, F.lit(1))

    keys = F.transform("foreign_keys", lambda k: F.struct(*end(k, 0), *end(k, 1)))
    return entries.select(
        "db_id",
        bind(_primary_key_indexes(), lambda pk: bind(coded(pk), tables))
        .cast(f"array<{TABLE}>").alias("tables"),
        F.coalesce(keys.cast(f"array<{FOREIGN_KEY}>"), F.array().cast(f"array<{FOREIGN_KEY}>"))
        .alias("foreign_keys"),
    )


def schema_text(
    tables: Column, foreign_keys: Column, *, style: str = "verbose", include_types: bool = True
) -> Column:
    """A catalog as text, ``compact`` on one line or ``verbose`` on several."""
    if style == "compact":
        return F.array_join(
            F.transform(
                tables,
                lambda t: F.concat(
                    t["name"], F.lit("("), F.array_join(t["columns"]["name"], ", "), F.lit(")")
                ),
            ),
            " | ",
        )
    if style != "verbose":
        raise ValueError(f"unknown schema text style: {style!r}")

    def column_text(c: Column) -> Column:
        kind = F.concat(F.lit(" "), c["type"]) if include_types else F.lit("")
        return F.concat(
            c["name"], kind, F.when(c["is_primary_key"], " primary key").otherwise("")
        )

    table_lines = F.transform(
        tables,
        lambda t: F.concat(
            F.lit("table "), t["name"], F.lit(" ("),
            F.array_join(F.transform(t["columns"], column_text), ", "), F.lit(")"),
        ),
    )
    key_lines = F.transform(
        foreign_keys,
        lambda k: F.concat(
            F.lit("foreign key "), k["table"], F.lit("."), k["column"], F.lit(" references "),
            k["ref_table"], F.lit("."), k["ref_column"],
        ),
    )
    return F.array_join(F.concat(table_lines, key_lines), "\n")


def flatten_settings(df: DataFrame, keys: list[str], sections: list[str]) -> DataFrame:
    """Nested settings as rows of dotted name and value text."""
    def leaves(name: str, data_type: T.DataType) -> list[str]:
        if isinstance(data_type, T.StructType):
            return [
                path for field in data_type for path in leaves(f"{name}.{field.name}", field.dataType)
            ]
        return [name]

    paths = [path for section in sections for path in leaves(section, df.schema[section].dataType)]
    rows = F.array(
        *[F.struct(F.lit(p).alias("key"), F.col(p).cast("string").alias("value")) for p in paths]
    )
    return df.select(*keys, F.inline(rows))
