"""Used columns of a statement turned into a pruned catalog, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairforge.functions.text import bind
from pairforge.operators.catalog import CATALOG

USE = "struct<table_name:string,column_name:string>"


def fallback_tokens(sql: Column) -> Column:
    """Words of a statement that no resolver could read."""
    words = F.split(F.translate(sql, ".=", "  "), r"(?U)[\s\x1c-\x1f]+")
    return F.array_distinct(
        F.transform(words, lambda w: F.lower(F.btrim(w, F.lit("`\"'(),;"))))
    )


def token_fallback(sql: Column, tables: Column) -> Column:
    """Tables whose name is a word of the statement, and their columns that are too."""
    def use(table: Column, column: Column) -> Column:
        return F.struct(table.alias("table_name"), column.alias("column_name"))

    def match(words: Column) -> Column:
        return F.flatten(
            F.transform(
                F.filter(tables, lambda t: F.array_contains(words, t["name"])),
                lambda t: F.concat(
                    F.array(use(t["name"], F.lit(None).cast("string"))),
                    F.transform(
                        F.filter(t["columns"], lambda c: F.array_contains(words, c)),
                        lambda c: use(t["name"], c),
                    ),
                ),
            )
        )

    return bind(fallback_tokens(sql), match)


def _names_table(used: Column, table: Column) -> Column:
    return F.exists(used, lambda u: u["table_name"] == F.lower(table))


def _names_column(used: Column, table: Column, column: Column) -> Column:
    return F.exists(
        used,
        lambda u: (u["table_name"] == F.lower(table))
        & u["column_name"].eqNullSafe(F.lower(column)),
    )


def fk_closure(used: Column, foreign_keys: Column) -> Column:
    """Add both ends of every foreign key whose two tables are used; one pass, no new tables."""
    def ends(k: Column) -> Column:
        return F.array(
            F.struct(F.lower(k["table"]).alias("table_name"), F.lower(k["column"]).alias("column_name")),
            F.struct(
                F.lower(k["ref_table"]).alias("table_name"),
                F.lower(k["ref_column"]).alias("column_name"),
            ),
        )

    linked = F.filter(
        foreign_keys, lambda k: _names_table(used, k["table"]) & _names_table(used, k["ref_table"])
    )
    return F.array_distinct(F.concat(used, F.flatten(F.transform(linked, ends))))


def pk_retention(used: Column, tables: Column) -> Column:
    """Add the primary keys of used tables."""
    keys = F.transform(
        F.filter(tables, lambda t: _names_table(used, t["name"])),
        lambda t: F.transform(
            F.filter(t["columns"], lambda c: c["is_primary_key"]),
            lambda c: F.struct(
                F.lower(t["name"]).alias("table_name"), F.lower(c["name"]).alias("column_name")
            ),
        ),
    )
    return F.array_distinct(F.concat(used, F.flatten(keys)))


def prune_tables(kept: Column, tables: Column) -> Column:
    """Kept tables and columns in catalog order and spelling."""
    return F.transform(
        F.filter(tables, lambda t: _names_table(kept, t["name"])),
        lambda t: F.struct(
            t["name"].alias("name"),
            F.filter(t["columns"], lambda c: _names_column(kept, t["name"], c["name"])).alias(
                "columns"
            ),
        ),
    )


def prune_foreign_keys(pruned_tables: Column, foreign_keys: Column) -> Column:
    """Foreign keys whose two end columns survived."""
    def survives(table: Column, column: Column) -> Column:
        return F.exists(
            pruned_tables,
            lambda t: (F.lower(t["name"]) == F.lower(table))
            & F.exists(t["columns"], lambda c: F.lower(c["name"]) == F.lower(column)),
        )

    return F.filter(
        foreign_keys,
        lambda k: survives(k["table"], k["column"]) & survives(k["ref_table"], k["ref_column"]),
    )


def prune_catalog(
    db_id: Column,
    used: Column,
    tables: Column,
    foreign_keys: Column,
    *,
    include_primary_keys: bool = True,
    include_foreign_keys: bool = True,
) -> Column:
    def close(used: Column) -> Column:
        return fk_closure(used, foreign_keys) if include_foreign_keys else used

    def keep(closed: Column) -> Column:
        return pk_retention(closed, tables) if include_primary_keys else closed

    def prune(kept: Column) -> Column:
        return bind(
            prune_tables(kept, tables),
            lambda pruned: F.struct(
                db_id.alias("db_id"),
                pruned.alias("tables"),
                prune_foreign_keys(pruned, foreign_keys).alias("foreign_keys"),
            ),
        )

    return bind(used, lambda u: bind(close(u), lambda c: bind(keep(c), prune))).cast(CATALOG)


def pruned_names(pruned: Column) -> Column:
    """``tables`` and ``columns`` of a label from its pruned catalog; the last of equal names wins."""
    names = F.transform(pruned["tables"], lambda t: t["name"])
    last = F.transform(
        F.array_distinct(names),
        lambda name: F.element_at(F.filter(pruned["tables"], lambda t: t["name"] == name), -1)["columns"]["name"],
    )
    return F.struct(
        names.alias("tables"), F.map_from_arrays(F.array_distinct(names), last).alias("columns")
    )


def used_rows(df: DataFrame, used: str, keys: list[str]) -> DataFrame:
    """Long form: one row per used column, and one without column per table used without any."""
    def alone(u: Column) -> Column:
        return ~F.exists(used, lambda v: (v["table_name"] == u["table_name"]) & v["column_name"].isNotNull())

    kept = F.filter(F.array_distinct(used), lambda u: u["column_name"].isNotNull() | alone(u))
    return df.select(*keys, F.inline(kept))
