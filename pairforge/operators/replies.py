"""Parsing logged model replies, and previews of query results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.fixed_values import (
    CHART_TYPES,
    MAX_PREVIEW_COLS,
    MAX_PREVIEW_ROWS,
    PREVIEW_CELL_CHARS,
)
from pairforge.functions.joins import join_same
from pairforge.functions.text import bind, last_key_wins, lines, strip

ENTRY = "array<struct<table_name:string,columns:array<string>>>"
TABLE_LINE = r"(?U)^(\w+)\s*\(([^()]*)\)$"


def parse_table_lines(reply: Column) -> Column:
    """``entries`` (table, columns) in line order, and ``error`` for an unreadable reply.

    Code fences are skipped and trailing punctuation is dropped; the first line
    of any other form makes the whole reply unparseable.
    """
    def clean(line: Column) -> Column:
        return strip(F.rtrim(F.btrim(strip(line), F.lit("`")), F.lit(",;.")))

    def read(kept: Column) -> Column:
        bad = F.get(F.filter(kept, lambda x: ~x.rlike(TABLE_LINE)), F.lit(0))
        entries = F.transform(
            kept,
            lambda x: F.struct(
                F.regexp_extract(x, TABLE_LINE, 1).alias("table_name"),
                F.filter(
                    F.transform(F.split(F.regexp_extract(x, TABLE_LINE, 2), ","), strip),
                    lambda c: c != "",
                ).alias("columns"),
            ),
        )
        error = F.when(
            F.size(kept) == 0, "no table selections found in output"
        ).otherwise(
            bind(bad, lambda x: F.concat(F.lit("unparseable line: '"), x, F.lit("'")))
        )
        return bind(
            error,
            lambda e: F.struct(F.when(e.isNull(), entries).alias("entries"), e.alias("error")),
        )

    wanted = F.filter(lines(strip(reply)), lambda x: ~strip(x).startswith("```"))
    return bind(F.filter(F.transform(wanted, clean), lambda x: x != ""), read)


def merge_duplicate_tables(entries: Column) -> Column:
    """One entry per table at its first position; later lines add only new columns."""
    def merge(entries: Column, name: Column) -> Column:
        def join(same: Column) -> Column:
            first = F.get(same, F.lit(0))["columns"]
            rest = F.flatten(F.transform(F.slice(same, F.lit(2), F.size(same)), lambda e: e["columns"]))
            return F.struct(
                name.alias("table_name"),
                F.when(F.size(same) == 1, first)
                .otherwise(F.concat(first, F.array_except(rest, first)))
                .alias("columns"),
            )

        return bind(F.filter(entries, lambda e: e["table_name"] == name), join)

    def merge_all(entries: Column) -> Column:
        every = F.transform(entries, lambda e: e["table_name"])
        names = F.array_distinct(every)
        merged = F.transform(names, lambda name: merge(entries, name))
        # Most replies name each table once and need no merging.
        return F.when(F.size(every) == F.size(names), entries).otherwise(merged.cast(ENTRY))

    return bind(entries, merge_all)


def _fenced(text: Column, language: str) -> Column:
    """Body of the first code fence, or the whole text, stripped."""
    fence = rf"(?is)```(?:{language})?\s*(.*?)```"
    return F.when(text.rlike(fence), strip(F.regexp_extract(text, fence, 1))).otherwise(text)


def extract_sql(reply: Column) -> Column:
    """The SQL statement of a reply, and ``error`` when it holds none."""
    start = r"(?is)\b((?:with|select|insert|update|delete)\b.*)"

    def read(text: Column) -> Column:
        sql = strip(F.substring_index(F.regexp_extract(text, start, 1), ";", 1))
        found = text.rlike(start)
        return F.struct(
            F.when(found, sql).alias("sql"),
            F.when(
                ~found,
                F.concat(
                    F.lit("no SQL statement found in output: '"), F.substring(text, 1, 80), F.lit("'")
                ),
            ).alias("error"),
        )

    return bind(_fenced(strip(reply), "sql"), read)


def json_object_extract(reply: Column) -> Column:
    """The JSON object of a reply as text, and ``error`` when it holds none.

    Of a repeated key the last value counts.
    """
    last_key_wins()
    widest = r"(?s)(\{.*\})"

    def read(text: Column) -> Column:
        body = F.regexp_extract(text, widest, 1)
        parsed = F.try_parse_json(body)
        error = (
            F.when(
                ~text.rlike(widest),
                F.concat(
                    F.lit("no JSON object found in output: '"), F.substring(text, 1, 80), F.lit("'")
                ),
            )
            .when(parsed.isNull(), "invalid JSON")
            .when(~F.schema_of_variant(parsed).startswith("OBJECT"), "top-level JSON value is not an object")
        )
        return F.struct(F.when(error.isNull(), body).alias("body"), error.alias("error"))

    return bind(_fenced(strip(reply), "json"), read)


def chart_validation(
    body: Column, columns: Column, allowed_types: list[str] = CHART_TYPES
) -> Column:
    """``answer``, ``chart`` and the first ``error`` of a presentation object, checked in order."""
    def part(v: Column, path: str) -> Column:
        return F.try_variant_get(v, path, "variant")

    def facts(v: Column, columns: Column) -> Column:
        """Kinds and values of the parts a presentation may have."""
        def kind(path: str) -> Column:
            return F.coalesce(F.schema_of_variant(part(v, path)), F.lit(""))

        def text(path: str) -> Column:
            return F.try_variant_get(v, path, "string")

        return F.struct(
            kind("$.answer").alias("answer_kind"), text("$.answer").alias("answer"),
            kind("$.chart").alias("chart_kind"),
            kind("$.chart.type").alias("type_kind"), kind("$.chart.x").alias("x_kind"),
            kind("$.chart.y").alias("y_kind"), kind("$.chart.series").alias("series_kind"),
            F.struct(
                text("$.chart.type").alias("type"), text("$.chart.x").alias("x"),
                F.try_variant_get(v, "$.chart.y", "array<string>").alias("y"),
                text("$.chart.series").alias("series"),
            ).alias("chart"),
            columns.alias("columns"),
        )

    def check(f: Column) -> Column:
        chart = f["chart"]
        no_chart = f["chart_kind"] == "VOID"
        chart_ok = (
            f["chart_kind"].startswith("OBJECT")
            & (f["type_kind"] == "STRING")
            & (f["x_kind"] == "STRING")
            & f["y_kind"].isin("ARRAY<STRING>", "ARRAY<VOID>")
            # An array of nulls has the same kind as an empty one but names nothing.
            & F.coalesce(~F.exists(chart["y"], lambda c: c.isNull()), F.lit(False))
            & f["series_kind"].isin("STRING", "VOID", "")
        )
        used = F.concat(
            F.array(chart["x"]), chart["y"],
            F.when(chart["series"] != "", F.array(chart["series"])).otherwise(
                F.array().cast("array<string>")
            ),
        )
        unknown = F.filter(used, lambda c: ~F.array_contains(f["columns"], c))
        error = (
            F.when(~((f["answer_kind"] == "STRING") & (no_chart | chart_ok)), "output does not match schema")
            .when(strip(f["answer"]) == "", "answer is empty")
            .when(no_chart, F.lit(None).cast("string"))
            .when(
                ~chart["type"].isin(*allowed_types),
                F.concat(
                    F.lit("unknown chart type '"), chart["type"],
                    F.lit("'; allowed: " + ", ".join(allowed_types)),
                ),
            )
            .when(F.size(chart["y"]) == 0, "chart.y must list at least one column")
            .when(
                F.size(unknown) > 0,
                F.concat(
                    F.lit("chart references unknown column(s): ["),
                    F.array_join(F.transform(unknown, lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", "),
                    F.lit("]"),
                ),
            )
        )
        return bind(
            error,
            lambda e: F.struct(
                F.when(e.isNull(), f["answer"]).alias("answer"),
                F.when(e.isNull() & ~no_chart, chart).alias("chart"),
                e.alias("error"),
            ),
        )

    return bind(F.try_parse_json(body), lambda v: bind(facts(v, columns), check))


def parse_presentation(
    reply: Column, columns: Column, allowed_types: list[str] = CHART_TYPES
) -> Column:
    """Object extraction and chart checks in one: ``answer``, ``chart``, ``error``."""
    def read(found: Column) -> Column:
        return bind(
            chart_validation(found["body"], columns, allowed_types),
            lambda checked: F.struct(
                F.when(found["error"].isNull(), checked["answer"]).alias("answer"),
                F.when(found["error"].isNull(), checked["chart"]).alias("chart"),
                F.coalesce(found["error"], checked["error"]).alias("error"),
            ),
        )

    return bind(json_object_extract(reply), read)


def presentation_fallback(reply: Column, parsed: Column) -> Column:
    """An unreadable presentation is shown as the raw reply, without a chart."""
    failed = parsed["error"].isNotNull()
    return F.struct(
        F.when(failed, reply).otherwise(parsed["answer"]).alias("answer"),
        F.when(~failed, parsed["chart"]).alias("chart"),
    )


def preview_cell(value: Column) -> Column:
    text = strip(F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit("\n"), F.lit(" ")))
    cut = F.concat(F.substring(text, 1, PREVIEW_CELL_CHARS - 3), F.lit("..."))
    return F.when(F.length(text) <= PREVIEW_CELL_CHARS, text).otherwise(cut)


def result_preview(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    *,
    max_rows: int = MAX_PREVIEW_ROWS,
    max_cols: int = MAX_PREVIEW_COLS,
    results: DataFrame | None = None,
) -> DataFrame:
    """A clipped text table per result: ``preview`` and ``n_rows``.

    ``results`` has the keys of all results; one without rows shows its header only.
    Without it, only results that have rows are known.

    Only the first ``max_rows`` rows of a result meet in one task; its size is
    counted apart, before the shuffle.
    """
    shown = columns[:max_cols]
    first = rows.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).where(F.col("_rank") <= max_rows)
    line = F.concat_ws(" | ", *[preview_cell(F.col(c)) for c in shown])
    body = first.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_rank"), line.alias("line")))),
            lambda r: r["line"],
        ).alias("_lines")
    )
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    head = [F.lit(" | ".join(shown)), F.lit(" | ".join("---" for _ in shown))]
    notes = []
    if len(columns) > max_cols:
        notes.append(F.lit(f"... ({len(columns) - max_cols} more column(s) omitted)"))
    more = F.when(
        F.col("n_rows") > max_rows,
        F.format_string("... (%d more row(s) omitted)", F.col("n_rows") - max_rows),
    )
    text = F.concat_ws("\n", F.array(*head), F.col("_lines"), *notes, more)
    found = join_same(body, sizes, keys)
    if results is not None:
        every = results.select(F.struct(*keys).alias("_same"))
        found = every.join(found.withColumn("_same", F.struct(*keys)).drop(*keys), "_same", "left").select(
            "_same.*", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce("_lines", F.array().cast("array<string>")).alias("_lines"),
        )
    return found.select(*keys, "n_rows", text.alias("preview"))
