"""Quality gates on labels and on model metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.fixed_values import (
    INVALID_SAMPLE_SIZE,
    MAX_FAILURE_RATE,
    MAX_FALLBACK_RATE,
    MAX_UNPARSEABLE_RATE,
    MIN_COLUMN_RECALL,
    MIN_EXAMPLES_PER_SPLIT,
    MIN_TABLE_RECALL,
)
from pairforge.functions.joins import fits_broadcast, lookup_join
from pairforge.functions.text import bind, strip
from pairforge.operators.catalog import staged_catalogs


def _label_error(names: Column) -> Column:
    """First structural error of a label, or null, in table then column order."""
    def table_error(t: Column) -> Column:
        listed = F.coalesce(F.try_element_at("columns", t), F.array().cast("array<string>"))

        def column_error(known: Column) -> Column:
            bad = F.filter(listed, lambda c: ~F.array_contains(known["columns"], F.lower(c)))
            return bind(
                F.get(bad, F.lit(0)),
                lambda c: F.concat(F.lit("column "), t, F.lit("."), c, F.lit(" not in schema")),
            )

        known = F.try_element_at(F.filter(names, lambda n: n["name"] == F.lower(t)), F.lit(-1))
        missing = F.concat(F.lit("table "), t, F.lit(" not in schema"))
        return bind(known, lambda k: F.when(k.isNull(), missing).otherwise(column_error(k)))

    errors = F.filter(F.transform("tables", table_error), lambda e: e.isNotNull())
    empty = (strip(F.col("question")) == "") | (strip(F.col("query")) == "")
    return (
        F.when(names.isNull(), F.concat(F.lit("unknown db_id "), F.col("db_id")))
        .when(F.coalesce(F.size("tables"), F.lit(0)) <= 0, "no tables in label")
        .otherwise(F.coalesce(F.get(errors, F.lit(0)), F.when(empty, "empty question or query")))
    )


def validate_rows(rows: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Labelled rows with their first error (null when valid)."""
    table = staged_catalogs(catalogs)
    lookup = table.select("db_id", F.col("names").alias("_names"))
    attached = lookup_join(rows, lookup, ["db_id"], "left", salt_on=["id"], small=fits_broadcast(table))
    return attached.withColumn("error", _label_error(F.col("_names"))).drop("_names")


def split_rates(validated: DataFrame) -> DataFrame:
    """Per split: examples, invalid examples and unrounded failure and fallback rates, in one pass.

    ``validated`` holds every pair of the label job with ``known``, ``method`` and ``error``;
    only labelled pairs are examples, and only their errors count.
    """
    labelled = F.col("method").isNotNull()
    total = F.greatest(F.count("*"), F.lit(1))
    return validated.groupBy("split").agg(
        F.count_if(labelled).alias("examples"),
        (F.count_if(~labelled) / total).alias("failure_rate"),
        (F.count_if(F.col("method") == "fallback") / total).alias("fallback_rate"),
        F.count_if(labelled & F.col("error").isNotNull()).alias("invalid_examples"),
    )


def split_metrics(rates: DataFrame, *more: str) -> DataFrame:
    return rates.select(
        "split", "examples",
        F.bround("failure_rate", 4).alias("extraction_failure_rate"),
        F.bround("fallback_rate", 4).alias("fallback_rate"),
        "invalid_examples", *more,
    )


def broken_rules(
    *,
    min_examples: int = MIN_EXAMPLES_PER_SPLIT,
    max_failure_rate: float = MAX_FAILURE_RATE,
    max_fallback_rate: float = MAX_FALLBACK_RATE,
) -> Column:
    """The rules that the rates of a split break; rates are compared before rounding."""
    examples, invalid = F.col("examples"), F.col("invalid_examples")
    failure, fallback = F.col("failure_rate"), F.col("fallback_rate")

    def rule(order: int, name: str, broken: Column, text: Column) -> Column:
        return F.struct(
            F.lit(order).alias("rule_ord"), F.lit(name).alias("rule"), broken.alias("broken"),
            F.concat(F.col("split"), F.lit(": "), text).alias("message"),
        )

    rules = F.array(
        rule(0, "examples", examples < min_examples,
             F.format_string(f"only %d examples (min {min_examples})", examples)),
        rule(1, "failure_rate", failure > max_failure_rate,
             F.format_string(f"extraction failure rate %.4f > {max_failure_rate}", failure)),
        rule(2, "fallback_rate", fallback > max_fallback_rate,
             F.format_string(f"fallback rate %.4f > {max_fallback_rate}", fallback)),
        rule(3, "invalid", invalid > 0,
             F.format_string("%d structurally invalid examples", invalid)),
    )
    return F.filter(rules, lambda r: r["broken"])


def violations(rates: DataFrame, **limits: float) -> DataFrame:
    """One row per broken rule."""
    return rates.select("split", F.inline(broken_rules(**limits))).drop("broken")


def gate_verdict(rates: DataFrame, **limits: float) -> DataFrame:
    """One row: per-split metrics, broken rules, and whether the gate passed."""
    metrics = split_metrics(rates.withColumn("_broken", broken_rules(**limits)), "_broken")
    per_split = metrics.select(
        F.struct(*[c for c in metrics.columns if c != "_broken"]).alias("metrics"),
        F.transform("_broken", lambda r: r["message"]).alias("messages"),
    )
    report = per_split.agg(F.array_sort(F.collect_list(F.struct("metrics", "messages"))).alias("s"))
    return report.select(
        F.transform("s", lambda x: x["metrics"]).alias("splits"),
        F.flatten(F.transform("s", lambda x: x["messages"])).alias("violations"),
    ).withColumn("passed", F.size("violations") == 0)


class GateFailed(RuntimeError):
    """Raised after the report is written, so the run stops with its reasons."""


def require_passed(verdict: DataFrame) -> None:
    row = verdict.select("passed", "violations").first()
    if not row["passed"]:
        raise GateFailed("; ".join(row["violations"]))


def invalid_sample(
    validated: DataFrame, order: list[str], size: int = INVALID_SAMPLE_SIZE
) -> DataFrame:
    """First invalid rows per split as ``id: error``."""
    ranked = validated.where(F.col("error").isNotNull()).withColumn(
        "rank", F.row_number().over(Window.partitionBy("split").orderBy(*order))
    )
    return ranked.where(F.col("rank") <= size).select(
        "split", "rank", F.concat("id", F.lit(": "), "error").alias("line")
    )


def broken_limits(
    *,
    min_table_recall: float = MIN_TABLE_RECALL,
    min_column_recall: float = MIN_COLUMN_RECALL,
    max_unparseable_rate: float = MAX_UNPARSEABLE_RATE,
) -> Column:
    """The limits that the metrics of a run break; a missing metric breaks its limit."""
    def limit(order: int, metric: str, sign: str, bound: float) -> Column:
        value = F.col(metric)
        return F.struct(
            F.lit(order).alias("gate_ord"), F.lit(metric).alias("metric"),
            F.coalesce((value < bound) if sign == "<" else (value > bound), F.lit(True)).alias("broken"),
            F.when(value.isNull(), f"{metric} is missing")
            .otherwise(F.format_string(f"{metric} %.4f {sign} {bound}", value)).alias("message"),
        )

    limits = F.array(
        limit(0, "table_recall", "<", min_table_recall),
        limit(1, "column_recall", "<", min_column_recall),
        limit(2, "unparseable_rate", ">", max_unparseable_rate),
    )
    return F.filter(limits, lambda x: x["broken"])


def model_gates(runs: DataFrame, **limits: float) -> DataFrame:
    """One row per run and broken limit."""
    return runs.select("run_id", F.inline(broken_limits(**limits))).drop("broken")
