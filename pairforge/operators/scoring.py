"""Precision, recall, F1 and exact match of predicted tables and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairforge.fixed_values import EVAL_SAMPLE_SIZE
from pairforge.functions.joins import with_position
from pairforge.functions.text import bind

METRICS = [
    "table_precision", "table_recall", "table_f1",
    "column_precision", "column_recall", "column_f1",
]


def table_names(entries: Column) -> Column:
    return F.array_distinct(F.transform(entries, lambda e: F.lower(e["table_name"])))


def qualified_columns(entries: Column) -> Column:
    """Distinct lower-case ``table.column`` of (table, columns) entries."""
    return F.array_distinct(
        F.flatten(
            F.transform(
                entries,
                lambda e: F.transform(
                    e["columns"], lambda c: F.lower(F.concat(e["table_name"], F.lit("."), c))
                ),
            )
        )
    )


def _prf_of(gold: Column, pred: Column, hits: Column, prefix: str) -> Column:
    """Precision, recall and F1 from the sizes of both sets and of what they share."""
    precision = F.when((gold == 0) & (pred == 0), 1.0).when(pred == 0, 0.0).otherwise(F.try_divide(hits, pred))
    recall = F.when(gold == 0, 1.0).otherwise(F.try_divide(hits, gold))
    f1 = F.when((gold == 0) & (pred == 0), 1.0).otherwise(
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    )
    return F.struct(
        precision.alias(f"{prefix}_precision"), recall.alias(f"{prefix}_recall"),
        f1.alias(f"{prefix}_f1"), hits.alias("hits"),
    )


def _prf(gold: Column, pred: Column, prefix: str) -> Column:
    return bind(F.size(F.array_intersect(gold, pred)), lambda hits: _prf_of(F.size(gold), F.size(pred), hits, prefix))


def set_scores(rows: DataFrame, gold: Column, pred: Column, parsed: Column) -> DataFrame:
    """Rows with scores of predicted against gold entries; null scores where not parsed.

    Both sides of an example sit in one row, so scoring needs no shuffle.
    """
    sets = rows.withColumns(
        {
            "_gt": table_names(gold), "_pt": table_names(pred),
            "_gc": qualified_columns(gold), "_pc": qualified_columns(pred),
            "_ok": parsed,
        }
    )
    scored = sets.withColumns(
        {
            "_t": F.when(F.col("_ok"), _prf(F.col("_gt"), F.col("_pt"), "table")),
            "_c": F.when(F.col("_ok"), _prf(F.col("_gc"), F.col("_pc"), "column")),
        }
    )
    same = (
        (F.col("_t.hits") == F.size("_gt")) & (F.size("_gt") == F.size("_pt"))
        & (F.col("_c.hits") == F.size("_gc")) & (F.size("_gc") == F.size("_pc"))
    )
    return scored.select(
        *rows.columns,
        *[F.col(f"_{m[0]}.{m}") for m in METRICS],
        same.alias("exact_match"),
        F.col("_ok").alias("parsed_ok"),
    )


def set_scores_of_tables(gold: DataFrame, replies: DataFrame, key: str = "id") -> DataFrame:
    """Scores of replies against gold entries that come in a table of their own.

    ``gold`` has the key and ``entries``; ``replies`` has the key, ``entries`` and ``parsed``.
    Both sides meet item by item: one aggregation by (key, item) is a full outer join of the
    two, needs one shuffle, merges duplicates before it and spreads a key with many items.
    Every key of either side gets a row. Without gold, all that a reply names is wrong; gold
    without a reply, or with one that was not parsed, has null scores and ``parsed_ok`` false.
    Rows of one key on one side are one set. Null keys are one key.
    """
    def items(side: DataFrame, mark: str, parsed: Column) -> DataFrame:
        of = lambda kind, names: F.transform(names, lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("item")))
        entries = F.coalesce("entries", F.array())
        itself = F.array(F.struct(F.lit("row").alias("kind"), F.lit("").alias("item")))
        every = F.concat(itself, of("table", table_names(entries)), of("column", qualified_columns(entries)))
        flags = {c: F.lit(c == mark) for c in ("in_gold", "in_replies")}
        return side.select(key, F.inline(every), *[v.alias(c) for c, v in flags.items()], parsed.alias("parsed_ok"))

    both = items(gold, "in_gold", F.lit(False)).unionByName(items(replies, "in_replies", F.coalesce("parsed", F.lit(False))))
    met = both.groupBy(key, "kind", "item").agg(*[F.bool_or(c).alias(c) for c in ("in_gold", "in_replies", "parsed_ok")])

    def count(kind: str, *sides: str) -> Column:
        there = F.col("kind") == kind
        for side in sides:
            there = there & F.col(side)
        return F.count_if(there)

    row = F.col("kind") == "row"
    sizes = met.groupBy(key).agg(
        *[F.bool_or(row & F.col(c)).alias(c) for c in ("in_gold", "in_replies", "parsed_ok")],
        *[
            count(kind, *sides).alias(f"{name}_{kind}")
            for kind in ("table", "column")
            for name, sides in {"gold": ["in_gold"], "pred": ["in_replies"], "hits": ["in_gold", "in_replies"]}.items()
        ],
    )
    scored = sizes.withColumns({
        f"_{kind[0]}": F.when(F.col("parsed_ok"), _prf_of(*[F.col(f"{name}_{kind}") for name in ("gold", "pred", "hits")], kind))
        for kind in ("table", "column")
    })
    same = F.lit(True)
    for kind in ("table", "column"):
        same = same & (F.col(f"gold_{kind}") == F.col(f"pred_{kind}")) & (F.col(f"hits_{kind}") == F.col(f"gold_{kind}"))
    return scored.select(
        key, *[F.col(f"_{m[0]}.{m}") for m in METRICS],
        F.when(F.col("parsed_ok"), same).alias("exact_match"), "parsed_ok", "in_gold", "in_replies",
    )


def score_summary(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Means over all examples, an unparseable one counting as zero.

    With ``by`` one row per group and one for all (group columns null).
    """
    grouped = scores.rollup(*by) if by else scores.groupBy()
    summary = grouped.agg(
        F.count("*").alias("n_examples"),
        *[F.sum(F.coalesce(F.col(m), F.lit(0.0))).alias(m) for m in METRICS],
        F.count_if(F.coalesce(F.col("exact_match"), F.lit(False))).alias("exact_match"),
        F.count_if(~F.col("parsed_ok")).alias("unparseable_rate"),
    )
    n = F.when(F.col("n_examples") > 0, F.col("n_examples")).otherwise(
        F.raise_error(F.lit("no examples to aggregate")).cast("bigint")
    )
    return summary.select(
        *(by or []),
        *[(F.col(m) / n).alias(m) for m in [*METRICS, "exact_match", "unparseable_rate"]],
        n.alias("n_examples"),
    )


def eval_samples(rows: DataFrame, order: list[str], size: int = EVAL_SAMPLE_SIZE) -> DataFrame:
    """First rows with gold text, reply and parse error."""
    return rows.orderBy(*order).limit(size)


def eval_batches(rows: DataFrame, keys: list[str], order: str, batch_size: int) -> DataFrame:
    """Rows with the number of the fixed-size batch they fall in, in order."""
    numbered = with_position(rows, keys, order)
    return numbered.withColumn("batch", F.floor(F.col("position") / batch_size).cast("long"))
