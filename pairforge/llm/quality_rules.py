"""Quality rules: fixed base rules, then boosted trees over document statistics.

The statistics of every whole text are counted in one pass by numpy inside tasks
(``text_stats``). The trees are fitted on all labelled documents that pass the base rules,
whose sums are formed in Spark where they are many; scoring walks the flat node arrays for
a whole batch at once.

Null or empty texts have no words and fail the base rules. Without usable labels
of both kinds the trees keep everything that passes the base rules. Repeated
rows each get the same verdict; columns besides those named here pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairforge.functions.scratch import Stages, stage
from pairforge.llm.boosted_trees import Trees, fit
from pairforge.llm.boosting import chunked, fit_chunks, margin_at
from pairforge.llm.labelled import keep_threshold, labels_once, lower_place
from pairforge.llm.numbering import with_global_position
from pairforge.llm.text_stats import COUNTS, RATES, batches_with, rates
from pairforge.llm.words import small_batches

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Labelled rows up to which they are fitted on the driver; more stay in Spark, with the same result.
ON_DRIVER = 20_000
#: Every so many labelled rows, one only sets the threshold.
HELD_OUT = 5
#: Share of good held-out documents that the threshold keeps at least.
KEEP_GOOD = 0.999
#: More of these never makes a document better.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeat_words": -1}


@dataclass
class Rules:
    trees: Trees | None
    threshold: float

    def margin(self, counts: np.ndarray) -> np.ndarray:
        return self.trees.margin(rates(counts)) if self.trees is not None else np.zeros(len(counts))

    def verdict(self, counts: np.ndarray) -> np.ndarray:
        """Which documents the base rules and the trees keep."""
        return ~base_failed(counts) & (self.margin(counts) >= self.threshold)


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeats = (counts[:, COUNTS.index(c)] for c in ("n_words", "n_repeat_words"))
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def document_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of COUNTS for every row of ``docs``."""
    small_batches(docs.sparkSession)
    schema = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in COUNTS]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts in batches_with(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in counts.T]], ["doc_id", *COUNTS]
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(count, schema)


def fit_rules(counts: DataFrame, labels: DataFrame, *, target: str = "quality") -> Rules:
    """Fit the trees on all labelled rows that pass the base rules.

    In the order of a hash of ``doc_id`` every fifth row is held out for the threshold.
    """
    known = counts.join(labels_once(labels, target), "doc_id")
    passing = known.where(
        (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    )
    by = [F.xxhash64(F.lit(7), "doc_id"), F.col("doc_id"), *map(F.col, COUNTS)]
    monotone = np.array([MONOTONE.get(c, 0) for c in RATES])
    with Stages() as stages:
        passing = stages.write(passing.select("doc_id", *COUNTS, "label"), "labelled")
        if passing.count() > ON_DRIVER:
            return _fit_many(stages, with_global_position(passing, by), monotone)
        rows = passing.orderBy(*by).toPandas()
    x, y = rates(rows[COUNTS].to_numpy()), rows["label"].to_numpy(float)
    held = np.arange(len(y)) % HELD_OUT == HELD_OUT - 1
    if len(np.unique(y[~held])) < 2:
        return Rules(None, -np.inf)
    trees = fit(x[~held], y[~held], monotone)
    good = trees.margin(x[held & (y == 1)])
    return Rules(trees, keep_threshold(good, KEEP_GOOD, 0.0) if len(good) else -np.inf)


def _fit_many(stages: Stages, rows: DataFrame, monotone: np.ndarray) -> Rules:
    """``fit_rules`` over numbered rows that stay in Spark."""
    held = F.col("position") % HELD_OUT == HELD_OUT - 1
    told = rows.groupBy(held.alias("held")).agg(
        F.count("*").alias("n"), F.avg("label").alias("share"), F.min("label").alias("least"), F.max("label").alias("most"),
        F.count_if(F.col("label") == 1).alias("good"),
    )
    by = {row.held: row for row in told.collect()}
    if by[False].least == by[False].most:
        return Rules(None, -np.inf)

    def features(batch: pa.RecordBatch) -> np.ndarray:
        return rates(np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in COUNTS], axis=1))

    own = rows.select(*COUNTS, "label", "position")
    train = stages.write(chunked(own.where(~held), by[False].n, features), "train")
    trees = fit_chunks(stages, train, by[False].n, by[False].share, monotone)
    if not by[True].good:
        return Rules(trees, -np.inf)
    good = stages.write(chunked(own.where(held & (F.col("label") == 1)), by[True].good, features), "good")
    return Rules(trees, min(0.0, margin_at(good, trees, len(RATES), lower_place(by[True].good, 1 - KEEP_GOOD))))


def quality_rules(docs: DataFrame, labels: DataFrame, *, target: str = "quality") -> DataFrame:
    """Per row of ``docs``: its counts, ``margin``, ``base_failed`` and ``kept``."""
    counts = stage(document_counts(docs), "counts")
    rules = fit_rules(counts, labels, target=target)
    schema = f"{', '.join(f'{n} {t}' for n, t in counts.dtypes)}, margin double, base_failed boolean, kept boolean"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.stack([batch.column(c).to_numpy() for c in COUNTS], axis=1)
            found = [rules.margin(own), base_failed(own), rules.verdict(own)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, found)], [*batch.schema.names, "margin", "base_failed", "kept"]
            )

    return counts.mapInArrow(judge, schema)


def keep_by_rules(docs: DataFrame, labels: DataFrame, *, target: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The counts are staged only to fit the trees; a second pass over the texts
    filters each batch in place, so no text is shuffled.
    """
    small_batches(docs.sparkSession)
    rules = fit_rules(stage(document_counts(docs), "counts"), labels, target=target)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts in batches_with(batches, "text"):
            yield batch.filter(pa.array(rules.verdict(counts)))

    return docs.mapInArrow(keep, docs.schema)
