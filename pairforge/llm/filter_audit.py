"""What each of several filters removes, beside the others and in every order.

A document is its *failure mask*: one bit per filter that it fails. All counts depend on
the 32 masks of five filters only, so documents are counted per part and mask once and
everything else is arithmetic over one small row per part.

The filters are players of a removal game: a coalition S removes the documents that fail
any filter of it, v(S). Hart and Mas-Colell's potential P is defined from the empty
coalition up, ``|S| P(S) = v(S) + sum of P(S without i)``; the Shapley value of filter i
is ``P(all) - P(all without i)``. Potentials are kept times n!, which makes every
division exact. What a filter removes at a step of an order is ``v(S) - v(S before)``.

A null text is empty, a null source is the empty part. A document without ``doc_id`` has
no label and is no copy of a smaller id; rows with equal id and text count as often as
they occur and neither is a copy of the other. A document is good or toxic when any of
its labels says so. An empty table gives no rows. Only ``doc_id``, ``text`` and ``source``
are read, so further columns may have any names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from pairforge.functions.scratch import Stages, stage

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"


def mask_of(conditions: list[Column]) -> Column:
    """One bit per condition that holds, the first one lowest."""
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)]
    return sum(bits[1:], bits[0]).cast("int")


def text_failures() -> list[Column]:
    """Conditions A to D of a row with ``text`` and ``words``."""
    n_words, n_distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.char_length(F.regexp_replace("text", "[^A-Z]+", ""))
    return [
        n_words < 50,
        n_distinct * F.lit(100).cast("bigint") < n_words * F.lit(65).cast("bigint"),
        capitals * F.lit(100).cast("bigint") > F.char_length("text") * F.lit(5).cast("bigint"),
        F.col("text").rlike("[#$%&*|]"),
    ]


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, n, good, toxic``: documents, good ones and toxic ones per part and failure mask.

    Rows of equal id, text and part are counted before they are shuffled. The first id of
    each text is found with partial minima and met by (text, id), so a text that many
    documents share is no hot key. Documents without id take no part in joins.
    """
    rows = (
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        )
        .withColumn("words", F.array_remove(F.split("text", SPACES), ""))
        .select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask_of(text_failures()).alias("fails"))
    )
    with Stages() as stages:
        cells = stages.write(rows.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n")), "cells")
        named = cells.where("doc_id is not null")
        first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("copy", F.lit(0))
        told = (
            labels.where("doc_id is not null")
            .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
        )
        is_copy = F.coalesce("copy", F.lit(1)) * (1 << 4)
        times = lambda flag: F.coalesce(flag, F.lit(0)) * F.col("n")
        judged = (
            named.join(first, ["digest", "doc_id"], "left")
            .join(told, "doc_id", "left")
            .select("part", (F.col("fails") + is_copy).alias("fails"), "n", times("is_good").alias("good"), times("is_toxic").alias("toxic"))
        )
        unnamed = cells.where("doc_id is null").select("part", "fails", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
        counts = judged.unionByName(unnamed).groupBy("part", "fails").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
        return stage(counts, "failure-counts")


def removal_audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All orders and steps of each part, from documents counted per part and failure mask.

    ``counts`` has ``part, fails, n, good, toxic`` with one row per part and mask, so a
    part is a group of 2 ** len(filters) rows at most.
    """
    full, scale = (1 << len(filters)) - 1, factorial(len(filters))
    per_mask = counts.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("fails", F.struct("n", "good", "toxic")))).alias("by_mask")
    )

    def lost(what: str) -> Column:
        """Per coalition: the documents that fail any of its filters."""
        each = f"(a, m) -> a + if(m & s != 0, coalesce(by_mask[m].{what}, 0L), 0L)"
        return F.expr(f"transform(sequence(0, {full}), s -> aggregate(sequence(0, {full}), 0L, {each}))")

    without = f"aggregate(filter(sequence(0, {len(filters) - 1}), i -> s & (1 << i) != 0), 0L, (a, i) -> a + p[s ^ (1 << i)])"
    potential = F.expr(
        f"aggregate(sequence(1, {full}), array(0L), (p, s) -> concat(p, array(({scale} * removed_by[s] + {without}) div bit_count(s))))"
    )
    parts = (
        per_mask.select(
            "part",
            F.expr("aggregate(map_values(by_mask), 0L, (a, x) -> a + x.n)").alias("total"),
            F.expr(f"transform(sequence(0, {len(filters) - 1}), i -> coalesce(by_mask[1 << i].n, 0L))").alias("only"),
            lost("n").alias("removed_by"), lost("good").alias("good_by"), lost("toxic").alias("toxic_by"),
        )
        .withColumn("potential", potential)
    )
    orders = F.lit(["".join(order) for order in permutations(filters)])
    place = f"instr('{filters}', x) - 1"
    steps = (
        parts.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
        .withColumn("before", F.expr(f"aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (s, x) -> s | (1 << ({place})))"))
        .withColumn("i", F.expr(f"instr('{filters}', substr(filter_order, step, 1)) - 1"))
        .withColumn("own", F.expr("1 << i"))
        .withColumn("after", F.expr("before | own"))
    )
    return steps.select(
        "part", "filter_order", "step",
        F.expr("total - removed_by[after]").alias("kept"),
        F.expr("removed_by[after] - removed_by[before]").alias("removed"),
        F.expr("removed_by[own] + removed_by[before] - removed_by[after]").alias("redundant"),
        F.expr("only[i]").alias("unique_fails"),
        F.expr("good_by[after] - good_by[before]").alias("good_lost"),
        F.expr("toxic_by[after] - toxic_by[before]").alias("toxic_lost"),
        F.expr(f"potential[{full}] - potential[{full} ^ own]").alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over all documents."""
    return removal_audit(failure_counts(docs, labels))


AUDIT_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), told AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part,
         (len(words) < 50)::INT
         + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(worded.doc_id > first_id, false)::INT AS fails,
         count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM worded LEFT JOIN told ON worded.doc_id = told.doc_id
  GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, 1 << (instr('ABCDE', filter_order[step]) - 1) AS own,
         coalesce(list_sum([1 << (instr('ABCDE', filter_order[k]) - 1) FOR k IN range(1, step)]), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step)
), told_steps AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE fails & (own | before) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE fails & own != 0 AND fails & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE fails & own != 0 AND fails & before != 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE fails & own != 0 AND fails & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE fails & own != 0 AND fails & before = 0), 0)::BIGINT AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM told_steps
"""
