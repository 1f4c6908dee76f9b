"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Every document is repeated a Poisson-distributed number of times whose mean is the
repetition rate of its source: target share of the bytes over own share of the bytes.
The number comes from inverting the distribution at a hash of seed and ``doc_id``, so
it does not depend on partitions or retries. Copies are then ordered by another hash.

Documents without a source form a source of their own. A text counts one byte more
than it has, so null and empty texts take part. Repeated rows of one ``doc_id`` get
the same number of copies each; rows without ``doc_id`` are hashed as ``null``. An
empty table gives no rows. Columns ``copy`` and ``order_key`` are added; where the input has
columns of these names, they come back as ``copy_in`` and ``order_key_in``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairforge.functions.joins import lookup_join
from pairforge.functions.scratch import stage

SEED = "mix-1"
#: Exponent that flattens the shares of the sources to target weights.
TEMPERATURE = 0.5
#: Hex digits of a hash that make a number in [0, 1).
DIGITS = 13


def source_sizes(docs: DataFrame) -> DataFrame:
    """Bytes of each source, over all documents; one per text is added."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return docs.groupBy(F.struct("source").alias("_source")).agg(F.sum(size).alias("_bytes"))


def flattened_weights(sizes: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Target weights that grow with a power of the size of a source."""
    return sizes.select("_source", F.pow(F.col("_bytes").cast("double"), F.lit(temperature)).alias("weight"))


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) that the parts decide."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("null")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def poisson_steps(rate: Column) -> Column:
    """Distribution function of Poisson(rate) at 0, 1, 2 .. until what is left is below 2^-53.

    Probabilities are kept as logarithms, so that large rates do not underflow.
    """
    most = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log_p"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("steps"))

    def add(acc: Column, k: Column) -> Column:
        log_p = acc["log_p"] + F.log(rate) - F.log(k.cast("double"))
        total = acc["total"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("total"), F.array_append(acc["steps"], total).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), most), start, add, lambda acc: acc["steps"])


def repetition_rates(sizes: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """Per source: ``rate``, so that it makes up its share of ``epochs`` times all bytes."""
    both = sizes.join(weights, "_source")
    total = both.agg(F.sum("_bytes").alias("_all_bytes"), F.sum("weight").alias("_all_weights"))
    rate = epochs * F.col("weight") / F.col("_all_weights") * F.col("_all_bytes") / F.col("_bytes")
    return both.join(F.broadcast(total)).select("_source", rate.alias("rate"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, *, epochs: float = 1.0, seed: str = SEED) -> DataFrame:
    """Documents repeated to the target weights, in a global random order.

    ``weights`` has ``_source`` (a struct with the field ``source``) and ``weight``;
    a source that is not in it gets no copy. By default shares are flattened.
    """
    # Written once, one row per source: the texts are read to size them, and to repeat them.
    sizes = stage(source_sizes(docs), "source-sizes")
    rates = repetition_rates(sizes, weights if weights is not None else flattened_weights(sizes), epochs)
    steps = stage(rates.select("_source", poisson_steps(F.col("rate")).alias("_steps")), "source-steps")
    # The row travels as one value, so that no name of its columns can clash.
    keyed = docs.select(F.struct("*").alias("_row"), F.struct("source").alias("_source"), uniform(F.lit(seed), "doc_id").alias("_u"))
    drawn = lookup_join(keyed, steps, ["_source"], "inner", salt_on=["_u"])
    copies = F.expr("size(filter(_steps, s -> s <= _u))")
    repeated = drawn.select("_row", copies.alias("_n")).where("_n > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    doc_id = F.coalesce(F.col("_row.doc_id").cast("string"), F.lit("null"))
    key = F.md5(F.concat_ws(":", F.lit(seed), doc_id, F.col("copy").cast("string")))
    own = [F.col("_row")[c].alias(f"{c}_in" if c in ("copy", "order_key") else c) for c in docs.columns]
    ordered = repeated.withColumn("order_key", key).orderBy("order_key", F.col("_row.doc_id"), "copy")
    return ordered.select(*own, "copy", "order_key")


MIX_SQL = f"""
WITH sized AS (
  SELECT *, 1 + coalesce(strlen(text), 0) AS bytes,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, {DIGITS}))::UBIGINT / 16.0::DOUBLE ** {DIGITS} AS u
  FROM documents
), sources AS (
  SELECT source, sum(bytes)::DOUBLE AS own, pow(sum(bytes)::DOUBLE, {TEMPERATURE}) AS weight FROM sized GROUP BY source
), rates AS (
  SELECT source, weight / sum(weight) OVER () * sum(own) OVER () / own AS rate FROM sources
), steps AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS step
  FROM rates, (SELECT unnest(range(0, (SELECT 1 + max(ceil(rate + 12 * sqrt(rate) + 30))::BIGINT FROM rates))) AS k)
  WHERE k <= ceil(rate + 12 * sqrt(rate) + 30)
), drawn AS (
  SELECT s.doc_id, s.text, s.lang, s.source, s.n_chars, t.k + 1 AS copy
  FROM sized s JOIN steps t ON s.source IS NOT DISTINCT FROM t.source AND t.step <= s.u
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
  md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS order_key
FROM drawn
"""
