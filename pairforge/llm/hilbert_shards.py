"""Shards along a Hilbert curve over quantised metadata, in DataFrame operations only.

Rows close on the curve are close in every dimension, so a shard that is a run of
the curve covers a small box of the metadata and files can be pruned by any of the
dimensions. Runs are cut by row count: shards differ by one row at most (law ``rows``).

Null metadata lie at coordinate 0 and a null text has no bytes. Rows with equal
coordinates are ordered by ``doc_id`` (nulls first), then by size and checksum; rows
that are equal in all of these may change places. An empty table gives no rows. Only
``doc_id``, ``text`` and the columns of the axes are read, so further ones may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairforge.llm.numbering import with_global_position

BITS = 8
SHARDS = 40
#: Bytes of a row besides its text.
ROW_OVERHEAD = 16


def category_axis(name: str, bits: int = BITS) -> Column:
    """A hashed category as a coordinate; null is 0."""
    return F.coalesce(1 + F.crc32(F.col(name).cast("string")) % ((1 << bits) - 1), F.lit(0)).cast("int")


def magnitude_axis(name: str, bits: int = BITS) -> Column:
    """A non-negative number on a log scale, in steps of an eighth of a doubling; null is 0."""
    steps = F.floor(8 * F.log2(F.greatest(F.col(name).cast("double"), F.lit(0.0)) + 1))
    return F.coalesce(F.least(1 + steps, F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Position on the curve of a cell of the grid, by John Skilling's transform.

    Steps are folded over an array of coordinates: first the inverse undo of the
    excess work from the highest bit down, then the Gray code, then the bits of all
    axes are interleaved.
    """
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, step: Column) -> Column:
        own = F.element_at(x, step["i"] + 1)
        low = step["q"] - 1
        is_set = own.bitwiseAND(step["q"]) != 0
        flip = F.when(is_set, low).otherwise(x[0].bitwiseXOR(own).bitwiseAND(low))
        moved = lambda v, k: (k == 0) | ((k == step["i"]) & ~is_set & (step["i"] > 0))
        return F.transform(x, lambda v, k: F.when(moved(v, k), v.bitwiseXOR(flip)).otherwise(v))

    def gray(x: Column) -> Column:
        """Each coordinate xor all before it, then all xor what the last one says."""
        prefix = F.transform(x, lambda _, k: F.aggregate(F.slice(x, 1, k + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))
        last = F.element_at(prefix, -1)
        said = reduce(
            lambda a, b: a.bitwiseXOR(b),
            [F.when(last.bitwiseAND(1 << b) != 0, (1 << b) - 1).otherwise(0) for b in range(bits - 1, 0, -1)],
        )
        return F.transform(prefix, lambda v: v.bitwiseXOR(said))

    def interleave(x: Column) -> Column:
        places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
        return F.aggregate(
            places, F.lit(0).cast("bigint"),
            lambda a, p: F.call_function("shiftleft", a, F.lit(1)) + F.call_function("shiftright", F.element_at(x, p["i"] + 1), p["b"]).bitwiseAND(1).cast("bigint"),
        )

    start = F.array(*[a.cast("int") for a in axes])
    # Each step is bound to one lambda variable, so that it is computed once.
    bind = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    return bind(F.aggregate(steps, start, undo), lambda x: bind(gray(x), interleave))


def shard_by_curve(docs: DataFrame, axes: list[Column], shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, curve, law, shard, slot, grown_shard``.

    Only ids, sizes and curve positions are shuffled and written; texts stay where they are.
    """
    keys = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_OVERHEAD).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
        hilbert_index(axes, bits).alias("curve"),
    )
    placed = with_global_position(keys, ["curve", "doc_id", "size", "text_crc32"])
    total = F.broadcast(placed.agg(F.count("*").alias("_total")))
    return (
        placed.join(total)
        .withColumn("shard", F.expr(f"int(position * {shards} div _total)"))
        .select(
            "doc_id", "size", "text_crc32", "curve",
            F.lit("rows").alias("law"),
            "shard",
            F.expr(f"position - (shard * _total + {shards - 1}) div {shards}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
