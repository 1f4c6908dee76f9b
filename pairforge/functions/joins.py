"""Joins and orderings that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.functions.scratch import stage

BROADCAST_BYTES = 32 * 1024 * 1024
#: Rows of one key that a task joins at most; a key with more is spread over several.
ROWS_PER_TASK = 1_000_000
#: In memory a row of numbers takes a few times the bytes it has in a Parquet file.
FILE_TO_MEMORY = 4
#: What a row takes in a hash table besides its values.
ROW_BYTES = 64
FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")


def fits_broadcast(df: DataFrame) -> bool:
    """Measure a lookup table before it is broadcast.

    The files of a stage table of numbers tell its size. Repeated texts and arrays take
    hundreds of times their bytes in a file, so files only tell that a table is too large;
    otherwise its rows are counted, then measured by one aggregate that brings one row back.
    """
    written = getattr(df, "stage_bytes", None)
    if written is not None:
        if all(kind in FIXED_WIDTH for _, kind in df.dtypes):
            return written * FILE_TO_MEMORY <= BROADCAST_BYTES
        if written > BROADCAST_BYTES or df.count() * ROW_BYTES > BROADCAST_BYTES:
            return False
    size = df.select((F.octet_length(F.to_json(F.struct("*"))) + ROW_BYTES).alias("n")).agg(F.sum("n")).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def _spread_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], how: str, heavy: DataFrame, salt_on: list[str]
) -> DataFrame:
    """Join by key and salt; ``heavy`` has the keys that need ``_salts`` tasks, all others have salt 0.

    The lookup table was measured as too large, but Spark takes it for its files, which may be
    hundreds of times smaller, and would broadcast it once ``heavy`` proves empty; the hints prevent that.
    """
    heavy = F.broadcast(heavy) if fits_broadcast(heavy) else heavy.hint("merge")
    salt = F.pmod(F.xxhash64(*salt_on), F.coalesce("_salts", F.lit(1))).cast("int")
    last = F.coalesce("_salts", F.lit(1)).cast("int") - 1
    spread = facts.join(heavy, keys, "left").withColumn("_salt", salt).drop("_salts")
    copies = (
        lookup.join(heavy, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_salts")
    )
    return spread.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    salt_on: list[str],
    small: bool | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Join facts to a lookup table that has one row per key.

    A lookup table measured as small is broadcast, so facts are not shuffled.
    Otherwise facts are counted per key, map-side first, and a key with more than
    ``rows_per_task`` of them is spread by a hash of ``salt_on`` over as many
    tasks as its count asks for. Only the lookup rows of such keys are copied.
    """
    if small if small is not None else fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), keys, how)
    rows_per_task = rows_per_task or ROWS_PER_TASK
    counts = facts.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_task)
    # Written, as facts would be read again wherever it is used.
    heavy = stage(counts.select(*keys, F.ceil(F.col("_n") / rows_per_task).alias("_salts")), "heavy")
    return _spread_join(facts, lookup, keys, how, heavy, salt_on)


def weighted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    weight: str,
    salt_on: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Join facts to a lookup table that knows how many facts each key has.

    As ``lookup_join``, without a pass over the facts to count them.
    """
    if fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), key)
    rows_per_task = rows_per_task or ROWS_PER_TASK
    heavy = lookup.where(F.col(weight) > rows_per_task).select(
        key, F.ceil(F.col(weight) / rows_per_task).alias("_salts")
    )
    return _spread_join(facts, lookup, [key], "inner", heavy, [salt_on])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key in the given order, reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, "_row.*").select(*df.columns)


def join_same(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys where null matches null (structs compare that way)."""
    rest = [c for c in other.columns if c not in keys]
    left = df.withColumn("_same", F.struct(*keys))
    return left.join(other.select(F.struct(*keys).alias("_same"), *rest), "_same").drop("_same")


def _segments(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows with ``_key``: their keys and the segment of the order they lie in.

    Segments are range partitions of keys and ordinal, so they hold about equally many
    rows whatever the ordinals are. Rows of equal ordinal are told apart by a hash. The
    ranges are written once, as each reading would else sample ranges of its own.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = df.repartitionByRange(*keys, order, F.xxhash64(*hashed)).withColumn("_seg", F.spark_partition_id())
    table = stage(dealt, "segments")
    return table.withColumn("_key", F.struct(*keys, "_seg")).drop("_seg")


def _earlier_segments(keys: list[str]):
    window = Window.partitionBy(*[F.col("_key")[key] for key in keys]).orderBy("_key._seg")
    return window.rowsBetween(Window.unboundedPreceding, -1)


def with_position(
    df: DataFrame, keys: list[str], order: str, *, name: str = "position"
) -> DataFrame:
    """Number rows 0, 1, 2 .. per key by an ordinal column, without one task per key.

    Rows are numbered inside segments of the order; per-segment counts, one small
    row each, give the offsets. Numbering and join share one shuffle.
    """
    seg = _segments(df, keys, order)
    counts = seg.groupBy("_key").agg(F.count("*").alias("_n"))
    offset = F.coalesce(F.sum("_n").over(_earlier_segments(keys)), F.lit(0))
    offsets = counts.select("_key", offset.alias("_offset"))
    row = F.row_number().over(Window.partitionBy("_key").orderBy(order)) - 1
    return (
        seg.withColumn("_row", row)
        .join(offsets, "_key")
        .withColumn(name, (F.col("_offset") + F.col("_row")).cast("long"))
        .drop("_key", "_row", "_offset")
    )


def previous_value(
    df: DataFrame, keys: list[str], order: str, value: Column, name: str
) -> DataFrame:
    """Last non-null ``value`` strictly before each row per key, by segments.

    Each segment is read by its own task; what the earlier segments of the same
    key end with is carried in from a table of one row per segment.
    """
    seg = _segments(df.withColumn("_value", value), keys, order)
    ends = seg.groupBy("_key").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_end")
    )
    carry = F.last("_end", ignorenulls=True).over(_earlier_segments(keys))
    inside = Window.partitionBy("_key").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        seg.withColumn("_before", F.last("_value", ignorenulls=True).over(inside))
        .join(ends.select("_key", carry.alias("_carry")), "_key")
        .withColumn(name, F.coalesce("_before", "_carry"))
        .drop("_key", "_value", "_before", "_carry")
    )
