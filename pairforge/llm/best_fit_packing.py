"""Variable-capacity best-fit packing of documents into training sequences.

Documents longer than the largest permitted length are cut into full pieces and a
rest. Pieces are dealt at random to shards of a bounded number of pieces, and each
shard is packed by itself, longest piece first: a piece goes to the open bin that it
fills best; if none has room, a bin of the least-cost size is opened. Every permitted
length is tried as the preferred size of new bins, the cheapest packing after
downsizing wins, and each bin shrinks to the smallest length that holds its contents.

Null and empty texts are one end token long. Repeated rows are pieces of their own.
Rows without ``doc_id`` are packed like others. An empty table gives no rows. Only
``doc_id`` and ``text`` are read, so further columns may have any names.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairforge.functions.scratch import stage
from pairforge.llm.words import small_batches

CAPACITIES = (512, 1024, 2048, 4096)
#: Attention makes a token of a sequence of this length twice as costly as the first.
ATTENTION_LENGTH = 8192
PIECES_PER_SHARD = 5_000
WORD = r"[^\x20\x09-\x0D]+"


def sequence_cost(length: int) -> float:
    """Cost of a sequence: linear layers, and attention that grows with the square."""
    return length + length * length / ATTENTION_LENGTH


def pack_with(lengths: np.ndarray, capacities: tuple[int, ...], preferred: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best fit of lengths given in falling order.

    Returns bin and offset of each piece, and what each bin holds. Open bins lie in
    buckets by free space; a bit set over the buckets finds the tightest one at once.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    loads: list[int] = []
    buckets: dict[int, list[int]] = {}
    occupied = 0
    for k, length in enumerate(lengths.tolist()):
        fitting = occupied >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            own = buckets[free]
            place = own.pop()
            if not own:
                occupied ^= 1 << free
        else:
            free = max(preferred, capacities[bisect_left(capacities, length)])
            place = len(loads)
            loads.append(0)
        bins[k], offsets[k] = place, loads[place]
        loads[place] += length
        free -= length
        if free:
            if not buckets.setdefault(free, []):
                occupied |= 1 << free
            buckets[free].append(place)
    return bins, offsets, loads


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and capacity of the bin for each length, by the cheapest preferred size."""
    capacities = tuple(sorted(capacities))
    order = np.argsort(-lengths, kind="stable")
    best = None
    for preferred in capacities:
        bins, offsets, loads = pack_with(lengths[order], capacities, preferred)
        sizes = np.array(capacities)[np.searchsorted(capacities, loads)] if loads else np.zeros(0, np.int64)
        cost = sum(sequence_cost(int(c)) for c in sizes)
        if best is None or cost < best[0]:
            best = (cost, bins, offsets, sizes)
    out_bins, out_offsets = np.empty_like(best[1]), np.empty_like(best[2])
    out_bins[order], out_offsets[order] = best[1], best[2]
    return out_bins, out_offsets, best[3][out_bins]


def token_lengths(docs: DataFrame) -> DataFrame:
    """``doc_id`` and words plus an end token of each row."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return docs.select(F.col("doc_id").cast("bigint"), (words + 1).cast("bigint").alias("n_tokens"))


def pack_documents(
    docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, *, pieces_per_shard: int = PIECES_PER_SHARD
) -> DataFrame:
    """One row per piece: ``doc_id, row_id, piece, piece_start, piece_tokens, bin, capacity, bin_offset``.

    ``row_id`` tells repeated rows of one document apart. Only lengths are shuffled.
    """
    small_batches(docs.sparkSession, pieces_per_shard)
    most = max(capacities)
    rows = stage(token_lengths(docs).withColumn("row_id", F.monotonically_increasing_id()), "lengths")
    pieces_of = F.expr(f"(n_tokens + {most - 1}) div {most}")
    count = rows.agg(F.sum(pieces_of)).first()[0] or 0
    shards = max(1, -(-count // pieces_per_shard))
    pieces = (
        rows.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces_of.cast("int") - 1)))
        .withColumn("piece_start", F.col("piece").cast("bigint") * most)
        .withColumn("piece_tokens", F.least(F.col("n_tokens") - F.col("piece_start"), F.lit(most).cast("bigint")))
        .withColumn("shard", F.pmod(F.xxhash64("row_id", "piece"), F.lit(shards)))
        .drop("n_tokens")
    )

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("piece_tokens", "descending"), ("row_id", "ascending"), ("piece", "ascending")])
        bins, offsets, sizes = pack(group["piece_tokens"].to_numpy(), capacities)
        first = group["shard"][0].as_py() << 32
        columns = {c: group[c] for c in ("doc_id", "row_id", "piece", "piece_start", "piece_tokens")}
        return pa.table({**columns, "bin": first + bins, "capacity": sizes.astype(np.int32), "bin_offset": offsets})

    schema = (
        "doc_id bigint, row_id bigint, piece int, piece_start bigint, piece_tokens bigint, "
        "bin bigint, capacity int, bin_offset bigint"
    )
    return pieces.groupBy("shard").applyInArrow(fill, schema)
