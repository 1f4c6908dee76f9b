"""Trees fitted over more rows than the driver should hold: rows lie in chunks, and sums come back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairforge.functions.scratch import Stages
from pairforge.llm.boosted_trees import Part, Trees, base_margin, bins_of, boost, cut_places

#: Rows of a chunk at most; a chunk is one row of a table.
CHUNK_ROWS = 1 << 16
#: After so many trees the margins of all rows are written anew.
REBASE = 10


def chunked(rows: DataFrame, n: int, features: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """About ``n`` rows in chunks: the ``features`` of their batches (``x``), and their ``label`` (``y``)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                if size + part.num_rows > CHUNK_ROWS:
                    yield flush(held)
                    held, size = [], 0
                held.append((features(part), part.column(part.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(np.float64)))
                size += part.num_rows
        if size:
            yield flush(held)

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        x, y = (np.concatenate(p) for p in zip(*held, strict=True))
        return _blobs(["x", "y"], x, y)

    return rows.coalesce(max(1, -(-n // CHUNK_ROWS))).mapInArrow(gather, "x binary, y binary")


def _blobs(names: list[str], *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays], names)


def _arrays(batch: pa.RecordBatch, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(b.as_py(), kind) for b in batch.column(batch.schema.get_field_index(name))]


def total(chunks: DataFrame, each: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray | int:
    """The sum of what ``each`` makes of every chunk; one array of whole numbers per task reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for found in each(batch):
                own = found if own is None else own + found
        if own is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.tobytes()], pa.binary()), pa.array([list(own.shape)], pa.list_(pa.int64()))], ["sums", "shape"]
            )

    rows = chunks.mapInArrow(add, "sums binary, shape array<bigint>").collect()
    return sum(np.frombuffer(row.sums, np.int64).reshape(row.shape) for row in rows)


def sort_keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the given ones."""
    bits = np.ascontiguousarray(x, np.float64).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def values_at(chunks: DataFrame, columns: Callable[[pa.RecordBatch], Iterator[np.ndarray]], places: list[np.ndarray]) -> list[np.ndarray]:
    """The values at these places of each sorted column, without a sort.

    They are found byte by byte, the highest first: one pass counts the values that begin
    with the bytes found so far by their next byte. What is counted does not grow with the rows.
    """
    known = [np.zeros(len(p), np.uint64) for p in places]
    after = [p.astype(np.int64) for p in places]
    for level in range(8):
        prefixes = [np.unique(k) for k in known]
        most, shift = max(map(len, prefixes)), np.uint64(56 - 8 * level)

        def count(batch: pa.RecordBatch, prefixes=prefixes, most=most, shift=shift) -> Iterator[np.ndarray]:
            for x in columns(batch):
                out = np.zeros((len(prefixes), most, 256), np.int64)
                for j, own in enumerate(prefixes):
                    keys = sort_keys(x[:, j]) >> shift
                    begin = keys >> np.uint64(8)
                    at = np.minimum(np.searchsorted(own, begin), len(own) - 1)
                    hit = own[at] == begin
                    code = at[hit] * 256 + (keys[hit] & np.uint64(255)).astype(np.int64)
                    out[j] = np.bincount(code, minlength=most * 256).reshape(most, 256)
                yield out

        counts = total(chunks, count)
        for j, own in enumerate(prefixes):
            before = np.cumsum(counts[j], axis=1)
            rows = np.searchsorted(own, known[j])
            byte = np.array([np.searchsorted(before[r], a, "right") for r, a in zip(rows, after[j], strict=True)], np.int64)
            after[j] = after[j] - np.where(byte > 0, before[rows, byte - 1], 0)
            known[j] = (known[j] << np.uint64(8)) | byte.astype(np.uint64)
    bits = [np.where(k >> np.uint64(63), k & np.uint64((1 << 63) - 1), ~k) for k in known]
    return [b.astype(np.uint64).view(np.float64) for b in bits]


def fit_chunks(stages: Stages, chunks: DataFrame, n: int, share: float, monotone: np.ndarray, **options) -> Trees:
    """``boosted_trees.fit`` over all ``n`` rows of chunks, with the same result; ``share`` is the mean of their labels.

    Each level of a tree is one pass over a byte per feature of every row.
    """
    count = len(monotone)

    def features(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield from (x.reshape(-1, count) for x in _arrays(batch, "x", np.float64))

    edges = [np.unique(v) for v in values_at(chunks, features, [cut_places(n)] * count)]
    base = base_margin(share)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(features(batch), _arrays(batch, "y", np.float64), strict=True):
                yield _blobs(["x", "y", "margin"], bins_of(x, edges), y, np.full(len(y), base))

    table, done = stages.write(chunks.mapInArrow(binned, "x binary, y binary, margin binary"), "binned"), 0

    def parts(batch: pa.RecordBatch, done: int) -> Iterator[Part]:
        columns = _arrays(batch, "x", np.uint8), _arrays(batch, "y", np.float64), _arrays(batch, "margin", np.float64)
        for x, y, margin in zip(*columns, strict=True):
            yield Part(x.reshape(-1, count), y, margin.copy(), done)

    def sums(grown: Trees, nodes: list[int]) -> np.ndarray:
        nonlocal table, done
        if len(grown.roots) - 1 >= done + REBASE:
            old, before, done = table, done, len(grown.roots) - 1
            now = done

            def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for part in parts(batch, before):
                        part.advance(grown, now)
                        yield _blobs(["x", "y", "margin"], part.binned, part.y, part.margin)

            table = stages.write(old.mapInArrow(advance, old.schema), "margins")
            stages.drop(old)
        known = done
        return total(table, lambda batch: (part.sums(grown, nodes) for part in parts(batch, known)))

    trees = boost(sums, edges, base, monotone, **options)
    stages.drop(table)
    return trees


def margin_at(chunks: DataFrame, trees: Trees, features: int, place: int) -> float:
    """The margin at a place of the sorted margins of all rows of chunks."""

    def margins(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield from (trees.margin(x.reshape(-1, features))[:, None] for x in _arrays(batch, "x", np.float64))

    return float(values_at(chunks, margins, [np.array([place])])[0][0])
