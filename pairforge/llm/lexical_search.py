"""Ranked lexical search over bit-sliced Bloom signatures of documents.

Every document has a Bloom signature of its terms, as wide as its vocabulary asks for.
Signatures of a few hundred documents of like width are stored as *slices*: slice ``b`` is
a bitmap with one bit per document, set where the signature has bit ``b``. The bitmap of a
term is the AND of its three slices. It holds every document with the term, and some
without it. A term that occurs 2, 3, 4, 6, 9 or 16 times in a document is entered once more
for each of these levels, so the slices also bound how often it occurs.

For an item, the bitmaps of its terms, each weighted by what the term can add at most to
the score of a document of that length, are summed to an upper bound per document. The
documents with the best bounds of each item are scored exactly; the tenth best exact score
is a floor, and every document whose bound reaches the floor is scored exactly too. All
others are provably outside of the first ten.

Of documents with equal texts only the ten with the smallest ids can be among the first
ten, so the others are not indexed; all counts include them. Items are worked off in blocks of
``ITEM_BLOCK``, for which alone the driver holds terms and weights; documents stay in Spark.

A null or empty text has no terms. Documents of equal score are ranked by ``doc_id``, nulls
last; a repeated row is a document of its own. Items of equal id and text are one item, an
item without terms has no rows, and items of equal id and different texts are ranked each by
itself. Empty tables give no rows. Only ids and texts are read, so further columns may have
any names. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.functions.joins import lookup_join
from pairforge.llm.numbering import with_global_position
from pairforge.functions.scratch import Stages, stage
from pairforge.llm.words import BASE, CHUNK_BYTES, LOWER, Words, bytes_of, mix, small_batches

K = 10
ITEM_BLOCK = 1_000
#: Documents per item that are scored to find the floor.
SEEDS = 30
#: A signature bit count per entry between this and its double; hashes per entry; widest signature.
BITS_PER_ENTRY, HASHES, MAX_WIDTH_BITS = 8, 3, 21
#: Cells (signature bits times documents) and documents of a block at most.
BLOCK_CELLS, BLOCK_DOCS = 1 << 23, 512
#: Numbers of occurrences that have an entry of their own.
LEVELS = np.array([1, 2, 3, 4, 6, 9, 16])

IN_TERM = np.zeros(256, bool)
IN_TERM[48:58] = IN_TERM[65:91] = IN_TERM[97:123] = IN_TERM[128:] = True
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = {c: c + 32 for c in range(65, 91)}

INDEX = "keys array<bigint>, lengths array<bigint>, width int, slices binary"
BOUNDS = "item int, key bigint, bound bigint"


def terms_of(text: str | None) -> list[str]:
    """Distinct terms of one item."""
    return sorted(set(TERM.findall((text or "").translate(LOWERED))))


def split_terms(column: pa.Array) -> Iterator[Words]:
    """Terms of all rows, in runs of whole rows of about CHUNK_BYTES."""
    data, offsets = bytes_of(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        to = min(max(int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1, at + 1), n)
        part, own = LOWER[data[offsets[at] : offsets[to]]], offsets[at : to + 1] - offsets[at]
        border = np.zeros(len(part) + 1, bool)
        border[own] = True
        inside = np.concatenate([[False], IN_TERM[part], [False]])
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
        yield Words(part, own, start, end, np.searchsorted(start, own), slice(at, to))
        at = to


def count_terms(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) in order, and how often each occurs."""
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return row[at], term[at], np.diff(np.append(at, len(row)))


def entry_hashes(term: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """A hash per entry, a term at a level; its three bit positions are taken from it."""
    with np.errstate(over="ignore"):
        return mix(term + (np.asarray(level).astype(np.uint64) + np.uint64(1)) * np.uint64(BASE))


def positions(entry: np.ndarray, width: int) -> list[np.ndarray]:
    return [(entry >> np.uint64(MAX_WIDTH_BITS * i)).astype(np.int64) & (width - 1) for i in range(HASHES)]


def index_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of bit-sliced signatures from rows of ``key, text``."""
    waiting: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for batch in batches:
        keys = np.asarray(batch.column(0))
        for words in split_terms(batch.column(1)):
            row, term, tf = count_terms(words.row, words.hashes())
            n_levels = np.searchsorted(LEVELS, tf, "right")
            of = np.repeat(np.arange(len(term)), n_levels)
            level = np.arange(len(of)) - np.repeat(np.cumsum(n_levels) - n_levels, n_levels)
            entries = entry_hashes(term[of], level)
            ends = np.searchsorted(row[of], np.arange(len(words.counts) + 1))
            own_keys = keys[words.rows]
            for r in np.flatnonzero(words.counts):
                own = entries[ends[r] : ends[r + 1]].copy()  # a view would hold the entries of the whole run
                width = 1 << min(MAX_WIDTH_BITS, max(6, int(BITS_PER_ENTRY * len(own) - 1).bit_length()))
                block = waiting.setdefault(width, [])
                block.append((int(own_keys[r]), int(words.counts[r]), own))
                if len(block) == max(8, min(BLOCK_DOCS, BLOCK_CELLS // width)):
                    yield _sliced(width, waiting.pop(width))
    for width, block in waiting.items():
        yield _sliced(width, block)


def _sliced(width: int, block: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    cells = np.zeros((width, len(block)), bool)
    doc = np.repeat(np.arange(len(block)), [len(entry) for _, _, entry in block])
    for at in positions(np.concatenate([entry for _, _, entry in block]), width):
        cells[at, doc] = True
    return pa.record_batch(
        [
            pa.array([[key for key, _, _ in block]], pa.list_(pa.int64())),
            pa.array([[n for _, n, _ in block]], pa.list_(pa.int64())),
            pa.array([width], pa.int32()),
            pa.array([np.packbits(cells, axis=1).tobytes()], pa.binary()),
        ],
        names=["keys", "lengths", "width", "slices"],
    )


@dataclass
class ItemBlock:
    """Items with their terms as numbers, and the corpus counts that scores need."""

    item_ids: list
    terms: np.ndarray  # sorted hashes
    item_terms: np.ndarray  # number of each term of each item, item after item
    item_starts: np.ndarray
    item_sizes: np.ndarray
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0

    @classmethod
    def of(cls, items: list[tuple[object, list[str]]]) -> ItemBlock:
        """Items that have terms."""
        flat = [term for _, terms in items for term in terms]
        hashes = np.concatenate([w.hashes() for w in split_terms(pa.array(flat, pa.string()))])
        terms, number = np.unique(hashes, return_inverse=True)
        sizes = np.array([len(terms) for _, terms in items])
        return cls([i for i, _ in items], terms, number, np.cumsum(sizes) - sizes, sizes)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash among the terms, -1 for others."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def share(self, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a term adds for each unit of its weight."""
        m = 10 + 90 * lengths * self.n_docs // self.n_terms
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)

    def bounds(self, lengths: np.ndarray, width: int, slices: bytes) -> np.ndarray:
        """An upper bound of the score of each item (row) for each document of an index block."""
        n, bitmap = len(lengths), np.frombuffer(slices, np.uint8).reshape(width, -1)
        levels = np.zeros((len(self.terms), n), np.uint8)
        alive, before = np.arange(len(self.terms)), np.uint8(255)
        for level in range(len(LEVELS)):
            a, b, c = positions(entry_hashes(self.terms[alive], level), width)
            present = bitmap[a] & bitmap[b] & bitmap[c] & before
            some = present.any(axis=1)
            alive, before = alive[some], present[some]
            if not len(alive):
                break
            levels[alive] += np.unpackbits(before, axis=1)[:, :n]
        most = np.append(LEVELS - 1, np.iinfo(np.int32).max)[:, None]
        share = self.share(np.minimum(most, lengths), lengths)
        used = np.flatnonzero(levels.any(axis=1))
        value = np.zeros((len(used) + 1, n), np.int64)  # the last row stands for terms that no document has
        value[:-1] = self.weights[used, None] * share[levels[used], np.arange(n)]
        place = np.full(len(self.terms), len(used))
        place[used] = np.arange(len(used))
        return np.add.reduceat(value[place[self.item_terms]], self.item_starts, axis=0)


def _blocks(batches: Iterator[pa.RecordBatch], block: ItemBlock) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of each index block, with the bounds of all items."""
    for batch in batches:
        for row in batch.to_pylist():
            yield np.array(row["keys"]), block.bounds(np.array(row["lengths"]), row["width"], row["slices"])


def _bound_rows(item: np.ndarray, key: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(item.astype(np.int32)), pa.array(key.astype(np.int64)), pa.array(bound.astype(np.int64))],
        names=["item", "key", "bound"],
    )


def best_bounds(index: DataFrame, shared, n: int = SEEDS) -> DataFrame:
    """The ``n`` documents with the highest bounds per item; each task reports its own ``n`` best."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        keys = np.zeros((len(block.item_ids), 0), np.int64)
        best = np.zeros_like(keys)
        for own_keys, bounds in _blocks(batches, block):
            keys = np.concatenate([keys, np.broadcast_to(own_keys, bounds.shape)], axis=1)
            best = np.concatenate([best, bounds], axis=1)
            if best.shape[1] > n:
                top = np.argpartition(-best, n - 1, axis=1)[:, :n]
                keys, best = np.take_along_axis(keys, top, 1), np.take_along_axis(best, top, 1)
        item, at = np.nonzero(best > 0)
        yield _bound_rows(item, keys[item, at], best[item, at])

    found = index.mapInArrow(search, BOUNDS)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "key"))
    return found.withColumn("_rank", rank).where(f"_rank <= {n}").drop("_rank")


def reaching_bounds(index: DataFrame, shared, floors: np.ndarray) -> DataFrame:
    """Every document and item whose bound reaches the floor of the item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bounds in _blocks(batches, shared.value):
            item, at = np.nonzero(bounds >= np.maximum(1, floors)[:, None])
            yield _bound_rows(item, keys[at], bounds[item, at])

    return index.mapInArrow(search, BOUNDS)


def exact_scores(docs: DataFrame, candidates: DataFrame, shared) -> DataFrame:
    """``item, doc_id, score`` of candidate documents, counted from their whole texts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: ItemBlock = shared.value
        for batch in batches:
            asked = batch.column(2).to_pylist()
            for words in split_terms(batch.column(1)):
                number = block.numbers(words.hashes())
                known = number >= 0
                row, term, tf = count_terms(words.row[known], number[known])
                found = row * len(block.terms) + term
                of_row = asked[words.rows]
                pair_row = np.repeat(np.arange(len(of_row)), [len(items) for items in of_row])
                pair_item = np.array([i for items in of_row for i in items], np.int64)
                sizes = block.item_sizes[pair_item]
                first = np.cumsum(sizes) - sizes
                within = np.arange(sizes.sum()) - np.repeat(first, sizes)
                term = block.item_terms[np.repeat(block.item_starts[pair_item], sizes) + within]
                row = np.repeat(pair_row, sizes)
                at = np.minimum(np.searchsorted(found, row * len(block.terms) + term), max(0, len(found) - 1))
                hit = found[at] == row * len(block.terms) + term if len(found) else np.zeros(len(row), bool)
                times = np.where(hit, tf[at], 0) if len(found) else np.zeros(len(row), np.int64)
                adds = block.weights[term] * block.share(times, words.counts[row])
                sums = np.add.reduceat(adds, first) if len(first) else np.zeros(0, np.int64)
                ids = batch.column(0).slice(words.rows.start, len(of_row)).take(pa.array(pair_row))
                yield pa.record_batch(
                    [pa.array(pair_item.astype(np.int32)), ids, pa.array(sums.astype(np.int64))], names=["item", "doc_id", "score"]
                )

    asked = candidates.groupBy("key").agg(F.collect_set("item").alias("items"))
    met = lookup_join(docs, asked, ["key"], "inner", salt_on=["doc_id"])
    return met.select("doc_id", "text", "items").mapInArrow(score, "item int, doc_id bigint, score bigint")


def corpus_counts(docs: DataFrame, block: ItemBlock) -> ItemBlock:
    """Fill in document and term counts of the whole corpus and the weights of the terms."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(len(shared.value.terms), np.int64), 0, 0
        for batch in batches:
            for words in split_terms(batch.column(0)):
                number = shared.value.numbers(words.hashes())
                known = number >= 0
                # One cell per document and term, so that repeats count once.
                cells = np.unique(words.row[known] * len(df) + number[known])
                df += np.bincount(cells % len(df), minlength=len(df))
                n_docs += int((words.counts > 0).sum())
                n_terms += int(words.counts.sum())
        yield pa.record_batch([pa.array([[n_docs, n_terms, *df.tolist()]], pa.list_(pa.int64()))], names=["counts"])

    counted = docs.select("text").mapInArrow(count, "counts array<bigint>")
    sums = counted.select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    total = {r["pos"]: r["n"] for r in sums}
    block.n_docs, block.n_terms = total.get(0, 0), total.get(1, 0)
    block.weights = np.array(
        [math.floor(1000 * math.log((2 * block.n_docs + 2) / (2 * total.get(i + 2, 0) + 1))) for i in range(len(block.terms))], np.int64
    )
    return block


def without_crowds(docs: DataFrame, k: int = K) -> DataFrame:
    """Documents, of equal texts only those with the ``k`` smallest ids (and equal ids)."""
    by_id = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last())
    crowds = (
        docs.select("digest", "doc_id")
        .withColumn("_rank", F.row_number().over(by_id))
        .where(f"_rank <= {k}")
        .where(f"_rank = {k}")
        .select("digest", F.struct(F.col("doc_id").alias("id")).alias("_last"))
    )
    met = lookup_join(docs, stage(crowds, "crowds"), ["digest"], "left", salt_on=["doc_id"])
    return met.where("_last is null or _last.id is null or doc_id <= _last.id").drop("_last")


def _numbered(items: DataFrame) -> DataFrame:
    """Distinct items, numbered in an order that does not depend on partitions."""
    distinct = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null").distinct()
    return with_global_position(distinct, ["item_id", "text"])


def search(docs: DataFrame, items: DataFrame, k: int = K, item_block: int = ITEM_BLOCK) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    keyed = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    numbered = _numbered(items)
    results = []
    with Stages() as stages:
        distinct = without_crowds(keyed.withColumn("digest", F.unhex(F.sha2("text", 256))).where("text is not null"), k)
        index = stages.write(distinct.select("key", "text").mapInArrow(index_documents, INDEX), "signatures")
        for start in range(0, numbered.count(), item_block):
            in_block = numbered.where(F.col("position").between(start, start + item_block - 1)).collect()
            asked = [(r["item_id"], terms) for r in in_block if (terms := terms_of(r["text"]))]
            if not asked:
                continue
            block = corpus_counts(rows, ItemBlock.of(asked))
            if not block.n_docs:
                continue
            shared = spark.sparkContext.broadcast(block)
            seeds = stages.write(best_bounds(index, shared), "seeds")
            best = _first(exact_scores(keyed, seeds, shared), k).where(f"rank = {k}").collect()
            floors = np.zeros(len(asked), np.int64)
            for r in best:
                floors[r["item"]] = r["score"]
            reaching = stages.write(reaching_bounds(index, shared, floors), "candidates")
            ranked = _first(exact_scores(keyed, reaching, shared), k)
            names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(asked)], "item int, item_id bigint")
            results.append(stage(ranked.join(F.broadcast(names), "item").drop("item"), "ranked"))
    if not results:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("item_id", "rank", "doc_id", "score")


def _first(scores: DataFrame, k: int) -> DataFrame:
    order: list[Column] = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    ranked = scores.where("score > 0").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(f"rank <= {k}")


SEARCH_SQL = r"""
WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), docs AS (
  SELECT r, doc_id, len(terms)::BIGINT AS n, terms FROM worded WHERE len(terms) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs
), counts AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs
), lengths AS (
  SELECT r, doc_id, 100 - 90 + (90 * n * n_docs) // n_terms AS m FROM docs, corpus
), scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (r)
  GROUP BY ALL
), ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INT AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
