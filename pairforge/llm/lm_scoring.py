"""Scores of whole texts by a word model and by a causal self-attention model on subword ids.

Documents whose crc32(doc_id) mod 7 is 2 are held out; both models learn from the others.

* Words are counted per fragment of their hash over all training documents. The counts
  of the most frequent words, a fixed number, go to the tasks; all other words meet in
  their fragments, where they are counted and scored at once.
* Words are cut into the subwords of a public vocabulary, each distinct word of a run of
  texts once. Subwords are counted over all training documents, alone for classes and
  embeddings and by the class of the subword before them.
* The attention head is trained on every window of every training document. A hash deals
  documents to rounds; in a round each task makes steps over the windows of its part from
  the parameters of the round before, and these are averaged, weighted by the windows they
  have seen. Sums are formed in Spark, in a tree, so that the driver receives a few of them
  however many tasks there are.

Null texts are empty and score their end alone. Rows without ``doc_id`` belong to the
training documents. Repeated rows count and are scored each. Without training documents
every word is unknown and the attention model is uniform over its classes. An empty table
gives no rows. Only ``doc_id`` and ``text`` are read, so further columns may have any names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairforge.functions.scratch import Stages, stage
from pairforge.llm import attention_model as A
from pairforge.llm.sums import PARTS, part_of, summed
from pairforge.llm.words import Words, split_words

#: A public byte-level vocabulary, and the pattern that cuts a text before its merges.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose counts go to every task.
FREQUENT, FREQUENT_LEAST = 1 << 18, 16
FRAGMENT_BYTES, FLUSH = 32 << 20, 1 << 22
#: Rounds of training.
ROUNDS = 4
#: Subwords of a run of texts that is handled at once.
RUN = 1 << 20

COUNT = np.dtype([("word", "<u8"), ("n", "<u4")])
RARE = np.dtype([("word", "<u8"), ("n", "<i4")])
POSTING = np.dtype([("word", "<u8"), ("row", "<i8"), ("n", "<i4")])


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes, pattern: str):
    """The tokenizer of a vocabulary file, built once per worker."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def starts_word(vocabulary: bytes, pattern: str) -> np.ndarray:
    """Which subwords begin with a space."""
    tokenizer = encoder(vocabulary, pattern)
    return np.array([tokenizer.decode_single_token_bytes(i)[:1] == b" " for i in range(tokenizer.n_vocab)])


def subwords_of(words: Words, first: np.ndarray, number: np.ndarray, tokenizer, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subwords of all rows in a row, and how many each row has; a word is encoded once, after a space.

    ``first`` has a place of each distinct word, ``number`` the distinct word of each place.
    """
    if not len(number):
        return np.zeros(0, np.uint16), np.zeros(len(words.counts), np.int64)
    data = words.data.tobytes()
    distinct = [data[a:b] for a, b in zip(words.start[first].tolist(), words.end[first].tolist())]
    flat = np.array(tokenizer.encode_ordinary(b"".join(b" " + w for w in distinct).decode()), np.uint16)
    begin = np.flatnonzero(starts[flat])
    if len(begin) != len(distinct):  # a vocabulary that parts spaces from words
        each = [np.array(tokenizer.encode_ordinary(" " + w.decode()), np.uint16) for w in distinct]
        flat, begin = np.concatenate(each), np.cumsum([0, *map(len, each)])[:-1]
    sizes = np.diff(np.append(begin, len(flat)))[number]
    ends = np.cumsum(sizes)
    at = np.arange(sizes.sum()) + np.repeat(begin[number] - (ends - sizes), sizes)
    row_ends = np.append(0, ends)[words.first]
    return flat[at], np.diff(row_ends)


def with_held_out(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, text``."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("bigint"), held.alias("held_out"), F.col("text").cast("string"))


@dataclass
class WordCounts:
    """What the word model knows: totals, and the counts of the most frequent words by hash."""

    tokens: int
    distinct: int
    documents: int
    words: np.ndarray
    counts: np.ndarray


def _blobs(rows: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows sorted by word, one blob per fragment of the hash."""
    part = (rows["word"] >> np.uint64(64 - bits)).astype(np.int32)
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(rows) else np.zeros(1, int)
    return pa.RecordBatch.from_arrays(
        [pa.array(part[edges[:-1]], pa.int32()), pa.array([rows[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())],
        ["fragment", "blob"],
    )


def _joined(group: pa.Table, kind: np.dtype) -> np.ndarray:
    rows = np.concatenate([np.frombuffer(b.as_py(), kind) for b in group["blob"]])
    return rows[np.argsort(rows["word"], kind="stable")]


def count_training_words(stages: Stages, docs: DataFrame, bits: int) -> WordCounts:
    """Count the words of all training documents; FREQUENT counts reach the driver at most."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for w in split_words(batch.column(0), lower=True):
                held.append(w.hashes())
                size += len(held[-1])
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        rows = np.empty(len(words), COUNT)
        rows["word"], rows["n"] = words, counts
        return _blobs(rows, bits)

    def count(group: pa.Table) -> pa.Table:
        rows = _joined(group, COUNT)
        first = np.flatnonzero(np.r_[True, rows["word"][1:] != rows["word"][:-1]])
        n = np.add.reduceat(rows["n"].astype(np.int64), first)
        often = n >= FREQUENT_LEAST
        words = rows["word"][first][often].view(np.int64)
        return pa.table({
            "word": pa.array([None, *words], pa.int64()),
            "n": pa.array([int(n.sum()), *n[often]], pa.int64()),
            "distinct": pa.array([len(n), *[None] * len(words)], pa.int64()),
        })

    training = docs.where(~F.col("held_out"))
    blobs = training.select("text").mapInArrow(deal, "fragment int, blob binary")
    counted = blobs.groupBy("fragment").applyInArrow(count, "word bigint, n bigint, distinct bigint")
    counted = stages.write(counted, "words")
    n, distinct = counted.where("word is null").agg(F.sum("n"), F.sum("distinct")).first()
    top = counted.where("word is not null").orderBy(F.desc("n"), "word").limit(FREQUENT).select("word", "n").toPandas()
    words, counts = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(words)
    documents = training.count()
    return WordCounts((n or 0) + documents, (distinct or 0) + (documents > 0), documents, words[order], counts[order])


def encoded(docs: DataFrame, known: WordCounts, vocabulary: bytes, pattern: str) -> DataFrame:
    """Per row: subwords, what the frequent words add to the word model, and the rare words with their counts."""
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, rare binary, ids binary"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, starts = encoder(vocabulary, pattern), starts_word(vocabulary, pattern)
        for batch in batches:
            for w in split_words(batch.column(2), lower=True):
                rows, row = len(w.counts), w.row
                hashes, places, number = np.unique(w.hashes(), return_index=True, return_inverse=True)
                ids, n_ids = subwords_of(w, places, number, tokenizer, starts)
                id_cut = np.cumsum(np.append(0, n_ids))
                at = np.minimum(np.searchsorted(known.words, hashes), max(0, len(known.words) - 1))
                is_common = known.words[at] == hashes if len(known.words) else np.zeros(len(hashes), bool)
                log_count = np.log10(known.counts[at] + 1.0) if len(known.words) else np.zeros(len(hashes))
                common = is_common[number]
                n_known = np.bincount(row[common], minlength=rows) + (known.documents > 0)
                base = np.bincount(row[common], log_count[number[common]], rows) + np.log10(known.documents + 1.0)
                # Distinct words are numbered by their hash, so rows and words sort as one number.
                key = np.sort(row[~common] * max(1, len(hashes)) + number[~common])
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
                r, word = np.divmod(key[first], max(1, len(hashes)))
                rare = np.empty(len(first), RARE)
                rare["word"], rare["n"] = hashes[word], np.diff(np.append(first, len(key)))
                cut = np.searchsorted(r, np.arange(rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[w.rows], batch.column(1)[w.rows], pa.array(w.counts + 1), pa.array(n_known.astype(np.int64)), pa.array(base),
                        pa.array([rare[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(id_cut[:-1], id_cut[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base", "rare", "ids"],
                )

    rows = docs.mapInArrow(each, schema)
    return rows.withColumn("round", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(ROUNDS)).cast("int")).withColumn("row_id", F.monotonically_increasing_id())


def rare_word_sums(rows: DataFrame, bits: int) -> DataFrame:
    """Per row: ``rare_known`` and ``rare_base``, from the words that meet in their fragments.

    A fragment holds every occurrence of its words, so the training count of each is at hand.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row, out, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rare = np.frombuffer(blob, RARE)
                own = np.empty(len(rare), POSTING)
                # Counts of held-out documents are negative.
                own["word"], own["row"], own["n"] = rare["word"], row, -rare["n"] if out else rare["n"]
                held.append(own)
                size += len(own)
                if size >= FLUSH // 2:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        p = np.concatenate(held)
        return _blobs(p[np.argsort(p["word"])], bits)

    def score(group: pa.Table) -> pa.Table:
        p = _joined(group, POSTING)
        starts = np.r_[True, p["word"][1:] != p["word"][:-1]]
        count = np.add.reduceat(np.maximum(p["n"], 0).astype(np.int64), np.flatnonzero(starts))[np.cumsum(starts) - 1]
        times = np.abs(p["n"]).astype(np.int64)
        rows, inverse = np.unique(p["row"], return_inverse=True)
        return pa.table({
            "row_id": rows,
            "rare_known": np.bincount(inverse, times * (count > 0), len(rows)).astype(np.int64),
            "rare_base": np.bincount(inverse, times * np.log10(count + 1.0), len(rows)),
        })

    blobs = rows.select("row_id", "held_out", "rare").mapInArrow(deal, "fragment int, blob binary")
    parts = blobs.groupBy("fragment").applyInArrow(score, "row_id bigint, rare_known bigint, rare_base double")
    return parts.groupBy("row_id").agg(F.sum("rare_known").alias("rare_known"), F.sum("rare_base").alias("rare_base"))


def runs_of(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows, their subwords in a row, and how many each has; about RUN subwords at a time, of whole rows."""
    blobs = batch.column(batch.schema.get_field_index("ids")).to_pylist()
    length = np.array([len(b) // 2 for b in blobs], np.int64)
    ends, at = np.cumsum(length), 0
    while at < len(blobs):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + RUN, "right")))
        yield slice(at, to), np.frombuffer(b"".join(blobs[at:to]), np.uint16).astype(np.int64), length[at:to]
        at = to


def count_alone(rows: DataFrame, size: int) -> np.ndarray:
    """How often each subword occurs in all training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for _, ids, _ in runs_of(batch):
                total += np.bincount(ids, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["at", "n"])

    counted = rows.where(~F.col("held_out")).select("ids").mapInArrow(count, "at bigint, n bigint")
    sums = counted.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[sums["at"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def count_subwords(rows: DataFrame, classes: np.ndarray) -> np.ndarray:
    """How often each subword follows each class, over all training documents.

    A table of CLASSES times the vocabulary in 4 bytes, 51 MB, whatever the corpus; it is summed
    in Spark and reaches the driver as one row per class.
    """
    size = len(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(A.CLASSES * size, np.int32)
        for batch in batches:
            for _, ids, length in runs_of(batch):
                ends = np.cumsum(length)
                before = np.insert(classes.take(ids), ends - length, classes[-1])
                np.add.at(total, before * size + np.insert(ids, ends, size - 1), np.int32(1))  # an int32 adds 25 times as fast as an int
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen].astype(np.int64))], ["at", "n"])

    def pack(group: pa.Table) -> pa.Table:
        line = np.zeros(size, np.float32)
        line[np.asarray(group["at"]) % size] = np.asarray(group["n"])
        return pa.table({"before": group["before"][:1], "line": pa.array([line.tobytes()], pa.binary())})

    counted = rows.where(~F.col("held_out")).select("ids").mapInArrow(count, "at bigint, n bigint")
    sums = counted.groupBy("at").agg(F.sum("n").alias("n")).withColumn("before", F.expr(f"at div {size}"))
    out = np.zeros((A.CLASSES, size), np.float32)
    for r in sums.groupBy("before").applyInArrow(pack, "before bigint, line binary").collect():
        out[r["before"]] = np.frombuffer(r["line"], np.float32)
    return out


def train_head(stages: Stages, rows: DataFrame, layout: A.Layout, priors: A.Priors) -> dict[str, np.ndarray]:
    """Rounds of steps from common parameters in every task, averaged by the windows seen."""
    p = A.initial(layout.n_rows)
    names = list(p)
    shared = rows.sparkSession.sparkContext.broadcast((layout, priors))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, priors = shared.value
        own, seen = A.Adam({n: x.copy() for n, x in p.items()}), 0
        for batch in batches:
            for _, ids, length in runs_of(batch):
                windows, goals, _ = A.windows_of(ids, length, layout)
                A.train_on(own, priors, layout, windows, goals)
                seen += len(windows)
        if seen:
            flat = np.concatenate([own.p[n].ravel() for n in names]).astype(np.float64) * seen
            yield part_of(seen, flat)

    for k in range(ROUNDS):
        training = rows.where(~F.col("held_out") & (F.col("round") == k)).select("ids")
        seen, total = summed(stages, training.mapInArrow(steps, PARTS))
        if seen:
            cuts = np.cumsum([p[n].size for n in names])[:-1]
            p = {n: x.reshape(p[n].shape).astype(np.float32) for n, x in zip(names, np.split(total / seen, cuts), strict=True)}
    return p


def fit_attention(stages: Stages, rows: DataFrame, vocabulary: bytes, pattern: str) -> A.Attention:
    """Classes, embeddings, the attention head and counts, each from all training documents."""
    starts = starts_word(vocabulary, pattern).astype(np.int64)
    counts = count_alone(rows, len(starts))
    layout = A.layout_of(counts, starts)
    after = count_subwords(rows, layout.classes)
    pairs = A.class_pairs(after, layout.classes)
    priors = A.Priors.of(pairs)
    trained = train_head(stages, rows, layout, priors)
    return A.Attention(layout, trained, priors, A.log_shares(layout.classes, counts), after, pairs)


def read_vocabulary(path: str) -> bytes:
    """The bytes of a vocabulary file on the driver; tasks get them from there."""
    if not Path(path).is_file():
        raise FileNotFoundError(f"no subword vocabulary at {path}; give the path of one that the driver can read")
    return Path(path).read_bytes()


def score_documents(docs: DataFrame, *, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    ranks = read_vocabulary(vocabulary)
    docs = with_held_out(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(min(max(size // FRAGMENT_BYTES, 16), 1 << 20)).bit_length()
    with Stages() as stages:
        known = count_training_words(stages, docs, bits)
        rows = stages.write(encoded(docs, known, ranks, pattern), "encoded")
        shared = docs.sparkSession.sparkContext.broadcast(fit_attention(stages, rows, ranks, pattern))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = np.concatenate([shared.value.score(ids, length) for _, ids, length in runs_of(batch)]) / np.log(10)
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(found)], [*batch.schema.names[:5], "score"])

        scored = rows.select("row_id", "doc_id", "held_out", "n_tokens", F.struct("n_known", "base").alias("frequent"), "ids").mapInArrow(
            score, "row_id bigint, doc_id bigint, held_out boolean, n_tokens bigint, frequent struct<n_known: bigint, base: double>, score double"
        )
        joined = scored.join(rare_word_sums(rows, bits), "row_id", "left")
        base = F.col("frequent.base") + F.coalesce("rare_base", F.lit(0.0))
        return stage(
            joined.select(
                "doc_id", "held_out", "n_tokens",
                (F.col("frequent.n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                F.lit(known.tokens).cast("bigint").alias("train_tokens"),
                (base - F.col("n_tokens") * float(np.log10(known.tokens + known.distinct + 1))).alias("base_score"),
                "score",
            ), "scores",
        )
