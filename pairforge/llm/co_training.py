"""Quality classifier by co-training of two views of a document.

The text view sees hashed byte pairs and rates of the whole text; the page view sees
metadata only. Both are logistic models, first fitted on labelled documents. In each round
a view labels the documents of the whole table it is surest about and hands them to the
*other* view, which takes a Newton step on its labelled documents and on all that it was
handed. Gradients and Hessians are summed in Spark, so no number of documents is too large
and none is left out. At the end each view is calibrated on held-out labels, and their
calibrated log odds are added (less the prior, which both contain), as the views share
nothing but the class.

Labelled documents for the first fit, calibration and threshold are bounded: at most
``MAX_LABELLED``, those with the smallest hash of their id. Every document is in the pool of
the rounds, and scored. The features of the pool are computed from the texts once and staged
in 2 bytes each.

Null texts count as empty and null metadata as a value of its own. Repeated rows get equal
scores and count as often as they occur. Without labels of both kinds there is no
classifier: every document is kept with score 1, and a warning tells so. Columns beside
``doc_id``, ``text`` and the metadata may have any names; ``keep_by_quality`` returns them.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairforge.functions.scratch import Stages, stage
from pairforge.llm.boosted_trees import sigmoid
from pairforge.llm.labelled import cost_threshold, first_by_hash, labels_once
from pairforge.llm.sentence_pieces import row_chunks
from pairforge.llm.sums import PARTS, part_of, summed
from pairforge.llm.text_stats import RATES, count_words, rates
from pairforge.llm.words import split_words

MAX_LABELLED = 6_000
ROUNDS = 4
#: How sure a view must be of a document to hand it over.
SURE = 0.95
#: All documents that are handed over weigh as much as this many times the labelled ones at most.
POOL_WEIGHT = 1.0
#: A rejected good document costs as much as so many kept bad ones.
GOOD_COST = 20.0
#: Features are cut at what 2 bytes can hold.
HIGHEST = 60_000.0
#: Rows whose features are read, and multiplied, at once.
CHUNK_ROWS, STEP_ROWS = 4_096, 1_024
BYTE_PAIRS, CATEGORIES, SIZES = 512, 256, 32
CATEGORICAL, NUMERIC = ["source", "lang"], ["n_chars"]
PAIR_CODE = (((np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)).astype(np.int64)


def text_view(column: pa.Array) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs, and the rates of a text."""
    parts = [np.zeros((0, BYTE_PAIRS + len(RATES)), np.float32)]
    for w in split_words(column):
        rows, data = len(w.counts), w.data.astype(np.int64)
        code = PAIR_CODE[(data[:-1] << 8) | data[1:]] if len(data) > 1 else np.zeros(0, np.int64)
        row = np.repeat(np.arange(rows), np.diff(w.offsets))
        inside = row[:-1] == row[1:]
        pairs = np.bincount((row[:-1] * BYTE_PAIRS)[inside] + code[inside], minlength=rows * BYTE_PAIRS)
        pairs = pairs.reshape(rows, BYTE_PAIRS).astype(np.float32)
        share = np.sqrt(pairs / np.maximum(pairs.sum(1, keepdims=True), 1))
        parts.append(np.hstack([share, rates(count_words(w)).astype(np.float32)]))
    return np.concatenate(parts)


def page_view(columns: dict[str, pa.Array]) -> np.ndarray:
    """One-hot codes of the hashed categories and of the magnitude of the numbers."""
    parts = []
    for name in CATEGORICAL:
        values = columns[name].cast(pa.string()).dictionary_encode()
        codes = np.array([zlib.crc32(v.encode()) % (CATEGORIES - 1) + 1 for v in values.dictionary.to_pylist()] + [0])
        at = values.indices.fill_null(len(codes) - 1).to_numpy(zero_copy_only=False)
        parts.append(_one_hot(codes[at], CATEGORIES))
    for name in NUMERIC:
        number = columns[name].cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
        parts.append(_one_hot(np.where(number < 0, 0, 1 + np.log2(np.maximum(number, 0) + 1)).astype(int).clip(0, SIZES - 1), SIZES))
    return np.hstack(parts)


def _one_hot(codes: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(codes), size), np.float32)
    out[np.arange(len(codes)), codes] = 1
    return out


@dataclass
class Logistic:
    """A logistic model on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, l2: float = 3.0, steps: int = 8) -> Logistic:
        """Newton steps on the penalised loss."""
        mean = x.mean(0, dtype=np.float64)
        squares = sum((x[at : at + STEP_ROWS].astype(np.float64) ** 2).sum(0) for at in range(0, len(x), STEP_ROWS))
        scale = np.sqrt(np.maximum(squares / len(x) - mean**2, 0)) + 1e-3
        out = cls(mean.astype(np.float32), scale.astype(np.float32), np.zeros(x.shape[1]), 0.0)
        for _ in range(steps):
            if np.abs(out.step(*out.sums(x, y), l2)).max() < 1e-3:
                break
        return out

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the loss over rows, some rows at a time."""
        size = x.shape[1] + 1
        gradient, hessian, w = np.zeros(size), np.zeros((size, size)), np.append(self.weights, self.bias)
        for at in range(0, len(x), STEP_ROWS):
            part = x[at : at + STEP_ROWS]
            z = np.ones((len(part), size), np.float32)
            np.divide(part - self.mean, self.scale, out=z[:, :-1])
            p = sigmoid(z @ w)
            gradient += z.T @ (p - y[at : at + STEP_ROWS])
            hessian += (z * np.maximum(p * (1 - p), 1e-4)[:, None].astype(np.float32)).T @ z
        return gradient, hessian

    def step(self, gradient: np.ndarray, hessian: np.ndarray, l2: float = 3.0) -> np.ndarray:
        """One Newton step on these sums and the penalty; the step itself is returned."""
        w, penalty = np.append(self.weights, self.bias), np.full(len(self.weights) + 1, l2)
        penalty[-1] = 1e-6
        step = np.linalg.solve(hessian + np.diag(penalty), gradient + penalty * w)
        self.weights, self.bias = w[:-1] - step[:-1], float(w[-1] - step[-1])
        return step

    def margin(self, x: np.ndarray) -> np.ndarray:
        parts = [((x[at : at + STEP_ROWS] - self.mean) / self.scale) @ self.weights for at in range(0, len(x), STEP_ROWS)]
        return np.concatenate(parts) + self.bias if parts else np.zeros(0)


@dataclass
class Pair:
    """Two fitted views with their calibrations."""

    views: tuple[Logistic, Logistic]
    calibrations: tuple[Logistic, Logistic]
    prior: float
    threshold: float = 0.0

    def scores(self, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Columns: probability by the text, by the page, and by both."""
        odds = [c.margin(v.margin(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, views, strict=True)]
        return np.stack([sigmoid(odds[0]), sigmoid(odds[1]), sigmoid(odds[0] + odds[1] - self.prior)], axis=1)


def handed_over(views: tuple[Logistic, Logistic], pool: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each view the rows that the other one is sure of, and what it says."""
    for own in (0, 1):
        p = sigmoid(views[1 - own].margin(pool[1 - own]))
        rows = np.flatnonzero((p >= SURE) | (p <= 1 - SURE))
        yield own, rows, (p[rows] > 0.5).astype(float)


def pool_sums(views: tuple[Logistic, Logistic], pool: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Per view and class: number of rows handed over, gradient and upper half of the Hessian, in one vector each."""
    out = []
    for own, rows, said in handed_over(views, pool):
        for kind in (0.0, 1.0):
            mine = rows[said == kind]
            gradient, hessian = views[own].sums(pool[own][mine], np.full(len(mine), kind))
            out.append(np.concatenate([[len(mine)], gradient, hessian[np.triu_indices(len(gradient))]]))
    return out


def co_train(
    labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, total_sums: Callable[[tuple[Logistic, Logistic]], list[np.ndarray]], rounds: int = ROUNDS
) -> Pair | None:
    """Fit both views; every fifth labelled row is held out for the calibration and the threshold.

    ``total_sums`` gives ``pool_sums`` over the whole pool for the views of a round.
    """
    held = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        return None
    known = [x[~held] for x in labelled]
    views = tuple(Logistic.fit(x, y[~held]) for x in known)
    for _ in range(rounds):
        sums = total_sums(views)
        for own, (view, x) in enumerate(zip(views, known, strict=True)):
            gradient, hessian = view.sums(x, y[~held])
            size = len(view.weights) + 1
            for kind, given in zip((0.0, 1.0), sums[2 * own : 2 * own + 2], strict=True):
                # What is handed over of a class weighs as much as its labelled documents at most.
                weight = min(1.0, POOL_WEIGHT * (y[~held] == kind).sum() / max(1.0, given[0]))
                gradient = gradient + weight * given[1 : size + 1]
                upper = np.zeros((size, size))
                upper[np.triu_indices(size)] = weight * given[size + 1 :]
                hessian = hessian + upper + np.triu(upper, 1).T
            view.step(gradient, hessian)
    calibrations = tuple(Logistic.fit(v.margin(x[held])[:, None], y[held], 1.0) for v, x in zip(views, labelled, strict=True))
    share = y[held].mean()
    pair = Pair(views, calibrations, float(np.log(share / (1 - share))))
    scores = pair.scores(tuple(x[held] for x in labelled))[:, 2]
    pair.threshold = cost_threshold(scores[y[held] == 1], scores[y[held] == 0], GOOD_COST)
    return pair


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    return text_view(column("text")), page_view({c: column(c) for c in [*CATEGORICAL, *NUMERIC]})


FEATURES = "doc_id bigint, text_view binary, page_view binary"
WIDTHS = (BYTE_PAIRS + len(RATES), CATEGORIES * len(CATEGORICAL) + SIZES * len(NUMERIC))


def features(docs: DataFrame) -> DataFrame:
    """Both views of every document; the page view as its few ones."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, 1):
                text, page = _views(batch)
                ones = np.nonzero(page)[1].astype(np.uint16).reshape(len(page), -1)
                blobs = [pa.array([row.tobytes() for row in x], pa.binary()) for x in (_halved(text), ones)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *blobs], ["doc_id", "text_view", "page_view"])

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *CATEGORICAL, *NUMERIC]
    return docs.select(*columns).mapInArrow(each, FEATURES)


def _matrices(text: list[bytes], page: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both views of some rows, as narrow as they come; sums widen a few rows at a time."""
    wide = np.zeros((len(page), WIDTHS[1]), np.uint8)
    if page:
        ones = np.frombuffer(b"".join(page), np.uint16).reshape(len(page), -1)
        wide[np.arange(len(page))[:, None], ones] = 1
    return np.frombuffer(b"".join(text), np.float16).reshape(-1, WIDTHS[0]), wide


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, np.ndarray]]]:
    for at in range(0, batch.num_rows, CHUNK_ROWS):
        part = batch.slice(at, CHUNK_ROWS)
        yield part, _matrices(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in ("text_view", "page_view")))


def fit_pair(stages: Stages, table: DataFrame, labels: DataFrame, *, target: str = "quality") -> Pair | None:
    """Co-train on a table of features: labelled rows on the driver, the whole table in Spark."""
    ids = table.where("doc_id is not null").select("doc_id").join(labels_once(labels, target), "doc_id")
    chosen = first_by_hash(ids.distinct(), MAX_LABELLED, 5, ["doc_id", "label"])
    # The chosen ids are bounded by the parameter, whatever the input.
    found = table.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text_view", "page_view").toPandas()
    found = found.drop_duplicates("doc_id").sort_values("doc_id")
    sizes = [1 + w + 1 + (w + 1) * (w + 2) // 2 for w in WIDTHS for _ in (0, 1)]

    def total_sums(views: tuple[Logistic, Logistic]) -> list[np.ndarray]:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(sum(sizes)), 0
            for batch in batches:
                for part, pool in _chunks(batch):
                    total += np.concatenate(pool_sums(views, pool))
                    n += part.num_rows
            yield part_of(n, total)

        _, total = summed(stages, table.select("text_view", "page_view").mapInArrow(sums, PARTS))
        return np.split(total, np.cumsum(sizes)[:-1])

    labelled, y = _matrices(found["text_view"].tolist(), found["page_view"].tolist()), found["label"].to_numpy(float)
    del found
    pair = co_train(labelled, y, total_sums)
    if pair is None:
        warnings.warn("too few labels of both kinds to fit a classifier: every document is kept", stacklevel=2)
    return pair


SCORES = "doc_id bigint, text_score double, page_score double, score double, kept boolean"


def quality_scores(docs: DataFrame, labels: DataFrame, *, target: str = "quality") -> DataFrame:
    """Per row of ``docs``: ``text_score``, ``page_score``, ``score`` and ``kept``."""
    with Stages() as stages:
        table = stages.write(features(docs), "features")
        pair = fit_pair(stages, table, labels, target=target)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, views in _chunks(batch):
                    p = pair.scores(views) if pair else np.ones((part.num_rows, 3))
                    kept = p[:, 2] >= (pair.threshold if pair else 0)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), *map(pa.array, p.T), pa.array(kept)], ["doc_id", "text_score", "page_score", "score", "kept"]
                    )

        return stage(table.mapInArrow(score, SCORES), "quality")


def keep_by_quality(docs: DataFrame, labels: DataFrame, *, target: str = "quality", fit_on: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns; no text is shuffled.

    The classifier is fitted on ``fit_on``, or on ``docs`` where that is not given. Where a filter
    went before, its input is the better choice, as most labelled bad documents are gone from ``docs``.
    """
    with Stages() as stages:
        pair = fit_pair(stages, stages.write(features(docs if fit_on is None else fit_on), "features"), labels, target=target)
    if pair is None:
        return docs

    text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, text):
                yield batch.filter(pa.array(pair.scores(_rounded(batch))[:, 2] >= pair.threshold))

    return docs.mapInArrow(keep, docs.schema)


def _rounded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views as a table of features would hold them."""
    text, page = _views(batch)
    return _halved(text).astype(np.float32), page


def _halved(text: np.ndarray) -> np.ndarray:
    return np.clip(text, -HIGHEST, HIGHEST).astype(np.float16)
