"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


def labels_once(labels: DataFrame, target: str) -> DataFrame:
    """One label per document; a document with a null or with differing labels has none."""
    known = labels.where(f"doc_id is not null and {target} is not null").select("doc_id", F.col(target).alias("label"))
    once = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    return once.where("label = _most").drop("_most")


def first_by_hash(df: DataFrame, n: int, seed: int, columns: list[str]) -> DataFrame:
    """The ``n`` rows with the smallest hash of their ``doc_id``: a sample that does not depend on partitions."""
    return df.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n).select(*columns)


def lower_place(n: int, share: float) -> int:
    """The place of a quantile in ``n`` sorted values, as numpy's method ``lower`` takes it."""
    return int(np.floor((n - 1) * share))


def keep_threshold(good: np.ndarray, keep: float, most: float = 0.5) -> float:
    """A threshold at or below ``most`` which keeps at least the share ``keep`` of good scores."""
    return float(min(most, np.sort(good)[lower_place(len(good), 1 - keep)])) if len(good) else 0.0


def cost_threshold(good: np.ndarray, bad: np.ndarray, good_cost: float, most: float = 0.5) -> float:
    """The threshold, at most ``most``, of least cost: the share of bad scores kept and ``good_cost`` times that of good ones rejected.

    One mislabelled row moves it little, as both kinds count.
    """
    if not len(good) or not len(bad):
        return 0.0
    tried = np.append(np.unique(np.concatenate([good, bad])), most)
    tried = tried[tried <= most]
    cost = [(bad >= t).mean() + good_cost * (good < t).mean() for t in tried]
    return float(tried[int(np.argmin(cost))])
