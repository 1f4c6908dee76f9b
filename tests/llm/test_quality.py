from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.llm import boosting, co_training, quality_rules
from pairforge.llm.boosted_trees import fit
from pairforge.llm.text_stats import COUNTS, RATES, rates

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def cases(documents):
    return documents(
        (1, None), (2, ""), (3, "word " * 30), (4, " ".join(f"w{i}" for i in range(40))), (4, " ".join(f"w{i}" for i in range(40))),
        (None, " ".join(f"v{i}" for i in range(25))), (6, "x" * 300_000), clash=True,
    )


def test_rules_separate_labelled_documents(spark, tables):
    docs, labels = tables
    rows = quality_rules.quality_rules(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    right = np.mean([row.kept == (row.quality == 1) for row in rows])
    lost = [row.doc_id for row in rows if row.quality == 1 and not row.kept]
    assert len(rows) > 200 and right > 0.97 and len(lost) <= 1


def test_rules_on_odd_rows(spark, documents):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (9, None, 0), (None, 1, 0)], LABELS)
    docs = cases(documents)
    rows = quality_rules.quality_rules(docs, labels).collect()
    assert len(rows) == 7
    verdicts = {(r.doc_id, r.n_words): (r.base_failed, r.kept) for r in rows}
    assert verdicts == {
        (1, 0): (True, False), (2, 0): (True, False), (3, 30): (True, False), (4, 40): (False, True),
        (None, 25): (False, True), (6, 1): (True, False),
    }
    kept = quality_rules.keep_by_rules(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 3
    assert {r.kept for r in kept.collect()} == {"own"}


def labelled_counts(spark, n, bad):
    """Counts of ``n`` documents; only the last ones by the hash of their id, ``bad`` of them, are bad and hold symbols."""
    by_hash = [r.id for r in spark.range(n).orderBy(F.xxhash64(F.lit(7), "id")).collect()]
    last = spark.createDataFrame([(i,) for i in by_hash[n - bad :]], "doc_id bigint").withColumn("bad", F.lit(True))
    rows = spark.range(n).select(F.col("id").alias("doc_id"), *[(40 + F.pmod(F.xxhash64(F.lit(c), "id"), F.lit(50))).alias(c) for c in COUNTS])
    rows = rows.join(F.broadcast(last), "doc_id", "left").withColumns({
        "n_words": F.lit(100).cast("bigint"), "n_repeat_words": F.col("n_repeat_words") % 20, "n_symbols": F.when(F.col("bad"), F.col("n_symbols")).otherwise(0),
    })
    labels = rows.select("doc_id", F.when(F.col("bad"), 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    return rows.select("doc_id", *COUNTS), labels, by_hash


def test_rules_learn_from_every_labelled_row(spark):
    """The only bad documents come after 20,000 others in the order of the hash."""
    counts, labels, _ = labelled_counts(spark, 20_500, 400)
    rules = quality_rules.fit_rules(counts, labels)
    rows = counts.toPandas()
    kept = rules.verdict(rows[COUNTS].to_numpy())
    assert rules.trees is not None and not kept[rows["n_symbols"] > 0].any() and kept[rows["n_symbols"] == 0].all()


def test_rules_of_many_rows_equal_those_fitted_in_memory(spark, monkeypatch):
    """In chunks, with margins written anew, as by one matrix in the order of the hash."""
    counts, labels, by_hash = labelled_counts(spark, 900, 200)
    labels = labels.withColumn("quality", F.when(F.xxhash64("doc_id") % 9 == 0, 1).otherwise(F.col("quality")))
    monkeypatch.setattr(quality_rules, "ON_DRIVER", 100)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 64)
    many = quality_rules.fit_rules(counts, labels)
    table = counts.join(labels, "doc_id").toPandas().set_index("doc_id").loc[by_hash]
    x, y = rates(table[COUNTS].to_numpy()), table["quality"].to_numpy(float)
    held = np.arange(len(y)) % 5 == 4
    trees = fit(x[~held], y[~held], np.array([quality_rules.MONOTONE.get(c, 0) for c in RATES]))
    for name in ("roots", "feature", "threshold", "left", "right", "value"):
        assert np.array_equal(getattr(many.trees, name), getattr(trees, name)), name
    good = trees.margin(x[held & (y == 1)])
    assert many.threshold == min(0.0, np.quantile(good, 1 - quality_rules.KEEP_GOOD, method="lower"))


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], LABELS)
    docs = cases(documents).where("false")
    assert quality_rules.keep_by_rules(docs, labels).collect() == []
    assert quality_rules.quality_rules(docs, labels).collect() == []
    with pytest.warns(UserWarning, match="every document is kept"):
        assert co_training.keep_by_quality(docs, labels).collect() == []
        assert co_training.quality_scores(docs, labels).collect() == []


def test_classifier_is_right_on_held_out_labels(spark, tables):
    docs, labels = tables
    train, held = labels.where("doc_id % 4 > 0"), labels.where("doc_id % 4 = 0")
    rows = co_training.quality_scores(docs, train).join(held, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert np.mean([r.kept for r in good]) > 0.98
    assert np.mean([not r.kept for r in bad]) > 0.7
    assert np.mean([r.score for r in good]) > np.mean([r.score for r in bad]) + 0.3


def test_classifier_on_odd_rows(spark, documents):
    docs = cases(documents)
    with pytest.warns(UserWarning, match="every document is kept"):
        none = co_training.quality_scores(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(none) == 7 and all(r.kept and r.score == 1 for r in none)
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(60)], LABELS)
    more = docs.union(documents(*[(i, ("good clean text here. " if i % 2 else "### $$$ ") * (3 + i % 5)) for i in range(10, 60)], clash=True))
    kept = co_training.keep_by_quality(more, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in range(11, 60, 2)}
    scores = [r.score for r in co_training.quality_scores(more, labels).where("doc_id = 4").collect()]
    assert len(scores) == 2 and scores[0] == scores[1]


def test_views_exchange_labels():
    """The second view is blind at first and learns from what the first hands over."""
    rng = np.random.default_rng(1)
    n = 400
    truth = rng.integers(0, 2, n).astype(float)
    strong = np.stack([truth * 4 + rng.normal(0, 0.5, n), rng.normal(size=n)], axis=1)
    weak = np.stack([truth + rng.normal(0, 1, n), rng.normal(size=n)], axis=1)
    few = 60
    alone = co_training.Logistic.fit(weak[:few], truth[:few])
    pool = strong[few:], weak[few:]
    pair = co_training.co_train((strong[:few], weak[:few]), truth[:few], lambda views: co_training.pool_sums(views, pool))
    accuracy = lambda m, x: ((m.margin(x) > 0) == truth).mean()
    assert accuracy(pair.views[1], weak) >= accuracy(alone, weak)
    assert ((pair.scores((strong, weak))[:, 2] > 0.5) == truth).mean() > 0.95


def test_counts_are_registered_in_order():
    assert COUNTS[:5] == ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_sums_over_parts_equal_sums_over_the_whole(spark, tables, monkeypatch):
    """Rounds in Spark against the same rounds over one matrix on the driver, and every score by hand."""
    docs, labels = tables
    table = co_training.features(docs).toPandas()
    pool = co_training._matrices(table["text_view"].tolist(), table["page_view"].tolist())
    known = {r.doc_id: r.quality for r in labels.collect()}
    at = [i for i in np.argsort(table["doc_id"], kind="stable") if table["doc_id"][i] in known]
    y = np.array([known[table["doc_id"][i]] for i in at], float)
    pair = co_training.co_train(tuple(x[at] for x in pool), y, lambda views: co_training.pool_sums(views, pool))
    expected = dict(zip(table["doc_id"].tolist(), pair.scores(pool).tolist()))
    rows = co_training.quality_scores(docs, labels).collect()
    assert len(rows) == len(table)
    for r in rows:
        assert np.allclose((r.text_score, r.page_score, r.score), expected[r.doc_id], atol=2e-3)
        assert r.kept == (r.score >= pair.threshold) or abs(r.score - pair.threshold) < 2e-3


def test_threshold_counts_both_kinds():
    good, bad = np.append(np.full(999, 0.9), 0.01), np.linspace(0.0, 0.4, 100)
    assert 0.4 < co_training.cost_threshold(good, bad, 20.0) <= 0.5
    assert co_training.cost_threshold(good, bad[:0], 20.0) == 0.0
    assert co_training.cost_threshold(np.array([0.1, 0.9]), np.array([0.2]), 20.0) <= 0.1
