from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pairforge.functions.scratch import stage
from pairforge.llm import co_training, poisson_mixing, quality_rules
from tests.llm.test_jaccard import brute
from tests.llm.test_mixing_packing import check_packing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage got and made."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        made = stage(function(spark, docs, SF), "step")
        out.append((name, docs, made))
        docs = made
    return out


def test_stages_keep_the_columns(steps):
    assert [name for name, *_ in steps] == ["quality rules", "quality classifier", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    for _, docs, made in steps[:-1]:
        assert made.dtypes == steps[0][1].dtypes
        rows = {tuple(r) for r in docs.collect()}
        assert {tuple(r) for r in made.collect()} <= rows


def test_filters_keep_good_documents(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for _, docs, made in steps[:2]:
        before, after = ({r.doc_id for r in df.select("doc_id").collect()} for df in (docs, made))
        lost = [d for d in before - after if labels.get(d) == 1]
        if docs is steps[0][1]:
            failed = {r.doc_id for r in quality_rules.quality_rules(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("base_failed").collect()}
            lost = [d for d in lost if d not in failed]
            assert len(before - after) > 50
        assert len(lost) <= 1


def test_classifier_rejects_bad_documents_that_rules_left(spark, steps):
    """Held-out labels: the classifier sees no label of the documents it is asked about."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = steps[0][1]
    few = labels.where("doc_id % 3 > 0")
    asked = docs.join(labels.where("doc_id % 3 = 0").select("doc_id", "quality"), "doc_id")
    kept = co_training.keep_by_quality(asked, few, fit_on=docs).groupBy("quality").count().collect()
    before = {r.quality: r["count"] for r in asked.groupBy("quality").count().collect()}
    after = {r.quality: r["count"] for r in kept}
    assert after.get(0, 0) < 0.3 * before[0] and after[1] >= 0.98 * before[1]
    _, given, made = steps[1]
    assert made.count() < given.count()


def test_one_document_of_each_group(steps):
    _, docs, made = steps[2]
    groups = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in made.collect()) == sorted({c for *_, c in groups})


def test_mixing_and_packing(steps):
    _, docs, made = steps[3]
    expected = Counter((r.doc_id, r.text) for r in poisson_mixing.mix_sources(docs).collect())
    assert Counter((r.doc_id, r.text) for r in made.collect()) == expected
    _, docs, packed = steps[4]
    check_packing(packed.collect(), [len(r.text.split()) + 1 for r in docs.collect()], (512, 1024, 2048, 4096))


def test_run_is_registered(spark, steps):
    rows = entry.queries()["pipeline"](spark, SF).collect()
    assert Counter((r.doc_id, r.piece_tokens) for r in rows) == Counter((r.doc_id, r.piece_tokens) for r in steps[-1][2].collect())


def test_every_operator_has_its_query():
    for n in range(1, 14):
        assert [name for name in entry.queries() if name.startswith(f"op{n}_")]
