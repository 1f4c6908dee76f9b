"""Every query without SQL is held against something else; this is where."""

from __future__ import annotations

from importlib import import_module

import pytest

import __spark_entry__ as entry

TESTED_BY = {
    "op1_exact_topk_search": "test_search_warc.test_search_equals_brute_force",
    "op2_best_fit_packing": "test_mixing_packing.check_packing",
    "op3_html_extraction": "test_html.test_all_pages_hold_their_article",
    "op4_ngram_jaccard_join": "test_jaccard.brute",
    "op5_quality_classifier": "test_quality.test_sums_over_parts_equal_sums_over_the_whole",
    "op6_lm_scoring": "test_lm.test_held_out_documents_are_scored_better_than_by_counts_alone",
    "op7_quality_rules": "test_quality.test_rules_separate_labelled_documents",
    "op9_warc_index_merge": "test_search_warc.test_query_equals_brute_force_on_all_pages",
    "op10_hilbert_shards": "test_mixing_packing.H",
    "op11_sentence_pieces": "test_sentence_pieces.test_query_equals_the_library_on_every_document",
    "pipeline": "test_pipeline.test_run_is_registered",
}


def test_every_query_has_sql_or_a_test_of_its_own():
    assert set(entry.LLM_QUERIES) - set(entry.LLM_ORACLES) == set(TESTED_BY)


@pytest.mark.parametrize("name", sorted(TESTED_BY))
def test_the_named_test_is_there(name):
    module, function = TESTED_BY[name].split(".")
    assert hasattr(import_module(f"tests.llm.{module}"), function)
