from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from pairforge.llm import words as W
from pairforge.llm.boosted_trees import fit
from pairforge.llm.text_stats import COUNTS, text_counts

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_chars": len(text), "n_lines": len(lines),
        "n_distinct_words": len(set(words)),
    }


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é#\n\t\x0b\x85$ ", max_size=60))))
def test_counts_equal_brute_force(texts):
    got = text_counts(pa.array(texts, pa.string()))
    for row, text in zip(got, texts, strict=True):
        expected = brute(text)
        assert {c: int(row[COUNTS.index(c)]) for c in expected} == expected


def test_long_and_sliced_texts():
    long = "one two three four five six seven eight nine " * 60_000
    texts = pa.array(["skip", None, long, "", "last line\nlast line"])[1:]
    assert W.CHUNK_BYTES < len(long)
    for row, text in zip(text_counts(texts), texts.to_pylist(), strict=True):
        expected = brute(text)
        assert {c: int(row[COUNTS.index(c)]) for c in expected} == expected


def test_word_hashes_do_not_depend_on_place():
    parts = list(W.split_words(pa.array(["x same y", "Same", None, "samE same"]), lower=True))
    w = parts[0]
    named = [(w.text(i), int(h)) for i, h in enumerate(w.hashes())]
    assert len({h for t, h in named if t == b"same"}) == 1 and len({h for _, h in named}) == 3


def test_trees_learn_and_keep_their_constraint():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + 0.2 * x[:, 1]) < 0.6).astype(float)
    trees = fit(x, y, np.array([-1, 0, 0]))
    assert ((trees.margin(x) > 0) == y).mean() > 0.93
    grid = np.tile(rng.random((50, 3)), (40, 1))
    grid[:, 0] = np.repeat(np.linspace(0, 1, 40), 50)
    steps = np.diff(trees.margin(grid).reshape(40, 50), axis=0)
    assert steps.max() <= 1e-9
