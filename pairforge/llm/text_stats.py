"""Counts about whole texts, for quality rules and classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pairforge.llm.words import BYTE_VALUES, Words, mix, powers, split_words, windows

REPEAT_WIDTH = 8
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER = np.isin(np.arange(256), np.arange(65, 91))
DIGIT = np.isin(np.arange(256), np.arange(48, 58))
MARK = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))
#: Bytes that start a code point.
LEADING = (np.arange(256) & 0xC0) != 0x80

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_chars", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words",
]


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags lie between each two offsets."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _repeats(row: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For hashes inside rows: which occur twice or more in their row, and which are not the first."""
    key = mix(values ^ mix(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def _lines(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines and repeated lines of each row; only lines that hold a word count."""
    n = len(w.data)
    cuts = np.unique(np.concatenate([w.offsets, np.flatnonzero(w.data == 10) + 1]))
    start, stop = cuts[:-1], cuts[1:].copy()
    ends_in_break = w.data[stop - 1] == 10 if n else np.zeros(0, bool)
    stop[ends_in_break] -= 1
    has_word = np.searchsorted(w.start, stop) > np.searchsorted(w.start, start)
    start, stop = start[has_word], stop[has_word]
    up, down = powers(1 << max(20, int(n).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[w.data] * up[:n], out=sums[1:])
        value = mix((sums[stop] - sums[start]) * down[start])
    row = np.searchsorted(w.offsets, start, "right") - 1
    _, later = _repeats(row, value)
    rows = len(w.counts)
    return np.bincount(row, minlength=rows), np.bincount(row[later], minlength=rows)


def count_words(w: Words) -> np.ndarray:
    """One row per text and one column per name of COUNTS."""
    rows, hashes, row = len(w.counts), w.hashes(), w.row
    out = np.zeros((rows, len(COUNTS)), np.int64)
    put = lambda name, values: out.__setitem__((slice(None), COUNTS.index(name)), values)
    put("n_words", w.counts)
    leading = LEADING[w.data]
    put("n_chars", per_row(leading, w.offsets))
    inside = np.zeros(len(w.data) + 1, np.int8)
    inside[w.start] += 1
    inside[w.end] -= 1
    put("word_chars", per_row(leading & (np.cumsum(inside[:-1]) > 0), w.offsets))
    for name, table in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_digits", DIGIT), ("n_marks", MARK)):
        put(name, per_row(table[w.data], w.offsets))
    lines, dup_lines = _lines(w)
    put("n_lines", lines)
    put("n_dup_lines", dup_lines)
    _, later = _repeats(row, hashes)
    put("n_distinct_words", w.counts - np.bincount(row[later], minlength=rows))

    grams = windows(hashes, REPEAT_WIDTH)
    whole = np.flatnonzero(row[: len(grams)] == row[REPEAT_WIDTH - 1 :]) if len(grams) else np.zeros(0, np.int64)
    twice, _ = _repeats(row[whole], grams[whole])
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, whole[twice], 1)
    np.add.at(edge, whole[twice] + REPEAT_WIDTH, -1)
    covered = np.cumsum(edge[:-1]) > 0
    put("n_repeat_words", np.bincount(row[covered], minlength=rows))
    return out


def text_counts(column: pa.Array) -> np.ndarray:
    """``count_words`` of every text of a column; a null counts as an empty text."""
    parts = [count_words(w) for w in split_words(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)


def rates(counts: np.ndarray) -> np.ndarray:
    """Features of a text that do not depend on its length, and the length itself in logs."""
    at = {name: counts[:, i].astype(np.float64) for i, name in enumerate(COUNTS)}
    words, chars, lines = (np.maximum(at[x], 1) for x in ("n_words", "n_chars", "n_lines"))
    columns = {
        "symbols": at["n_symbols"] / words,
        "dup_lines": at["n_dup_lines"] / lines,
        "repeat_words": at["n_repeat_words"] / words,
        "distinct_words": at["n_distinct_words"] / words,
        "word_length": at["word_chars"] / words,
        "upper": at["n_upper"] / chars,
        "digits": at["n_digits"] / chars,
        "marks": at["n_marks"] / words,
        "words_per_line": np.log1p(at["n_words"] / lines),
        "log_words": np.log1p(at["n_words"]),
    }
    return np.stack([columns[name] for name in RATES], axis=1)


RATES = [
    "symbols", "dup_lines", "repeat_words", "distinct_words", "word_length",
    "upper", "digits", "marks", "words_per_line", "log_words",
]


def batches_with(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Arrow batches, each with the counts of its text column."""
    for batch in batches:
        if batch.num_rows:
            yield batch, text_counts(batch.column(batch.schema.get_field_index(text)))
