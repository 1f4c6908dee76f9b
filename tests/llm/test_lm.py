from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pairforge.llm import attention_model as A, lm_scoring as L

SF = "/root/testdata/sf0.01"
RANKS = L.read_vocabulary(L.VOCABULARY)
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    counts = Counter(w for i, t in rows if not held(i) for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        own = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        out.append((i, held(i), len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)))
    return sorted(out, key=str)


def found(df):
    rows = L.score_documents(df).collect()
    assert all(r.score <= 0 and np.isfinite(r.score) for r in rows)
    return rows, sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


def test_word_model_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 50)
    monkeypatch.setattr(L, "FLUSH", 2000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, plain = found(docs)
    assert plain == brute([(r.doc_id, r.text) for r in docs.collect()])
    out = [r for r in rows if r.held_out]
    assert len(out) > 100
    # The word model gives all unknown words one probability between them, so it is far from a model of their letters.
    per_word = [sum(getattr(r, c) for r in out) / sum(r.n_tokens for r in out) for c in ("score", "base_score")]
    assert per_word[0] > -4.9 and per_word[0] > per_word[1] - 0.9


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (None, "The the\u0085cat \x0b sat"), (3, "Cat"), (3, "Cat"), (4, "cat " * 30_000), (5, "x" * 50_000), (6, "\U0001f600 é")]
    assert any(held(i) for i in range(8))
    scored, plain = found(documents(*rows, clash=True))
    assert plain == brute(rows)
    twice = [r.score for r in scored if r.doc_id == 3]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_nothing_to_learn_from(spark, documents):
    only = next(i for i in range(100) if held(i))
    _, plain = found(documents((only, "a b")))
    assert plain == brute([(only, "a b")])
    assert L.score_documents(documents((1, "x")).where("false")).collect() == []


def test_every_training_window_is_trained_on(spark, monkeypatch):
    """All windows of all training documents, in whatever partitions, and in a run or in many."""
    schema = "doc_id bigint, held_out boolean, ids binary, round int"
    rng = np.random.default_rng(5)
    texts = [(i, i % 7 == 0, rng.integers(0, 300, 2000 if i == 3 else i % 90).astype(np.uint16).tobytes(), i % L.ROUNDS) for i in range(700)]
    expected = sum(-(-(len(b) // 2 + 1) // A.SCORED) for _, out, b, _ in texts if not out)
    layout = A.layout_of(np.arange(300.0), np.zeros(300, int))
    seen = []
    summed = L.summed
    monkeypatch.setattr(L, "summed", lambda *args: seen.append(summed(*args)) or seen[-1])
    for parts, run in ((1, 1 << 20), (5, 500)):
        monkeypatch.setattr(L, "RUN", run)
        seen.clear()
        with L.Stages() as stages:
            p = L.train_head(stages, spark.createDataFrame(texts, schema).repartition(parts), layout, A.Priors.of(np.ones((A.CLASSES, A.CLASSES))))
        assert sum(n for n, _ in seen) == expected and len(seen) == L.ROUNDS
        assert all(np.isfinite(x).all() for x in p.values()) and np.abs(p["group"]).max() > 0


def test_sums_are_added_in_a_tree(spark):
    rows = [(i, 1, np.array([i, 2.0]).tobytes()) for i in range(40)]
    with L.Stages() as stages:
        n, total = L.summed(stages, spark.createDataFrame(rows, "part bigint, n bigint, total binary"), 3)
    assert n == 40 and total.tolist() == [780.0, 80.0]


def test_words_are_encoded_once_and_in_order():
    import pyarrow as pa

    tokenizer, starts = L.encoder(RANKS, L.PATTERN), L.starts_word(RANKS, L.PATTERN)
    texts = ["the cat\tsat the  Cat don't", "", None, "x" * 3000 + " é\u00a0b \u0085 the", "a\u2003 b"]
    for w in L.split_words(pa.array(texts), lower=True):
        _, places, number = np.unique(w.hashes(), return_index=True, return_inverse=True)
        ids, n = L.subwords_of(w, places, number, tokenizer, starts)
        cut = np.cumsum(np.append(0, n))
        for i, text in enumerate(texts):
            expected = [t for word in words(text) for t in tokenizer.encode_ordinary(" " + word)]
            assert ids[cut[i] : cut[i + 1]].tolist() == expected


def test_classes_come_from_all_training_documents(spark):
    rows = spark.createDataFrame([(1, False, np.array([5, 5, 7], np.uint16).tobytes()), (2, True, np.array([9], np.uint16).tobytes())], "doc_id bigint, held_out boolean, ids binary")
    counts = L.count_alone(rows.union(rows), 10)
    assert counts.tolist() == [0, 0, 0, 0, 0, 4, 0, 2, 0, 0]


def fitted(ids, length, size, steps):
    counts = np.bincount(ids, minlength=size).astype(float)
    layout = A.layout_of(counts, np.arange(size) % 2)
    after = np.zeros((A.CLASSES, size + 1), np.float32)
    ends = np.cumsum(length)
    np.add.at(after, (layout.classes[np.insert(ids, ends - length, size)], np.insert(ids, ends, size)), 1)
    pairs = A.class_pairs(after, layout.classes)
    priors = A.Priors.of(pairs)
    adam = A.Adam(A.initial(layout.n_rows))
    w, goal, _ = A.windows_of(ids, length, layout)
    while adam.steps < steps:
        A.train_on(adam, priors, layout, w, goal)
    return A.Attention(layout, adam.p, priors, A.log_shares(layout.classes, counts), after, pairs)


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    size = 5000
    length = rng.integers(0, 200, 60)
    ids = np.minimum(rng.zipf(1.2, length.sum()), size) - 1
    return fitted(ids, length, size, 60)


def slow_score(model, ids):
    """One position at a time, each with the context that its window gives it."""
    p, layout = model.p, model.layout
    end = len(layout.classes) - 1
    before, after = [end, *ids], [*ids, end]
    total = 0.0
    for at in range(len(after)):
        first = max(0, at // A.SCORED * A.SCORED - A.CONTEXT)
        e = p["e"][layout.rows[before[first : at + 1]]]
        s = (e @ p["k"]) @ (e[-1] @ p["q"]) / math.sqrt(A.WIDTH) + p["r"][len(e) - 1 - np.arange(len(e))]
        a = np.exp(s - s.max())
        o = (a / a.sum()) @ (e @ p["v"])
        last, goal = layout.row_class[layout.rows[before[at]]], layout.classes[after[at]]
        g, m = divmod(goal, A.MEMBERS)
        for z, wanted in ((model.priors.group[last] + o @ p["group"], g), (model.priors.member[last * A.GROUPS + g] + o @ p["member"][g], m)):
            total += z[wanted] - math.log(np.exp(z.astype(float)).sum())
        mine = layout.classes == goal
        if mine.sum() > 1:
            share = A.SHARE_WEIGHT * math.exp(model.share[after[at]])
            total += math.log((model.after[last, after[at]] + share) / (model.after[last, mine].sum() + A.SHARE_WEIGHT))
    return total


def test_windows_score_each_token_once(model):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 5000, n) for n in (0, 1, 31, 32, 33, 100, 200)]
    got = model.score(np.concatenate(texts), np.array([len(t) for t in texts]))
    for value, text in zip(got, texts, strict=True):
        assert abs(value - slow_score(model, text.tolist())) < 1e-2 * max(1, len(text) / 30)
    assert model.score(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def test_probabilities_sum_to_one(model):
    """Over all subwords that may come next."""
    size = len(model.layout.classes) - 1
    start = np.array([3, 1, 2])
    texts = [np.append(start, t) for t in range(size)]
    scores = model.score(np.concatenate(texts), np.full(size, 4))
    # A text goes on after its last subword; what is wanted is the score up to it.
    beyond = np.array([model.score(np.append(start, t), np.array([4]))[0] for t in (0, 1, 50)])
    assert np.allclose(beyond, scores[[0, 1, 50]], atol=1e-3)
    windows, goals, _ = A.windows_of(np.concatenate(texts), np.full(size, 4), model.layout)
    classes = np.where(goals >= 0, model.layout.classes[np.maximum(goals, 0)], -1)
    found = A.Forward(model.p, model.tables, model.priors, model.layout.row_class, windows, classes).log_probability().reshape(goals.shape)[:, 3]
    last = model.layout.row_class[model.layout.rows[start[-1]]]
    share = model.within(np.full(size, last), np.arange(size))
    assert 0.9 < np.exp(found + share).sum() < 1 + 1e-3


def test_gradients_equal_differences():
    rng = np.random.default_rng(4)
    ids, length = rng.integers(0, 40, 150), np.array([100, 0, 50])
    layout = A.layout_of(np.arange(40.0), np.zeros(40, int))
    priors = A.Priors.of(rng.integers(0, 9, (A.CLASSES, A.CLASSES)).astype(float))
    w, goal, _ = A.windows_of(ids, length, layout)
    goal = np.where(goal >= 0, layout.classes[np.maximum(goal, 0)], -1)
    p = A.initial(layout.n_rows)
    p["group"] += rng.standard_normal(p["group"].shape).astype(np.float32) * 0.3
    p["member"] += rng.standard_normal(p["member"].shape).astype(np.float32) * 0.3
    g = A.gradients(p, priors, layout.row_class, w, goal)

    def loss():
        return -A.Forward(p, A.tables_of(p), priors, layout.row_class, w, goal).log_probability().sum() / (goal >= 0).sum()

    for name, at in [("q", (1, 2)), ("k", (3, 0)), ("v", (2, 5)), ("group", (4, 1)), ("member", (int(goal[0, 0]) // 16, 3, 2)), ("r", (2,)), ("e", (int(w[0, -1]), 3))]:
        kept, step = p[name][at], np.float32(0.02)
        p[name][at] = kept + step
        up = loss()
        p[name][at] = kept - step
        down = loss()
        p[name][at] = kept
        assert abs((up - down) / (2 * step) - g[name][at]) < 2e-3 + 0.05 * abs(g[name][at]), name


def test_training_lowers_the_loss():
    """A pattern that looks further back than one class: every token repeats the one two places before."""
    rng = np.random.default_rng(2)
    seq = np.zeros(6000, int)
    seq[:2] = 1, 2
    for i in range(2, len(seq)):
        seq[i] = seq[i - 2] if rng.random() < 0.9 else rng.integers(1, 9)
    trained = fitted(seq, np.array([6000]), 300, 400)
    plain = A.Attention(trained.layout, A.initial(trained.layout.n_rows), trained.priors, trained.share, trained.after, trained.totals)
    assert trained.score(seq[:2000], np.array([2000]))[0] > plain.score(seq[:2000], np.array([2000]))[0] + 100


def test_held_out_documents_are_scored_better_than_by_counts_alone(spark):
    """On real tables, after training in Spark."""
    docs = L.with_held_out(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 2500"))
    with L.Stages() as stages:
        rows = stages.write(L.encoded(docs, L.count_training_words(stages, docs, 4), RANKS, L.PATTERN), "rows")
        trained = L.fit_attention(stages, rows, RANKS, L.PATTERN)
        ids = [np.frombuffer(r.ids, np.uint16).astype(np.int64) for r in rows.where("held_out").select("ids").collect()]
    plain = A.Attention(trained.layout, A.initial(trained.layout.n_rows), trained.priors, trained.share, trained.after, trained.totals)
    flat, length = np.concatenate(ids), np.array([len(i) for i in ids])
    per_subword = [m.score(flat, length).sum() / len(flat) for m in (trained, plain)]
    assert per_subword[0] > per_subword[1] + 0.15, per_subword
