from __future__ import annotations

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairforge import fixed_values as V
from pairforge.operators import replies as R, scoring as S, training as T

FENCE = "```"


def entries(value):
    return None if value is None else [(e.table_name, e.columns) for e in value]


def parse(one, reply):
    out = one(R.parse_table_lines(F.col("r")), r=reply)
    return entries(out.entries), out.error


@pytest.mark.parametrize("reply,expected", [
    ("a(b, c)", [("a", ["b", "c"])]),
    (f"{FENCE}\na(b),\n`c(d)`\n{FENCE}", [("a", ["b"]), ("c", ["d"])]),
    ("  a (b,,c);. \r\n\n x()", [("a", ["b", "c"]), ("x", [])]),
    ("a(b, b)", [("a", ["b", "b"])]),
    ("é_1(ü)", [("é_1", ["ü"])]),
])
def test_table_lines(one, reply, expected):
    assert parse(one, reply) == (expected, None)


@pytest.mark.parametrize("reply,error", [
    ("a(b)\nsure: c(d)", "unparseable line: 'sure: c(d)'"),
    ("a(b)`,", "unparseable line: 'a(b)`'"),
    ("a(b(c))", "unparseable line: 'a(b(c))'"),
    ("my table(b)", "unparseable line: 'my table(b)'"),
    ("  \n", "no table selections found in output"),
    (f"{FENCE}\n{FENCE}", "no table selections found in output"),
])
def test_bad_table_lines(one, reply, error):
    assert parse(one, reply) == (None, error)


def test_merge_keeps_first_position(one):
    merged = R.merge_duplicate_tables(R.parse_table_lines(F.col("r"))["entries"])
    assert entries(one(merged, r="a(x, x)\nb(y)\na(z, x, z)\na(w)")) == [
        ("a", ["x", "x", "z", "w"]), ("b", ["y"])
    ]


@pytest.mark.parametrize("reply,sql", [
    (" select 1; drop", "select 1"),
    (f"text {FENCE}SQL\nSELECT 2;\n{FENCE} SELECT 3", "SELECT 2"),
    ("selected WITH care", "WITH care"),
    ("SELECT ';' x", "SELECT '"),
    ("ok\nDELETE FROM t\nWHERE 1", "DELETE FROM t\nWHERE 1"),
])
def test_extract_sql(one, reply, sql):
    out = one(R.extract_sql(F.col("r")), r=reply)
    assert (out.sql, out.error) == (sql, None)


def test_extract_sql_error(one):
    out = one(R.extract_sql(F.col("r")), r="selection " + "x" * 100)
    assert out.sql is None and out.error == f"no SQL statement found in output: '{('selection ' + 'x' * 100)[:80]}'"


def present(one, reply):
    return one(R.parse_presentation(F.col("r"), F.col("cols")), r=reply, cols=["a", "b"])


def test_presentation_accepts(one):
    out = present(one, '{"chart": {"type": "bar", "x": "a", "y": ["b"], "series": null}, "answer": " hi "}')
    assert out.error is None and out.answer == " hi " and (out.chart.type, out.chart.y) == ("bar", ["b"])
    out = present(one, f'so: {FENCE}json\n{{"chart": null, "answer": "x", "more": 1}}{FENCE}')
    assert (out.error, out.answer, out.chart) == (None, "x", None)
    out = present(one, '{"chart": {"type": "pie", "x": "a", "y": ["b"]}, "answer": "x"}')
    assert out.error is None and out.chart.series is None


@pytest.mark.parametrize("reply,error", [
    ("none", "no JSON object found in output: 'none'"),
    ("{oops}", "invalid JSON"),
    ('{"answer": "x"}', "output does not match schema"),
    ('{"chart": null, "answer": 5}', "output does not match schema"),
    ('{"chart": {"type": "bar", "x": 1, "y": ["b"]}, "answer": "x"}', "output does not match schema"),
    ('{"chart": {"type": "bar", "x": "a", "y": ["b", null]}, "answer": "x"}', "output does not match schema"),
    ('{"chart": {"type": "bar", "x": "a", "y": "b"}, "answer": "x"}', "output does not match schema"),
    ('{"chart": {"type": "hot", "x": "a", "y": ["b"]}, "answer": "  "}', "answer is empty"),
    ('{"chart": {"type": "bar", "x": "a", "y": []}, "answer": "x"}', "chart.y must list at least one column"),
    ('{"chart": {"type": "bar", "x": "a", "y": ["b", "q"], "series": "z"}, "answer": "x"}',
     "chart references unknown column(s): ['q', 'z']"),
])
def test_presentation_rejects(one, reply, error):
    assert present(one, reply).error == error


def test_presentation_fallback(one):
    parsed = R.parse_presentation(F.col("r"), F.col("cols"))
    out = one(R.presentation_fallback(F.col("r"), parsed), r="just text", cols=["a"])
    assert (out.answer, out.chart) == ("just text", None)


def test_preview(spark):
    rows = spark.range(1, 26).select(
        F.lit("g").alias("g"), "id", F.lit("x" * 41).alias("long"), F.lit(" a\nb ").alias("nl"),
        F.lit(None).cast("string").alias("none"), F.lit(True).alias("flag"),
    )
    out = R.result_preview(rows, ["g"], ["id"], ["id", "long", "nl", "none", "flag"], max_cols=4).first()
    lines = out.preview.split("\n")
    assert out.n_rows == 25
    assert lines[:3] == [
        "id | long | nl | none", "--- | --- | --- | ---", f"1 | {'x' * 37}... | a b | "
    ]
    assert lines[22:] == ["... (1 more column(s) omitted)", "... (5 more row(s) omitted)"]


def scores(spark, pairs):
    rows = spark.createDataFrame(pairs, "id int, gold string, pred string")
    parsed = rows.withColumns(
        {"g": R.parse_table_lines(F.col("gold")), "p": R.parse_table_lines(F.col("pred"))}
    )
    return S.set_scores(
        parsed, F.col("g.entries"), F.col("p.entries"), F.col("p.error").isNull()
    )


def test_scores(spark):
    scored = scores(spark, [
        (1, "a(x, y)\nb(z)", "A(X, y)\nB(z)"), (2, "a(x)", "a(y)\nb(q)"), (3, "a(x)", "oops"),
        (4, "a()", "a()"), (5, "a(x)", "a()"),
    ])
    got = {r.id: r for r in scored.collect()}
    assert got[1].exact_match and got[1].column_f1 == 1.0
    assert (got[2].table_precision, got[2].table_recall, got[2].column_f1) == (0.5, 1.0, 0.0)
    assert got[3].table_f1 is None and not got[3].parsed_ok
    assert (got[4].column_precision, got[4].column_recall, got[4].column_f1) == (1.0, 1.0, 1.0)
    assert (got[5].column_precision, got[5].column_recall, got[5].exact_match) == (0.0, 0.0, False)
    total = S.score_summary(scored).first()
    assert (total.n_examples, total.unparseable_rate, total.exact_match) == (5, 0.2, 0.4)
    assert total.table_precision == pytest.approx((1 + 0.5 + 1 + 1) / 5)
    assert S.score_summary(scored, ["id"]).count() == 6
    with pytest.raises(PySparkException, match="no examples to aggregate"):
        S.score_summary(scored.where("false")).collect()


def test_gold_against_itself(spark):
    scored = scores(spark, [(1, "a(x, y)\nb(z)", "a(x, y)\nb(z)")]).first()
    assert all(scored[m] == 1.0 for m in S.METRICS) and scored.exact_match


def test_prompt_hashes(spark):
    for texts in V.PROMPTS.values():
        got = spark.range(1).select(T.prompt_fingerprint(*[F.lit(t) for t in texts])).first()[0]
        assert got == hashlib.sha256("\n".join(texts).encode()).hexdigest()[:16]


def test_messages(one):
    out = one(T.pruner_messages(F.col("q"), F.col("s"), F.lit("t(a)")), q="{schema}?", s="{question}")
    assert [m.role for m in out] == ["system", "user", "assistant"]
    assert out[1].content == "Database schema:\n{question}\n\nQuestion: {schema}?"
    history = F.array(
        F.struct(F.lit("q1").alias("question"), F.lit("s1").alias("sql")),
        F.struct(F.lit("q2").alias("question"), F.lit(None).cast("string").alias("sql")),
    )
    out = one(T.generator_messages(F.col("q"), F.col("s"), history=history,
                                   prev_sql=F.col("p"), error=F.lit(None).cast("string")), q="q", s="s", p="x")
    assert [(m.role, m.content) for m in out[1:4]] == [("user", "q1"), ("assistant", "s1"), ("user", "q2")]
    assert "Previous SQL" not in out[4].content
    out = one(T.generator_messages(F.col("q"), F.col("s"), prev_sql=F.lit("P"), error=F.lit("E")), q="q", s="s")
    assert out[1].content.endswith("Previous SQL:\nP\n\nDatabase error:\nE")


def test_overlength(spark):
    rows = spark.createDataFrame([("a b c",), ("a, b.",)], "text string")
    kept, report = T.overlength_drop(rows, T.token_count(F.col("text")), 3)
    assert [r.text for r in kept.collect()] == ["a b c"]
    assert tuple(report.first()) == (2, 1)


def test_target_text(one):
    text = T.target_text(F.col("t"), F.col("c"))
    assert one(text, t=["b", "a"], c={"b": ["x", "y"]}) == "b(x, y)\na()"


def test_batches(spark):
    rows = spark.range(0, 1000).select(
        F.when(F.col("id") < 900, "hot").alias("k"), (F.col("id") * 7).alias("ord")
    )
    got = S.eval_batches(rows, ["k"], "ord", 64).collect()
    for key in ("hot", None):
        ordered = sorted((r for r in got if r.k == key), key=lambda r: r.ord)
        assert [r.position for r in ordered] == list(range(len(ordered)))
        assert all(r.batch == r.position // 64 for r in ordered)
    assert len(got) == 1000


def test_preview_of_an_empty_result(spark):
    rows = spark.createDataFrame([("a", 1, "x")], "k string, o int, v string")
    results = spark.createDataFrame([("a",), ("none",), (None,)], "k string")
    got = {r.k: (r.n_rows, r.preview) for r in R.result_preview(rows, ["k"], ["o"], ["o", "v"], results=results).collect()}
    assert got == {"a": (1, "o | v\n--- | ---\n1 | x"), "none": (0, "o | v\n--- | ---"), None: (0, "o | v\n--- | ---")}


def test_last_of_repeated_keys(one):
    reply = '{"answer": "a", "chart": null, "answer": "b"}'
    assert one(R.json_object_extract(F.col("r")), r=reply).error is None
    assert one(R.parse_presentation(F.col("r"), F.array().cast("array<string>")), r=reply).answer == "b"


def test_scores_of_two_tables(spark):
    entry = "array<struct<table_name:string,columns:array<string>>>"
    gold = spark.createDataFrame(
        [(1, [("A", ["x", "Y"])]), (2, [("a", ["x"])]), (3, []), (5, None), (6, [("a", ["x"])]), (6, [("b", [])]), (None, [("a", [])])], f"id int, entries {entry}"
    )
    replies = spark.createDataFrame(
        [(1, [("a", ["y", "x", "X"])], True), (3, [], True), (4, [("a", ["x"])], True), (5, None, False), (6, [("b", []), ("a", ["z"])], True), (None, [("A", [])], True)],
        f"id int, entries {entry}, parsed boolean",
    )
    got = {r["id"]: r for r in S.set_scores_of_tables(gold, replies).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, None}
    assert got[1].exact_match and got[1].column_f1 == 1 and got[None].exact_match
    assert (got[2].parsed_ok, got[2].in_replies, got[2].table_f1) == (False, False, None)
    assert got[3].exact_match and got[3].table_precision == 1
    assert (got[4].in_gold, got[4].table_precision, got[4].table_recall, got[4].exact_match) == (False, 0, 1, False)
    assert got[5].exact_match is None and not got[5].parsed_ok and got[5].in_replies
    assert (got[6].table_recall, got[6].column_precision, got[6].column_recall) == (1, 0, 0)
    paired = gold.where("id < 2").join(replies.withColumnRenamed("entries", "pred"), "id")
    row = S.set_scores(paired, F.col("entries"), F.col("pred"), F.col("parsed")).first()
    assert [row[m] for m in S.METRICS] == [got[1][m] for m in S.METRICS]
