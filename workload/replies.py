"""Queries over model replies and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairforge.operators import replies as R, scoring as S, training as T
from pairforge.operators.attempts import history_window
from workload.inputs import table
from workload.registry import query


def entries_text(entries: Column) -> Column:
    lines = F.transform(
        entries,
        lambda e: F.concat(e["table_name"], F.lit("("), F.array_join(e["columns"], ", "), F.lit(")")),
    )
    return F.array_join(lines, "\n")


# Entries of readable replies, read line by line; equal tables are merged, first places win.
REPLY_LINES = """SELECT row_ord, line_ord, trim(split_part(line, '(', 1)) AS table_name, trim(c) AS column_name, column_ord FROM (
  SELECT row_ord, line_ord, line, unnest(cols) AS c, generate_subscripts(cols, 1) AS column_ord FROM (
   SELECT row_ord, line_ord, line, string_split(rtrim(split_part(line, '(', 2), '),'), ',') AS cols FROM (
    SELECT row_ord, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_ord FROM (
     SELECT row_ord, string_split(trim(replace(reply, '```', ''), chr(10)), chr(10)) AS lines FROM completions WHERE variant <> 4) a) b) d) e"""
REPLY_COLUMNS = """SELECT row_ord, table_name, column_name, min(line_ord * 1000 + column_ord) AS place FROM reply_lines GROUP BY row_ord, table_name, column_name"""
MERGED_TABLES = """SELECT row_ord, table_name, min(place) AS place, string_agg(column_name, ', ' ORDER BY place) AS columns FROM reply_columns GROUP BY row_ord, table_name"""
MERGED_ENTRIES = """SELECT row_ord, string_agg(concat(table_name, '(', columns, ')'), chr(10) ORDER BY place) AS entries FROM merged_tables GROUP BY row_ord"""
MERGED = dict(reply_lines=REPLY_LINES, reply_columns=REPLY_COLUMNS, merged_tables=MERGED_TABLES, merged=MERGED_ENTRIES)


def parsed_completions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "completions").withColumn("parsed", R.parse_table_lines(F.col("reply")))


def pruner_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Completions with merged predictions and gold entries."""
    gold = R.merge_duplicate_tables(R.parse_table_lines(F.col("gold"))["entries"])
    return parsed_completions(spark, sf).withColumns(
        {"pred": R.merge_duplicate_tables(F.col("parsed.entries")), "gold_entries": gold}
    )


@query(
    "parse_table_lines",
    """SELECT row_ord, CASE variant WHEN 4 THEN NULL WHEN 3 THEN concat(gold, chr(10), 'extra_table(extra_col)') WHEN 5 THEN upper(gold)
     WHEN 6 THEN concat('customer(c_name)', chr(10), gold, chr(10), 'customer(c_nationkey, c_name)') ELSE gold END AS entries,
     CASE variant WHEN 4 THEN concat('unparseable line: ''I think: ', string_split(gold, chr(10))[1], '''') END AS error
    FROM completions""",
)
def parse_table_lines(spark, sf):
    return parsed_completions(spark, sf).select(
        "row_ord", entries_text(F.col("parsed.entries")).alias("entries"), "parsed.error"
    )


@query(
    "merge_duplicate_tables",
    "SELECT row_ord, entries FROM merged",
    **MERGED,
)
def merge_duplicate_tables(spark, sf):
    rows = pruner_schema(spark, sf).where("parsed.error IS NULL")
    return rows.select("row_ord", entries_text(F.col("pred")).alias("entries"))


@query(
    "extract_sql",
    """SELECT row_ord, CASE WHEN variant = 4 OR (k = 13 AND variant < 3) THEN NULL WHEN variant = 3 THEN concat('With pleasure: ', trim(query)) ELSE trim(query) END AS sql,
     CASE WHEN variant = 4 THEN 'no SQL statement found in output: ''no idea'''
      WHEN k = 13 AND variant < 3 THEN concat('no SQL statement found in output: ''',
       substr(CASE variant WHEN 0 THEN query WHEN 1 THEN concat(query, ';') ELSE reply END, 1, 80), '''') END AS error FROM sql_replies""",
)
def extract_sql(spark, sf):
    return table(spark, sf, "sql_replies").select(
        "row_ord", F.inline(F.array(R.extract_sql(F.col("reply"))))
    )


OBJECT_ERROR = """CASE variant WHEN 6 THEN 'invalid JSON' WHEN 7 THEN 'no JSON object found in output: ''sorry''' END"""
CHART_ERROR = """CASE variant WHEN 2 THEN 'unknown chart type ''radar''; allowed: bar, line, pie, scatter, area, histogram'
 WHEN 3 THEN 'chart.y must list at least one column' WHEN 4 THEN 'chart references unknown column(s): [''nope'']'
 WHEN 5 THEN 'answer is empty' END"""
ANSWER = "CASE p.variant WHEN 0 THEN concat('part ', t.p_name) WHEN 1 THEN t.p_type END"


@query(
    "json_object_extract",
    f"""SELECT id, CASE WHEN variant IN (6, 7) THEN NULL WHEN variant = 1 THEN string_split(reply, chr(10))[2] ELSE reply END AS body,
    {OBJECT_ERROR} AS error FROM presentations""",
)
def json_object_extract(spark, sf):
    return table(spark, sf, "presentations").select(
        "id", F.inline(F.array(R.json_object_extract(F.col("reply"))))
    )


def presented(spark: SparkSession, sf: str) -> DataFrame:
    parsed = R.parse_presentation(F.col("reply"), F.split("cols", ","))
    return table(spark, sf, "presentations").withColumn("p", parsed)


@query(
    "chart_validation",
    f"""SELECT p.id AS id, {ANSWER} AS answer, CASE variant WHEN 0 THEN 'bar' END AS chart_type,
    CASE variant WHEN 0 THEN 'p_brand' END AS x, CASE variant WHEN 0 THEN 'total' END AS y,
    coalesce({OBJECT_ERROR}, {CHART_ERROR}) AS error FROM presentations p JOIN part t ON p.id = t.p_partkey""",
)
def chart_validation(spark, sf):
    return presented(spark, sf).select(
        "id", "p.answer", F.col("p.chart.type").alias("chart_type"), F.col("p.chart.x").alias("x"),
        F.array_join("p.chart.y", ",").alias("y"), "p.error",
    )


@query(
    "presentation_fallback",
    f"""SELECT p.id AS id, coalesce({ANSWER}, p.reply) AS answer, CASE variant WHEN 0 THEN 'bar' END AS chart_type
    FROM presentations p JOIN part t ON p.id = t.p_partkey""",
)
def presentation_fallback(spark, sf):
    shown = presented(spark, sf).withColumn(
        "s", R.presentation_fallback(F.col("reply"), F.col("p"))
    )
    return shown.select("id", "s.answer", F.col("s.chart.type").alias("chart_type"))


def nation_previews(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").withColumn(
        "note", F.concat("c_name", F.lit(" of the segment\n"), "c_mktsegment")
    )
    # Every nation has a result, and as many more have asked for customers that they do not have.
    nations = table(spark, sf, "nation").select(F.explode(F.array(F.col("n_nationkey"), F.col("n_nationkey") + 100)).alias("c_nationkey"))
    return R.result_preview(
        rows, ["c_nationkey"], ["c_custkey"], ["c_custkey", "c_mktsegment", "note", "c_name"], max_cols=3, results=nations
    )


PREVIEWS = """SELECT r.c_nationkey AS c_nationkey, coalesce(n, 0) AS n_rows, concat('c_custkey | c_mktsegment | note', chr(10), '--- | --- | ---', chr(10),
  coalesce(lines, ''), '... (1 more column(s) omitted)', CASE WHEN n > 20 THEN concat(chr(10), '... (', n - 20, ' more row(s) omitted)') ELSE '' END) AS preview
 FROM (SELECT n_nationkey AS c_nationkey FROM nation UNION ALL SELECT n_nationkey + 100 FROM nation) r LEFT JOIN (SELECT c_nationkey, count(*) AS n,
  string_agg(concat(c_custkey, ' | ', c_mktsegment, ' | ', CASE WHEN length(note) <= 40 THEN note ELSE concat(substr(note, 1, 37), '...') END, chr(10)),
   '' ORDER BY c_custkey) FILTER (WHERE rn <= 20) AS lines
 FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn,
  concat(c_name, ' of the segment ', c_mktsegment) AS note FROM customer) c GROUP BY c_nationkey) s ON r.c_nationkey = s.c_nationkey"""


@query("result_preview", "SELECT * FROM previews", previews=PREVIEWS)
def result_preview(spark, sf):
    return nation_previews(spark, sf)


@query(
    "presenter_messages",
    """SELECT c_nationkey, 'system,user' AS roles, concat('Question: customers of nation ', c_nationkey, chr(10), chr(10),
    'Result preview (', n_rows, ' row(s)):', chr(10), preview) AS user_text FROM previews""",
    previews=PREVIEWS,
)
def presenter_messages(spark, sf):
    question = F.concat(F.lit("customers of nation "), F.col("c_nationkey").cast("string"))
    messages = T.presenter_messages(question, F.col("n_rows"), F.col("preview"))
    rows = nation_previews(spark, sf).withColumn("messages", messages)
    return rows.select(
        "c_nationkey", F.array_join("messages.role", ",").alias("roles"),
        F.get("messages.content", F.lit(1)).alias("user_text"),
    )


@query(
    "generator_messages",
    """SELECT conv_id, turn, concat(coalesce(string_agg(concat(CASE role WHEN 'user' THEN 'user:' ELSE 'assistant:' END, text), chr(10) ORDER BY turn)
      OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), ''), '|user:Database schema:', chr(10), 't(a)',
     chr(10), chr(10), 'Question: ', text, CASE WHEN turn % 2 = 1 THEN concat(chr(10), chr(10), 'Your previous SQL query failed and must be corrected.',
      chr(10), 'Previous SQL:', chr(10), 'SELECT ', turn, chr(10), chr(10), 'Database error:', chr(10), 'bad') ELSE '' END) AS messages
    FROM conversations""",
)
def generator_messages(spark, sf):
    is_user = F.col("role") == "user"
    turn = F.struct(
        F.when(is_user, F.col("text")).alias("question"), F.when(~is_user, F.col("text")).alias("sql")
    )
    rows = history_window(table(spark, sf, "conversations"), ["conv_id"], "turn", turn)
    retry = F.col("turn") % 2 == 1
    messages = T.generator_messages(
        F.col("text"), F.lit("t(a)"),
        prev_sql=F.when(retry, F.concat(F.lit("SELECT "), F.col("turn").cast("string"))),
        error=F.when(retry, F.lit("bad")),
        history=F.col("history"),
    )
    shown = F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    rows = rows.withColumn("m", shown)
    return rows.select(
        "conv_id", "turn",
        F.concat(
            F.array_join(F.slice("m", F.lit(2), F.size("m") - 2), "\n"), F.lit("|"),
            F.element_at("m", -1),
        ).alias("messages"),
    )


# ---- scoring

@query(
    "qualified_columns",
    """SELECT DISTINCT row_ord, lower(concat(split_part(line, '(', 1), '.', trim(c))) AS item FROM (
      SELECT row_ord, line, unnest(string_split(rtrim(split_part(line, '(', 2), ')'), ',')) AS c FROM (
        SELECT row_ord, unnest(string_split(gold, chr(10))) AS line FROM completions) l) m""",
)
def qualified_columns(spark, sf):
    return pruner_schema(spark, sf).select(
        "row_ord", F.explode(S.qualified_columns(F.col("gold_entries"))).alias("item")
    )


# Sets of lower-case names on both sides, counted.
GOLD_NAMES = """SELECT DISTINCT row_ord, lower(split_part(line, '(', 1)) AS table_name, lower(trim(c)) AS column_name FROM (
  SELECT row_ord, line, unnest(string_split(rtrim(split_part(line, '(', 2), ')'), ',')) AS c FROM (
   SELECT row_ord, unnest(string_split(gold, chr(10))) AS line FROM completions) a) b"""
PRED_NAMES = "SELECT DISTINCT row_ord, lower(table_name) AS table_name, lower(column_name) AS column_name FROM reply_lines"
SIZES = """SELECT c.row_ord AS row_ord, c.k AS k, c.variant AS variant, nt, nc, pt, pc, ct, cc FROM completions c
 JOIN (SELECT row_ord, count(DISTINCT table_name) AS nt, count(*) AS nc FROM gold_names GROUP BY row_ord) g ON c.row_ord = g.row_ord
 LEFT JOIN (SELECT row_ord, count(DISTINCT table_name) AS pt, count(*) AS pc FROM pred_names GROUP BY row_ord) p ON c.row_ord = p.row_ord
 LEFT JOIN (SELECT row_ord, count(DISTINCT table_name) AS ct, count(*) AS cc FROM pred_names SEMI JOIN gold_names USING (row_ord, table_name, column_name) GROUP BY row_ord) o ON c.row_ord = o.row_ord"""
COUNTED_NAMES = dict(reply_lines=REPLY_LINES, gold_names=GOLD_NAMES, pred_names=PRED_NAMES, sizes=SIZES)
SCORES = """SELECT *, CASE WHEN ok THEN ct / pt END AS table_precision, CASE WHEN ok THEN ct / nt END AS table_recall,
 CASE WHEN ok THEN 2 * ct / (nt + pt) END AS table_f1, CASE WHEN ok THEN cc / pc END AS column_precision,
 CASE WHEN ok THEN cc / nc END AS column_recall, CASE WHEN ok THEN 2 * cc / (nc + pc) END AS column_f1,
 CASE WHEN ok THEN nt = pt AND nc = pc AND ct = nt AND cc = nc END AS exact_match FROM (SELECT *, variant <> 4 AS ok FROM sizes) z"""
ROUNDED = ", ".join(f"round(cast({m} AS DOUBLE), 6) AS {m}" for m in S.METRICS)
MEANS = ", ".join(
    f"round(sum(coalesce(cast({m} AS DOUBLE), 0)) / count(*), 6) AS {m}" for m in S.METRICS
)
SUMMARY = f"""{MEANS}, round(sum(CASE WHEN exact_match THEN 1 ELSE 0 END) / count(*), 6) AS exact_match,
 round(sum(CASE WHEN ok THEN 0 ELSE 1 END) / count(*), 6) AS unparseable_rate, count(*) AS n_examples"""


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return S.set_scores(
        pruner_schema(spark, sf), F.col("gold_entries"), F.col("pred"), F.col("parsed.error").isNull()
    )


def rounded(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in metrics]
    return df.select(*keys, *[F.round(m, 6).alias(m) for m in metrics], *rest)


@query("set_scores", f"SELECT row_ord, {ROUNDED} FROM scores", **COUNTED_NAMES, scores=SCORES)
def set_scores(spark, sf):
    return rounded(scores(spark, sf).select("row_ord", *S.METRICS), ["row_ord"], S.METRICS)


@query("exact_match", "SELECT row_ord, exact_match FROM scores", **COUNTED_NAMES, scores=SCORES)
def exact_match(spark, sf):
    return scores(spark, sf).select("row_ord", "exact_match")


# A seventh of the gold rows has a key that no reply has, so their replies have no gold.
BY_TABLE = f"""SELECT row_ord AS id, {ROUNDED}, exact_match, ok AS parsed_ok, true AS in_gold, true AS in_replies FROM scores WHERE row_ord % 7 <> 0
 UNION ALL SELECT -1 - row_ord, NULL, NULL, NULL, NULL, NULL, NULL, NULL, false, true, false FROM scores WHERE row_ord % 7 = 0
 UNION ALL SELECT row_ord, CASE WHEN ok THEN cast(pt = 0 AS INTEGER) END, CASE WHEN ok THEN 1 END, CASE WHEN ok THEN cast(pt = 0 AS INTEGER) END,
  CASE WHEN ok THEN cast(pc = 0 AS INTEGER) END, CASE WHEN ok THEN 1 END, CASE WHEN ok THEN cast(pc = 0 AS INTEGER) END,
  CASE WHEN ok THEN pt = 0 AND pc = 0 END, ok, false, true FROM scores WHERE row_ord % 7 = 0"""


@query("set_scores_of_tables", BY_TABLE, **COUNTED_NAMES, scores=SCORES)
def set_scores_of_tables(spark, sf):
    rows = pruner_schema(spark, sf)
    gold_key = F.when(F.col("row_ord") % 7 == 0, -1 - F.col("row_ord")).otherwise(F.col("row_ord"))
    gold = rows.select(gold_key.alias("id"), F.col("gold_entries").alias("entries"))
    replies = rows.select(F.col("row_ord").alias("id"), F.col("pred").alias("entries"), F.col("parsed.error").isNull().alias("parsed"))
    return rounded(S.set_scores_of_tables(gold, replies), ["id"], S.METRICS)


@query("score_summary", f"SELECT {SUMMARY} FROM scores", **COUNTED_NAMES, scores=SCORES)
def score_summary(spark, sf):
    return rounded(
        S.score_summary(scores(spark, sf)), [], [*S.METRICS, "exact_match", "unparseable_rate"]
    )


@query(
    "score_summary_by_template",
    f"SELECT k, {SUMMARY} FROM scores GROUP BY ROLLUP (k)",
    **COUNTED_NAMES, scores=SCORES,
)
def score_summary_by_template(spark, sf):
    summary = S.score_summary(scores(spark, sf), ["k"])
    return rounded(summary, ["k"], [*S.METRICS, "exact_match", "unparseable_rate"])


@query(
    "eval_samples",
    """SELECT row_ord, gold, reply, CASE variant WHEN 4 THEN concat('unparseable line: ''I think: ', string_split(gold, chr(10))[1], '''') END AS parse_error
    FROM completions ORDER BY row_ord LIMIT 50""",
)
def eval_samples(spark, sf):
    rows = parsed_completions(spark, sf).select(
        "row_ord", "gold", "reply", F.col("parsed.error").alias("parse_error")
    )
    return S.eval_samples(rows, ["row_ord"])


@query(
    "eval_batches",
    """SELECT row_ord, split, (row_number() OVER (PARTITION BY split ORDER BY row_ord) - 1) // 16 AS batch FROM completions""",
)
def eval_batches(spark, sf):
    rows = table(spark, sf, "completions").select("row_ord", "split")
    return S.eval_batches(rows, ["split"], "row_ord", 16).select("row_ord", "split", "batch")
