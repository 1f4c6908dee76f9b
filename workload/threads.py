"""Queries over attempts, history, streams and model versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairforge.functions.scratch import file_system, scratch_path, stage
from pairforge.operators import attempts as A, catalog as C, replies as R, training as T, versions as V
from pairforge.sources import json_files as J
from pairforge.plans.label_job import label_pairs, label_rows
from pairforge.streaming.feedback import run_feedback, training_corpus
from pairforge.streaming.threads import FRAME, TURN, Live, live_requests, run_live
from workload.corpus import label_catalogs, unique_pairs
from workload.inputs import table
from workload.replies import MERGED
from workload.registry import query

CLASSES = """SELECT *, CASE http_status WHEN 200 THEN 'ok' WHEN 422 THEN 'sql_error' ELSE 'fatal' END AS outcome,
 CASE http_status WHEN 200 THEN NULL WHEN 422 THEN json_extract_string(body, '$.detail') ELSE 'query failed (503): oops' END AS response_error
 FROM attempts"""
OUTCOMES = """SELECT *, CASE WHEN sql_text IS NULL THEN 'retryable' WHEN outcome = 'sql_error' THEN 'retryable' ELSE outcome END AS result,
 CASE WHEN sql_text IS NULL THEN coalesce(generator_error, 'no SQL was generated') ELSE response_error END AS error FROM classes"""
COUNTED = """SELECT *, cast(sum(CASE result WHEN 'retryable' THEN 1 ELSE 0 END) OVER
 (PARTITION BY thread_id, request_ord ORDER BY attempt_ord) AS BIGINT) AS attempts_made FROM outcomes"""
DECIDED = """SELECT *, CASE WHEN result = 'ok' THEN 'success' WHEN result = 'fatal' OR attempts_made >= 2 THEN 'failed' ELSE 'retry' END AS status FROM counted"""
STATES = """SELECT * FROM (SELECT *, coalesce(sum(CASE WHEN status <> 'retry' THEN 1 ELSE 0 END) OVER
 (PARTITION BY thread_id, request_ord ORDER BY attempt_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM decided) s WHERE ended = 0"""
HISTORY = """SELECT *, coalesce(string_agg(CASE result WHEN 'retryable' THEN concat('attempt ', attempts_made, ': ', coalesce('''' || sql_text || '''', 'None'),
  ' -> ', error) END, chr(10) ORDER BY attempt_ord) OVER (PARTITION BY thread_id, request_ord ORDER BY attempt_ord), '') AS error_history FROM states"""
CHAIN = dict(classes=CLASSES, outcomes=OUTCOMES, counted=COUNTED, decided=DECIDED, states=STATES)


@query("response_class", "SELECT event_id, outcome, response_error AS error FROM classes", classes=CLASSES)
def response_class(spark, sf):
    response = A.response_class(F.col("http_status"), F.col("body"))
    return table(spark, sf, "attempts").select("event_id", F.inline(F.array(response)))


@query(
    "attempt_outcome", "SELECT event_id, result, error FROM outcomes", classes=CLASSES, outcomes=OUTCOMES
)
def attempt_outcome(spark, sf):
    return A.with_outcome(table(spark, sf, "attempts"), "generator_error").select("event_id", "result", "error")


def states(spark: SparkSession, sf: str) -> DataFrame:
    return A.attempt_state(A.with_outcome(table(spark, sf, "attempts"), "generator_error"))


@query(
    "attempt_state",
    "SELECT thread_id, request_ord, attempt_ord, attempts_made AS attempts, status FROM states",
    **CHAIN,
)
def attempt_state(spark, sf):
    return states(spark, sf).select("thread_id", "request_ord", "attempt_ord", "attempts", "status")


@query(
    "error_history",
    "SELECT thread_id, request_ord, attempt_ord, error_history FROM histories",
    **CHAIN, histories=HISTORY,
)
def error_history(spark, sf):
    return A.error_history(states(spark, sf)).select(
        "thread_id", "request_ord", "attempt_ord", F.array_join("error_history", "\n").alias("error_history")
    )


@query(
    "route_next",
    """SELECT thread_id, request_ord, attempt_ord, CASE status WHEN 'retry' THEN 'generate_sql' WHEN 'success' THEN 'present'
    ELSE 'handle_failure' END AS next FROM states""",
    **CHAIN,
)
def route_next(spark, sf):
    return states(spark, sf).select(
        "thread_id", "request_ord", "attempt_ord", A.route_next(F.col("status")).alias("next")
    )


@query(
    "schema_context",
    """SELECT row_ord, CASE WHEN row_ord % 3 = 0 OR row_ord % 5 = 0 OR variant = 4 THEN 'full schema' ELSE entries END AS schema_text
    FROM completions LEFT JOIN merged USING (row_ord)""",
    **MERGED,
)
def schema_context(spark, sf):
    entries = R.merge_duplicate_tables(R.parse_table_lines(F.col("reply"))["entries"])
    lines = F.transform(
        entries,
        lambda e: F.concat(e["table_name"], F.lit("("), F.array_join(e["columns"], ", "), F.lit(")")),
    )
    return table(spark, sf, "completions").select(
        "row_ord",
        A.schema_context(
            F.col("row_ord") % 3 == 0, F.col("row_ord") % 5 == 0, F.array_join(lines, "\n"),
            F.lit("full schema"),
        ).alias("schema_text"),
    )


@query(
    "history_append",
    """SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM conversations""",
)
def history_append(spark, sf):
    turns = table(spark, sf, "conversations")
    return A.history_append(turns, ["conv_id"], "turn").select("conv_id", "role", "text", "position")


@query(
    "history_window",
    """SELECT thread_id, seq AS position, coalesce(string_agg(cast(event_id AS VARCHAR), ',' ORDER BY seq) OVER (PARTITION BY thread_id ORDER BY seq
     ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), '') AS history
    FROM (SELECT thread_id, event_id, row_number() OVER (PARTITION BY thread_id ORDER BY event_id) - 1 AS seq FROM attempts) a""",
)
def history_window(spark, sf):
    turns = table(spark, sf, "attempts").select("thread_id", "event_id")
    value = F.col("event_id").cast("string")
    rows = A.history_window(turns, ["thread_id"], "event_id", value, width=50)
    return rows.select("thread_id", "position", F.array_join("history", ",").alias("history"))


@query(
    "turn_record",
    """SELECT thread_id, request_ord, sql_text, CASE status WHEN 'success' THEN concat('answer ', event_id)
    ELSE 'Sorry, I am potato.' END AS answer FROM states WHERE status <> 'retry'""",
    **CHAIN,
)
def turn_record(spark, sf):
    answer = F.concat(F.lit("answer "), F.col("event_id").cast("string"))
    return A.turn_record(states(spark, sf), answer).select(
        "thread_id", "request_ord", "sql_text", "answer"
    )


FRAMES = """SELECT thread_id, request_ord, attempt_ord AS seq, CASE result WHEN 'fatal' THEN concat('data: {"error":"', error, '"}', chr(10), chr(10))
     ELSE concat('data: {"attempts":', attempts_made, ',"status":"', status, '","sql_text":', coalesce('"' || sql_text || '"', 'null'), '}', chr(10), chr(10)) END AS frame
     FROM states
    UNION ALL SELECT thread_id, request_ord, max(attempt_ord) + 1, concat('data: [DONE]', chr(10), chr(10)) FROM states GROUP BY thread_id, request_ord"""


@query("event_frames", FRAMES, **CHAIN)
def event_frames(spark, sf):
    updates = states(spark, sf).withColumn("failure", F.when(F.col("result") == "fatal", F.col("error")))
    return A.event_frames(
        updates, ["thread_id", "request_ord"], "attempt_ord", ["attempts", "status", "sql_text"]
    )


def run_stream(spark: SparkSession, sf: str, *, files_per_trigger: int | None = None, batches: int = 1) -> Live:
    """All attempts as a stream of JSON files to its end. Arrival order is not attempt order: a hash deals rows to files."""
    base = scratch_path(spark, "threads")
    columns = ["thread_id", "request_ord", "attempt_ord", "sql_text", "generator_error", "http_status", "body"]
    attempts = table(spark, sf, "attempts").select(*columns, F.col("ts").cast("timestamp").alias("ts"))
    J.jsonl_sink(attempts.repartition(F.xxhash64(*columns[:3])), f"{base}/in")
    fs, place = file_system(spark, f"{base}/in")
    files = sum(s.getPath().getName().endswith(".json") for s in fs.listStatus(place))
    live = Live(spark, f"{base}/out", delay=60 * 86_400)
    return run_live(live, f"{base}/in", f"{base}/checkpoint", files_per_trigger=files_per_trigger or max(1, -(-files // batches)), end_of_input=True)


@query(
    "stream_thread_state",
    """SELECT thread_id, request_ord, attempts_made AS attempts, status, sql_text, error, error_history
    FROM histories QUALIFY row_number() OVER (PARTITION BY thread_id, request_ord ORDER BY attempt_ord DESC) = 1""",
    **CHAIN, histories=HISTORY,
)
def stream_thread_state(spark, sf):
    rows = live_requests(run_stream(spark, sf, files_per_trigger=1000))
    return rows.select(
        "thread_id", "request_ord", "attempts", "status", "sql_text", "error",
        F.array_join("error_history", "\n").alias("error_history"),
    )


@query(
    "stream_event_frames",
    FRAMES,
    **CHAIN,
)
def stream_event_frames(spark, sf):
    return run_stream(spark, sf, batches=3).output("frames", FRAME)


@query(
    "stream_thread_history",
    """SELECT thread_id, request_ord, row_number() OVER (PARTITION BY thread_id ORDER BY request_ord) - 1 AS position, sql_text,
     CASE status WHEN 'failed' THEN 'Sorry, I am potato.' END AS answer FROM states WHERE status <> 'retry'""",
    **CHAIN,
)
def stream_thread_history(spark, sf):
    return run_stream(spark, sf, batches=2).output("turns", TURN).drop("last")


def arriving_pairs(spark: SparkSession, sf: str, base: str) -> None:
    """All pairs as JSON files of a stream."""
    arriving = table(spark, sf, "pairs").select(
        "split", "source", "row_ord", "db_id", "question", "query",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("row_ord")).alias("ts"),
    )
    J.jsonl_sink(arriving.repartition(F.col("row_ord")), f"{base}/in")


@query(
    "stream_feedback_pairs",
    """SELECT p.id AS id, p.db_id AS db_id, p.question AS question, p.query AS query, t.tables AS tables, m.method AS extraction_method
    FROM (SELECT DISTINCT id, k, db_id, question, query FROM clean_pairs WHERE k <> 17) p
    JOIN targets t ON p.k = t.k JOIN (SELECT DISTINCT k, method FROM expected_used) m ON p.k = m.k""",
)
def stream_feedback_pairs(spark, sf):
    base = scratch_path(spark, "feedback")
    arriving_pairs(spark, sf, base)
    rows = run_feedback(
        spark, f"{base}/in", label_catalogs(spark, sf), f"{base}/out", f"{base}/checkpoint",
        delay="30 days",
    )
    return rows.select(
        "id", "db_id", "question", "query", F.array_join("tables", ",").alias("tables"),
        "extraction_method",
    )


@query(
    "feedback_training_rows",
    """SELECT p.id AS id, p.query AS query, t.tables AS tables,
     CASE WHEN p.id IN (SELECT id FROM clean_pairs WHERE split = 'val') THEN 'corpus' ELSE 'stream' END AS origin
    FROM (SELECT DISTINCT id, k, query FROM clean_pairs WHERE k <> 17) p
    JOIN targets t ON p.k = t.k JOIN (SELECT DISTINCT k FROM expected_used) m ON p.k = m.k""",
)
def feedback_training_rows(spark, sf):
    """The val split is the stored corpus; all pairs, its own ones among them, arrive in three micro-batches."""
    base = scratch_path(spark, "feedback")
    arriving_pairs(spark, sf, base)
    catalogs = C.staged_catalogs(label_catalogs(spark, sf))
    stored = stage(label_rows(label_pairs(unique_pairs(spark, sf).where("split = 'val'"), catalogs)), "corpus")
    fs, place = file_system(spark, f"{base}/in")
    files = sum(s.getPath().getName().endswith(".json") for s in fs.listStatus(place))
    added = run_feedback(
        spark, f"{base}/in", catalogs, f"{base}/out", f"{base}/checkpoint", delay="30 days",
        files_per_trigger=max(1, -(-files // 3)), corpus=stored,
    )
    return training_corpus(stored, added).select("id", "query", F.array_join("tables", ",").alias("tables"), "origin")


# ---- model versions

MOVES = """SELECT *, lag(action) OVER (PARTITION BY model ORDER BY seq) AS last_action, lag(version) OVER (PARTITION BY model ORDER BY seq) AS last_version
 FROM alias_log WHERE action <> 'rejected'"""
DONE = """SELECT model, seq, cast(last_version AS BIGINT) AS champion, cast(lag(last_version) OVER (PARTITION BY model ORDER BY seq) AS BIGINT) AS prev_champion
 FROM moves WHERE action = 'promote' AND last_action = 'register'"""


def alias_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "alias_log")


@query(
    "promote_candidate",
    """SELECT m.model AS model, m.seq AS seq, d.champion AS champion, d.prev_champion AS prev_champion,
     CASE WHEN d.champion IS NULL THEN concat('no candidate to promote for ', m.model) END AS error
    FROM moves m LEFT JOIN done d ON m.model = d.model AND m.seq = d.seq WHERE m.action = 'promote'""",
    moves=MOVES, done=DONE,
)
def promote_candidate(spark, sf):
    return V.promote_candidate(alias_log(spark, sf))


ALIASES = """SELECT model, cast(CASE WHEN max_by(action, seq) FILTER (WHERE action <> 'rejected') = 'register' THEN max_by(version, seq) FILTER (WHERE action <> 'rejected') END AS BIGINT) AS candidate,
 (SELECT max_by(champion, d.seq) FROM done d WHERE d.model = m.model) AS champion,
 (SELECT max_by(coalesce(prev_champion, -1), d.seq) FROM done d WHERE d.model = m.model) AS prev_or_none FROM alias_log m GROUP BY model"""


@query(
    "alias_state",
    "SELECT model, candidate, champion, nullif(prev_or_none, -1) AS prev_champion FROM aliases",
    moves=MOVES, done=DONE, aliases=ALIASES,
)
def alias_state(spark, sf):
    return V.alias_state(alias_log(spark, sf))


@query(
    "registration_row",
    """SELECT run_id, row_number() OVER (ORDER BY run_id) AS version, 'candidate' AS alias, table_recall, column_recall, unparseable_rate,
     substr(sha256(concat('v1', chr(10), 'prompt of run ', run_id)), 1, 16) AS prompt_hash,
     (SELECT cast(sum(cast(concat('0x', substr(md5(concat_ws(chr(1), id, db_id, question, query)), 1, 15)) AS BIGINT)) AS VARCHAR)
      FROM unique_pairs WHERE split = 'train') AS dataset_fingerprint
    FROM runs WHERE table_recall >= 0.9 AND column_recall >= 0.8 AND unparseable_rate <= 0.01""",
)
def registration_row(spark, sf):
    runs = table(spark, sf, "runs").withColumn("model", F.lit("pruner"))
    train = unique_pairs(spark, sf).where("split = 'train'")
    made_from = T.dataset_fingerprint(train, ["id", "db_id", "question", "query"], ["split"]).first()
    prompt = F.concat(F.lit("prompt of run "), F.col("run_id").cast("string"))
    lineage = {
        "prompt_hash": T.prompt_fingerprint(F.lit("v1"), prompt),
        "dataset_fingerprint": F.lit(str(made_from["hash_sum"])),
    }
    return V.registration_row(runs, ["model"], "run_id", lineage=lineage).drop("model")


@query(
    "artifact_location",
    """SELECT ord, CASE WHEN starts_with(uri, 'mlflow-artifacts:/') THEN concat('mlflow/', substr(uri, 19)) WHEN starts_with(uri, 's3://') THEN substr(uri, 6) END AS location,
    CASE WHEN starts_with(uri, 'file:') THEN concat('cannot resolve artifact location ''', uri, '''') END AS error FROM landing""",
)
def artifact_location(spark, sf):
    return table(spark, sf, "landing").select(
        "ord", F.inline(F.array(V.artifact_location(F.col("uri"))))
    )


@query(
    "stale_artifacts",
    """SELECT node, model, CASE WHEN NOT lookup_ok THEN CASE WHEN present THEN 'keep' ELSE 'error' END
     WHEN champion IS NULL THEN CASE WHEN present THEN 'keep' ELSE 'error' END
     WHEN present AND stamped_version = champion THEN 'keep' ELSE 'load' END AS action
    FROM (SELECT p_partkey AS node, concat('m', p_partkey) AS model, p_size % 3 <> 0 AS present, p_partkey % 13 <> 0 AS lookup_ok, p_size AS stamped_version FROM part) s
    LEFT JOIN aliases a USING (model)""",
    moves=MOVES, done=DONE, aliases=ALIASES,
)
def stale_artifacts(spark, sf):
    stamps = table(spark, sf, "part").select(
        F.col("p_partkey").alias("node"),
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("model"),
        (F.col("p_size") % 3 != 0).alias("present"), (F.col("p_partkey") % 13 != 0).alias("lookup_ok"),
        F.col("p_size").cast("bigint").alias("stamped_version"),
    )
    champions = V.alias_state(alias_log(spark, sf))
    return V.stale_artifacts(stamps, champions).select("node", "model", "action")


@query(
    "serving_manifest",
    """SELECT role, CASE WHEN NOT missing THEN concat('models/serving/', role, '/base') END AS base,
     CASE WHEN NOT missing AND adapter IS NOT NULL THEN concat('models/serving/', role, '/adapter') END AS adapter,
     CASE WHEN NOT missing THEN adapter END AS registered_model, served AS version,
     CASE WHEN missing THEN concat('no local adapter and no champion for ', adapter) END AS error
    FROM (SELECT role, adapter, coalesce(champion, stamped) AS served, adapter IS NOT NULL AND champion IS NULL AND stamped IS NULL AS missing FROM (SELECT concat('role', p_partkey) AS role, CASE WHEN p_partkey % 4 <> 0 THEN concat('m', p_partkey) END AS adapter,
      CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 7 = 0 THEN p_partkey END AS stamped FROM part) r
    LEFT JOIN aliases a ON r.adapter = a.model) x""",
    moves=MOVES, done=DONE, aliases=ALIASES,
)
def serving_manifest(spark, sf):
    roles = table(spark, sf, "part").select(
        F.concat(F.lit("role"), F.col("p_partkey").cast("string")).alias("role"),
        F.when(
            F.col("p_partkey") % 4 != 0, F.concat(F.lit("m"), F.col("p_partkey").cast("string"))
        ).alias("adapter"),
        F.when(
            (F.col("p_partkey") % 4 != 0) & (F.col("p_partkey") % 7 == 0),
            F.struct(
                F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("registered_model"),
                F.col("p_partkey").alias("version"), F.lit("old").alias("run_id"), F.lit("s3://old").alias("source"),
            ),
        ).alias("stamp"),
    )
    champions = V.alias_state(alias_log(spark, sf)).select(
        "model", "champion", F.concat(F.lit("run-"), "model").alias("run_id"),
        F.concat(F.lit("s3://models/"), "model").alias("source"),
    )
    manifest = V.serving_manifest(roles, champions, "models/serving")
    return manifest.select(
        "role", "server.base", "server.adapter", "server.champion.registered_model",
        "server.champion.version", "error",
    )
