from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pairforge.fixed_values import FAILURE_ANSWER
from pairforge.functions.joins import previous_value, with_position
from pairforge.operators import attempts as A, versions as V
from pairforge.operators.gates import model_gates
from pairforge.sources import json_files as J
from pairforge.streaming import feedback
from pairforge.streaming.threads import END, FRAME, STATE, TURN, Live, live_requests, merged_log, new_logs, run_live
from workload import labels


@pytest.mark.parametrize("status,body,outcome,error", [
    (200, "", "ok", None),
    (422, '{"detail": "bad col"}', "sql_error", "bad col"),
    (422, "plain", "sql_error", "plain"),
    (503, '{"other": 1}', "fatal", 'query failed (503): {"other": 1}'),
    (None, None, "fatal", "database service unreachable: refused"),
    (500, "", "fatal", "query failed (500): refused"),
])
def test_response_class(spark, status, body, outcome, error):
    row = spark.createDataFrame([(status, body)], "s int, b string").select(
        F.inline(F.array(A.response_class(F.col("s"), F.col("b"), F.lit("refused"))))
    ).first()
    assert tuple(row) == (outcome, error)


LOG = "thread_id bigint, request_ord bigint, attempt_ord bigint, sql_text string, http_status int, body string"
ATTEMPTS = [
    (1, 0, 1, "a", 422, '{"detail": "e1"}'), (1, 0, 2, "b", 200, ""), (1, 0, 3, "c", 200, ""),
    (1, 1, 1, None, 200, ""), (1, 1, 2, "d", 422, "e2"), (1, 1, 3, "x", 200, ""),
    (2, 0, 1, "f", 503, "down"), (2, 0, 2, "g", 200, ""),
    (3, 0, 1, "h", 422, "e3"),
]

# The first attempt was lost, and another request counts from 0.
LOST_FIRST = [
    (4, 0, 2, "p", 422, "e4"), (4, 0, 3, "q", 200, ""), (5, 0, 0, "r", 422, "e5"), (5, 0, 1, "s", 422, "e6"), (5, 0, 2, "t", 200, ""),
]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(ATTEMPTS, LOG)


def test_attempt_states(log):
    states = A.error_history(A.attempt_state(A.with_outcome(log)))
    got = {(r.thread_id, r.request_ord, r.attempt_ord): r for r in states.collect()}
    assert {k: (r.attempts, r.status) for k, r in got.items()} == {
        (1, 0, 1): (1, "retry"), (1, 0, 2): (1, "success"), (1, 1, 1): (1, "retry"),
        (1, 1, 2): (2, "failed"), (2, 0, 1): (0, "failed"), (3, 0, 1): (1, "retry"),
    }
    assert got[1, 1, 2].error_history == [
        "attempt 1: None -> no SQL was generated", "attempt 2: 'd' -> e2"
    ]
    assert got[2, 0, 1].error_history == [] and got[2, 0, 1].error == "query failed (503): down"
    turns = {(r.thread_id, r.request_ord): r.answer for r in A.turn_record(states, F.lit("yes")).collect()}
    assert turns == {(1, 0): "yes", (1, 1): FAILURE_ANSWER, (2, 0): FAILURE_ANSWER}


def test_more_retries(log):
    states = A.attempt_state(A.with_outcome(log), 3).where("thread_id = 1 AND request_ord = 1").collect()
    assert [r.status for r in sorted(states, key=lambda r: r.attempt_ord)] == ["retry", "retry", "success"]


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_equals_batch(spark, log, tmp_path, parts):
    """Arrival in reverse order, in one or several micro-batches, gives the batch result."""
    late = [*ATTEMPTS, *LOST_FIRST]
    for i, rows in enumerate([late[::-1][j::parts] for j in range(parts)]):
        arrived = spark.createDataFrame(rows, LOG).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000)))
        J.jsonl_sink(arrived.coalesce(1), f"{tmp_path}/in/{i}")
    live = run_live(Live(spark, f"{tmp_path}/out", first_ord=0), f"{tmp_path}/in/*", f"{tmp_path}/check", files_per_trigger=1)
    before = live_requests(live)
    assert live.output("turns", TURN).count() == 0 and before.count() == 6
    run_live(live, f"{tmp_path}/in/*", f"{tmp_path}/check", end_of_input=True)
    assert live.before("state", STATE, END + 1).where("not closing").count() == 0
    log = log.union(spark.createDataFrame(LOST_FIRST, LOG))
    states = A.error_history(A.attempt_state(A.with_outcome(log)))
    last = states.groupBy("thread_id", "request_ord").agg(
        F.max_by(F.struct("attempts", "status", "error_history", "error"), "attempt_ord").alias("s")
    )
    expected = {(r.thread_id, r.request_ord): tuple(r.s) for r in last.collect()}
    got = {
        (r.thread_id, r.request_ord): (r.attempts, r.status, r.error_history, r.error)
        for r in live_requests(live).collect()
    }
    assert got == expected and live_requests(live).count() == len(expected)
    updates = states.withColumn("failure", F.when(F.col("result") == "fatal", F.col("error")))
    frames = A.event_frames(updates, A.REQUEST, "attempt_ord", ["attempts", "status", "sql_text"])
    assert sorted(map(tuple, live.output("frames", FRAME).collect())) == sorted(map(tuple, frames.collect()))
    turns = A.history_append(A.turn_record(states, F.lit(None)), ["thread_id"], "request_ord").select(*A.REQUEST, "position", "sql_text", "answer")
    assert sorted(map(tuple, live.output("turns", TURN).drop("last").collect()), key=str) == sorted(map(tuple, turns.collect()), key=str)


def test_frames_are_live_and_repeated_batches_add_nothing(spark, log, tmp_path):
    """Frames come as soon as no earlier attempt is missing; one end frame per request."""
    live = Live(spark, f"{tmp_path}/out")
    timed = log.selectExpr("*", "cast(null as string) AS generator_error", "timestamp_seconds(1700000000) AS ts")
    first = timed.where("thread_id = 1 and request_ord = 0")
    live.advance(first.where("attempt_ord = 2"), 0)
    assert live.output("frames", FRAME).count() == 0
    for _ in range(2):
        live.advance(first.where("attempt_ord = 1"), 1)
        told = sorted((r.seq, r.frame[:8]) for r in live.output("frames", FRAME).collect())
        assert told == [(1, 'data: {"'), (2, 'data: {"'), (3, "data: [D")]
    live.advance(first, 2)
    live.advance(None, END)
    assert live.output("frames", FRAME).count() == 3
    assert [r.position for r in live.output("turns", TURN).collect()] == [0]


def test_history_goes_on_over_closings(spark, tmp_path):
    """Requests are closed by the watermark; positions of a thread go on where they were."""
    live = Live(spark, f"{tmp_path}/out", delay=10, keep=10)
    for n in range(5):
        rows = spark.createDataFrame([(1, n, 1, f"s{n}", 200, ""), (2 + n, 0, 1, "x", 200, "")], LOG)
        live.advance(rows.selectExpr("*", "cast(null as string) AS generator_error", f"timestamp_seconds({1_700_000_000 + n * 100}) AS ts"), n)
    assert live.before("state", STATE, END).where("not closing").count() <= 4
    live.advance(None, END)
    turns = live.output("turns", TURN).where("thread_id = 1").collect()
    assert sorted((r.position, r.request_ord) for r in turns) == [(n, n) for n in range(5)]
    assert live_requests(live).count() == 10


def test_history_window_over_segments(spark):
    turns = spark.range(0, 100).select(F.lit("t").alias("t"), "id")
    for n in (8, 0):
        rows = A.history_window(turns, ["t"], "id", F.col("id"), n, width=10).collect()
        assert len(rows) == 100
        assert all(r.history == list(range(max(0, r.id - n), r.id)) for r in rows)


def test_history_longer_than_a_segment(spark):
    turns = spark.range(0, 60).select(F.lit("t").alias("t"), "id")
    rows = A.history_window(turns, ["t"], "id", F.col("id"), 12, width=10).collect()
    assert all(r.history == list(range(max(0, r.id - 12), r.id)) for r in rows) and len(rows) == 60


@pytest.mark.parametrize("ordinal", ["id * 1000003", "id div 50", "CASE WHEN id % 3 > 0 THEN id END"])
def test_positions_of_sparse_clustered_and_null_ordinals(spark, ordinal):
    """Positions have no gaps, follow the ordinal, and no task holds a whole long key."""
    rows = spark.range(0, 4000).select("id", F.expr("CASE WHEN id % 10 = 0 THEN id % 7 ELSE 99 END").alias("k"), F.expr(ordinal).alias("o"))
    numbered = with_position(rows, ["k"], "o")
    found = numbered.withColumn("task", F.spark_partition_id()).collect()
    assert len(found) == 4000
    for key in {r.k for r in found}:
        own = sorted((r for r in found if r.k == key), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        places = [-1 if r.o is None else r.o for r in own]
        assert places == sorted(places)


def test_state_of_old_requests_leaves(spark, tmp_path):
    """A request that is over for longer than it is kept starts anew."""
    times = [1_700_000_000, 1_700_000_000 + 40 * 86_400, 1_700_000_000 + 80 * 86_400, 1_700_000_000 + 120 * 86_400]
    for i, (when, thread) in enumerate(zip(times, (1, 2, 3, 1), strict=True)):
        rows = spark.createDataFrame([(thread, 0, i + 1, "a", 422, "e")], LOG).withColumn("ts", F.timestamp_seconds(F.lit(when)))
        J.jsonl_sink(rows.coalesce(1), f"{tmp_path}/in/{i}")
    live = run_live(Live(spark, f"{tmp_path}/out"), f"{tmp_path}/in/*", f"{tmp_path}/check", files_per_trigger=1)
    assert sorted((r.thread_id, r.seen) for r in live_requests(live).collect()) == [(1, 1), (1, 1), (2, 1), (3, 1)]
    assert live.before("state", STATE, END).where("not closing").count() <= 2


def test_repeated_attempts_are_bounded(spark):
    sent = [(1, 0, n, None if n % 2 else f"s{i}", 422, "e") for i in range(50) for n in (3, 1, 2, 7)]
    rows = spark.createDataFrame(sent, LOG).selectExpr("*", "cast(null as string) AS generator_error", "timestamp_seconds(0) AS ts")
    logs = new_logs(rows, 2).withColumn("twice", merged_log(F.col("log"), F.reverse("log"), 2)).first()
    assert [a.attempt_ord for a in logs.log] == [1, 2] and logs.twice == logs.log and logs.log[1].sql_text == "s0"


def test_feedback_labels_only_batches_that_bring_pairs(spark, tmp_path, monkeypatch):
    """The batch that only moves the watermark is not labelled, and what arrives is read from the state once."""
    catalogs = labels.label_catalogs(spark, "/root/testdata/sf0.001")
    db = catalogs.where("db_id like 'sales%'").first()["db_id"]
    pairs = [(i, db, f"name of customer {i % 3}", f"SELECT c_name FROM customer WHERE c_custkey = {i % 3}") for i in range(9)]
    rows = spark.createDataFrame(pairs, "row_ord bigint, db_id string, question string, query string")
    rows.selectExpr("'train' AS split", "'a.json' AS source", "*", "timestamp_seconds(1700000000 + row_ord) AS ts").write.json(f"{tmp_path}/in")
    seen, label_pairs = [], feedback.label_pairs
    monkeypatch.setattr(feedback, "label_pairs", lambda batch, *args, **more: seen.append(batch.count()) or label_pairs(batch, *args, **more))
    run = lambda: feedback.run_feedback(spark, f"{tmp_path}/in", catalogs, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert run().count() == 3 and seen == [3]
    rows.limit(1).selectExpr("'val' AS split", "'b.json' AS source", "*", "timestamp_seconds(1700000020 + row_ord) AS ts").write.mode("append").json(f"{tmp_path}/in")
    assert run().count() == 3 and seen == [3]


def test_previous_value_over_segments(spark):
    rows = spark.range(0, 200).select(F.lit(1).alias("k"), "id")
    value = F.when(F.col("id") % 37 == 0, F.col("id"))
    got = previous_value(rows, ["k"], "id", value, "last").collect()
    assert all(r["last"] == ((r.id - 1) // 37 * 37 if r.id else None) for r in got) and len(got) == 200


def test_event_frames(spark):
    updates = spark.createDataFrame(
        [(1, 0, "ok", None), (1, 1, None, "boom")], "t bigint, n bigint, s string, failure string"
    )
    rows = A.event_frames(updates, ["t"], "n", ["s"]).orderBy("seq").collect()
    assert [r.frame for r in rows] == [
        'data: {"s":"ok"}\n\n', 'data: {"error":"boom"}\n\n', "data: [DONE]\n\n"
    ]


def test_promotions(spark):
    events = "register:1 promote register:2 rejected promote promote register:3 register:4 promote register:4 promote register:5"
    rows = []
    for i, event in enumerate(events.split()):
        action, _, version = event.partition(":")
        rows.append(("m", i, action, int(version) if version else None))
    log = spark.createDataFrame(rows, "model string, seq bigint, action string, version bigint")
    got = V.promote_candidate(log).orderBy("seq").collect()
    assert [(r.champion, r.prev_champion) for r in got] == [(1, None), (2, 1), (None, None), (4, 2), (4, 2)]
    assert got[2].error == "no candidate to promote for m"
    assert tuple(V.alias_state(log).first()) == ("m", 5, 4, 2)


@pytest.mark.parametrize("uri,location", [
    ("mlflow-artifacts:/a/b", "mlflow/a/b"), ("mlflow-artifacts:///a", "mlflow/a"),
    ("s3://bucket/x", "bucket/x"), ("file:/x", None),
])
def test_artifact_location(one, uri, location):
    out = one(V.artifact_location(F.col("u")), u=uri)
    assert out.location == location and (out.error is None) == (location is not None)


def test_stale_artifacts(spark):
    stamps = spark.createDataFrame(
        [(1, "a", True, 3, True), (2, "a", True, 2, True), (3, "a", False, None, True),
         (4, "a", True, 2, False), (5, "a", False, None, False), (6, "z", True, 1, True)],
        "node int, model string, present boolean, stamped_version bigint, lookup_ok boolean",
    )
    champions = spark.createDataFrame([("a", 3)], "model string, champion bigint")
    got = {r.node: r.action for r in V.stale_artifacts(stamps, champions).collect()}
    assert got == {1: "keep", 2: "load", 3: "load", 4: "keep", 5: "error", 6: "keep"}


def test_runs_without_metrics_are_not_registered(spark):
    runs = spark.createDataFrame(
        [(1, 0.95, 0.9, 0.0), (2, None, 0.9, 0.0), (3, 0.95, None, 0.0), (4, 0.95, 0.9, None), (5, 0.5, 0.9, 0.0)],
        "run_id bigint, table_recall double, column_recall double, unparseable_rate double",
    ).withColumn("model", F.lit("m"))
    broken = {(r.run_id, r.message) for r in model_gates(runs).collect()}
    assert broken == {
        (2, "table_recall is missing"), (3, "column_recall is missing"), (4, "unparseable_rate is missing"),
        (5, "table_recall 0.5000 < 0.9"),
    }
    assert [(r.run_id, r.version) for r in V.registration_row(runs, ["model"], "run_id").collect()] == [(1, 1)]


def test_generator_error_is_kept(log):
    said = log.withColumn("said", F.when(F.col("sql_text").isNull(), "no SQL in reply"))
    errors = {r.error for r in A.with_outcome(said, "said").where("sql_text is null").collect()}
    assert errors == {"no SQL in reply"}


def test_manifest_without_champion(spark):
    stamp = "struct<registered_model: string, version: bigint, run_id: string, source: string>"
    roles = spark.createDataFrame(
        [("new", "z", None), ("kept", "z", ("z", 4, "r", "s3://y")), ("both", "a", ("a", 1, "r", "s3://y")), ("null", "b", None)],
        f"role string, adapter string, stamp {stamp}",
    )
    champions = spark.createDataFrame(
        [("a", 3, "r", "s3://x"), ("b", None, "r", "s3://x")], "model string, champion bigint, run_id string, source string"
    )
    got = {r.role: (r.server and r.server.champion.version, r.error) for r in V.serving_manifest(roles, champions, "d").collect()}
    assert got == {
        "new": (None, "no local adapter and no champion for z"), "kept": (4, None), "both": (3, None),
        "null": (None, "no local adapter and no champion for b"),
    }


def test_serving_manifest(spark):
    roles = spark.createDataFrame([("pruner", "a"), ("plain", None)], "role string, adapter string")
    champions = spark.createDataFrame(
        [("a", 3, "r", "s3://x")], "model string, champion bigint, run_id string, source string"
    )
    got = {r.role: r.server for r in V.serving_manifest(roles, champions, "d").collect()}
    assert got["pruner"].adapter == "d/pruner/adapter" and got["pruner"].champion.version == 3
    assert got["plain"].base == "d/plain/base" and got["plain"].adapter is None and got["plain"].champion is None

