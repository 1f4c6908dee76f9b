"""Live state of requests and threads: open requests, their frames, and the history of each thread.

The state is a table of open requests that each micro-batch replaces by its next version, in
Spark's own operators: new attempts are ranked, joined to the state by request, and what has
become certain is written as output. A busy thread is spread over its requests, and its
positions are counted in segments, so no task holds a thread.

An attempt is *certain* when no attempt before it can still arrive: all numbers from
``first_ord`` (no request has a smaller one) up to it are there, or the request is closed. A request is closed by a timer, when
the watermark is ``keep`` seconds past its last attempt, or at the end of the input. Outputs
are append-only, in whatever order attempts arrive:

* ``frames``: an event frame for each certain attempt up to the final one, then one end frame,
  after the final attempt or at closing;
* ``turns``: when a request is closed, the turn it adds to the history of its thread;
* ``requests``: when a request is closed, its last state.

Each micro-batch writes folders named by its number and reads older ones only, so a batch
that is repeated after a failure replaces what it wrote before. The state holds open
requests, each with the first ``max_retries`` attempts by number, as no later one can
matter, and one row per thread, until its last turn is ``keep_threads`` seconds old.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pairforge.fixed_values import FAILURE_ANSWER, MAX_RETRIES, STREAM_DONE
from pairforge.functions.joins import lookup_join, with_position
from pairforge.functions.scratch import discard, file_system
from pairforge.functions.text import json_text
from pairforge.operators.attempts import REQUEST, with_outcome

ATTEMPT = """thread_id bigint, request_ord bigint, attempt_ord bigint, sql_text string,
    generator_error string, http_status int, body string, ts timestamp"""
LOG = "array<struct<attempt_ord: bigint, result: string, sql_text: string, error: string>>"
STATE = f"""thread_id bigint, request_ord bigint, log {LOG}, last bigint, sent int, done boolean,
    was_sent int, was_done boolean, closing boolean, clock bigint"""
STATE_COLUMNS = [part.split()[0] for part in STATE.replace(LOG, "log").split(",")]
FRAME = "thread_id bigint, request_ord bigint, seq bigint, frame string"
TURN = "thread_id bigint, request_ord bigint, position bigint, sql_text string, answer string, last bigint"
THREAD = "thread_id bigint, turns bigint, last bigint"
RESULT = """thread_id bigint, request_ord bigint, seen bigint, attempts bigint, status string,
    sql_text string, error string, error_history array<string>, answer string"""
#: The end of the input counts as a batch after all others.
END = 1 << 40
FINAL = ["success", "failed"]


def _summary(log: Column, max_retries: int) -> Column:
    """What attempts, sorted by number, amount to: read in their order up to the one that ends the request.

    As in the batch replay an attempt counts by its rank, so numbers may have gaps or
    begin anywhere; until an attempt that was lost on the way arrives, those after it stand for it.
    """
    start = F.struct(
        F.lit(0).cast("bigint").alias("attempts"),
        F.lit("running").alias("status"),
        F.lit(None).cast("string").alias("sql_text"),
        F.lit(None).cast("string").alias("error"),
        F.array().cast("array<string>").alias("error_history"),
    )

    def step(acc: Column, a: Column) -> Column:
        retryable = a["result"] == "retryable"
        count = acc["attempts"] + F.when(retryable, 1).otherwise(0)
        line = F.concat(
            F.lit("attempt "), count.cast("string"), F.lit(": "),
            F.coalesce(F.concat(F.lit("'"), a["sql_text"], F.lit("'")), F.lit("None")),
            F.lit(" -> "), a["error"],
        )
        read = F.struct(
            count.alias("attempts"),
            F.when(a["result"] == "ok", "success")
            .when(retryable & (count < max_retries), "retry")
            .otherwise("failed")
            .alias("status"),
            a["sql_text"].alias("sql_text"),
            a["error"].alias("error"),
            F.when(retryable, F.concat(acc["error_history"], F.array(line)))
            .otherwise(acc["error_history"])
            .alias("error_history"),
        )
        return F.when(acc["status"].isin("running", "retry"), read).otherwise(acc)

    return F.aggregate(log, start, step)


def merged_log(kept: Column, new: Column, most: int) -> Column:
    """The first ``most`` attempts by number; of one that was sent twice the smaller record stays."""
    empty = F.array().cast(LOG)
    ordered = F.sort_array(F.concat(F.coalesce(kept, empty), F.coalesce(new, empty)))

    def first_of_number(x: Column) -> Column:
        return F.filter(x, lambda a, i: (i == 0) | (a["attempt_ord"] != F.get(x, i - 1)["attempt_ord"]))

    # The ordered log is bound to one lambda variable, so that it is sorted once.
    return F.slice(F.element_at(F.transform(F.array(ordered), first_of_number), 1), 1, most)


def new_logs(attempts: DataFrame, most: int) -> DataFrame:
    """Arrived attempts per request: ``log`` of the first ``most`` and the time of the last one (``last``)."""
    rows = with_outcome(attempts, "generator_error").select(
        *REQUEST, "attempt_ord", F.struct("result", "sql_text", "error").alias("_r"), F.unix_timestamp("ts").alias("ts")
    )
    # A flood of one attempt is met before the shuffle.
    once = rows.groupBy(*REQUEST, "attempt_ord").agg(F.min("_r").alias("_r"), F.max("ts").alias("ts"))
    rank = F.row_number().over(Window.partitionBy(*REQUEST).orderBy("attempt_ord"))
    first = once.withColumn("_rank", rank).where(F.col("_rank") <= most)
    logs = first.groupBy(*REQUEST).agg(F.sort_array(F.collect_list(F.struct("attempt_ord", "_r.*"))).cast(LOG).alias("log"))
    return logs.join(rows.groupBy(*REQUEST).agg(F.max("ts").alias("last")), REQUEST)


@dataclass
class Live:
    """Where the state and the outputs lie, and the rules of the state. Times are in seconds."""

    spark: SparkSession
    target: str
    max_retries: int = MAX_RETRIES
    delay: int = 86_400
    keep: int = 86_400
    keep_threads: int = 30 * 86_400
    first_ord: int = 1

    @property
    def most(self) -> int:
        return max(self.max_retries, 1)

    def versions(self, table: str) -> list[int]:
        """Numbers of the finished versions of a state table."""
        fs, folder = file_system(self.spark, f"{self.target}/{table}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        path = lambda n: file_system(self.spark, f"{self.target}/{table}/{n}/_SUCCESS")[1]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch=") and fs.exists(path(n)))

    def before(self, table: str, schema: str, batch_id: int) -> DataFrame:
        """The version of a state table that a batch starts from."""
        older = [n for n in self.versions(table) if n < batch_id]
        if not older:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.target}/{table}/batch={older[-1]}")

    def write(self, table: str, df: DataFrame, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.target}/{table}/batch={batch_id}")
        return self.spark.read.schema(df.schema).parquet(f"{self.target}/{table}/batch={batch_id}")

    def forget(self, table: str, batch_id: int) -> None:
        """Drop state versions that no repeated batch can ask for."""
        for n in [n for n in self.versions(table) if n < batch_id][:-1]:
            discard(self.spark, f"{self.target}/{table}/batch={n}")

    def output(self, table: str, schema: str) -> DataFrame:
        """All rows of an append-only output."""
        fs, folder = file_system(self.spark, f"{self.target}/{table}")
        if not fs.exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.target}/{table}/batch=*")

    def advance(self, attempts: DataFrame | None, batch_id: int) -> None:
        """Take in a micro-batch of attempts; none means the end of the input."""
        old = self.before("state", STATE, batch_id)
        clock = old.agg(F.greatest(F.max("clock"), F.max("last"))).first()[0]
        late = -(1 << 62) if clock is None else clock - self.delay
        if attempts is None:
            new = old.select(*REQUEST, F.col("log"), "last").limit(0)
        else:
            new = new_logs(attempts.where((F.unix_timestamp("ts") >= late) | F.col("ts").isNull()), self.most)
        kept = old.where("not closing").select(*REQUEST, F.col("log").alias("_kept"), F.col("last").alias("_last"), "sent", "done")
        log = merged_log(F.col("_kept"), F.col("log"), self.most)
        met = kept.join(new, REQUEST, "full_outer").select(
            *REQUEST, log.alias("log"), F.greatest("_last", "last").alias("last"),
            F.coalesce("sent", F.lit(0)).alias("was_sent"), F.coalesce("done", F.lit(False)).alias("was_done"),
        )
        closing = F.lit(True) if attempts is None else F.coalesce(F.col("last") + self.keep < late, F.lit(False))
        in_order = F.size(F.filter("log", lambda a, i: a["attempt_ord"] == self.first_ord + i))
        certain = F.when(F.col("closing"), F.size("log")).otherwise(in_order).cast("int")
        ended = _summary(F.slice("log", 1, F.col("sent")), self.max_retries)["status"].isin(*FINAL)
        step = (
            met.withColumn("closing", closing)
            .withColumn("sent", F.greatest("was_sent", certain))
            .withColumn("done", F.col("closing") | F.col("was_done") | ended)
            .withColumn("clock", F.lit(clock).cast("bigint"))
        )
        state = self.write("state", step.select(*STATE_COLUMNS), batch_id)
        self.write("frames", self.new_frames(state), batch_id)
        closed = state.where("closing").withColumn("s", _summary(F.col("log"), self.max_retries))
        self.write("requests", closed.select(
            *REQUEST, F.size("log").cast("bigint").alias("seen"), "s.attempts", "s.status", "s.sql_text", "s.error", "s.error_history",
            F.when(F.col("s.status") == "failed", FAILURE_ANSWER).alias("answer"),
        ), batch_id)
        self.append_turns(closed, batch_id, late)
        self.forget("state", batch_id)

    def new_frames(self, state: DataFrame) -> DataFrame:
        """Frames of attempts that have become certain, and end frames of requests that have become done."""
        upto = lambda n: _summary(F.slice("log", 1, n), self.max_retries)
        news = state.where("sent > was_sent").select(*REQUEST, "log", F.explode(F.sequence(F.col("was_sent") + 1, F.col("sent"))).alias("_n"))
        told = news.where(~upto(F.col("_n") - 1)["status"].isin(*FINAL)).select(
            *REQUEST, F.element_at("log", F.col("_n"))["attempt_ord"].alias("seq"),
            F.element_at("log", F.col("_n"))["result"].alias("_result"), F.inline(F.array(upto(F.col("_n")))),
        )
        body = F.when(F.col("_result") == "fatal", json_text(F.col("error").alias("error"))).otherwise(
            json_text("attempts", "status", "sql_text")
        )
        data = told.select(*REQUEST, "seq", F.concat(F.lit("data: "), body, F.lit("\n\n")).alias("frame"))
        # The end frame follows the last attempt that was told.
        counted = F.filter("log", lambda a, i: (i == 0) | ~upto(i)["status"].isin(*FINAL))
        ends = state.where("done and not was_done").select(
            *REQUEST, (F.element_at(counted, -1)["attempt_ord"] + 1).alias("seq"), F.lit(f"data: {STREAM_DONE}\n\n").alias("frame")
        )
        return data.unionByName(ends)

    def append_turns(self, closed: DataFrame, batch_id: int, late: int) -> None:
        """Turns of closed requests, after those that their threads have; requests closed together in their order."""
        threads = self.before("threads", THREAD, batch_id)
        finished = closed.where(F.col("s.status").isin(*FINAL))
        if finished.isEmpty():
            return
        placed = with_position(finished.select(*REQUEST, "s.sql_text", "s.status", "last"), ["thread_id"], "request_ord")
        numbered = lookup_join(placed, threads.select("thread_id", "turns"), ["thread_id"], "left", salt_on=["request_ord"])
        turns = self.write("turns", numbered.select(
            *REQUEST, (F.col("position") + F.coalesce("turns", F.lit(0))).cast("bigint").alias("position"), "sql_text",
            F.when(F.col("status") == "failed", FAILURE_ANSWER).alias("answer"), "last",
        ), batch_id)
        latest = turns.groupBy("thread_id").agg((F.max("position") + 1).alias("turns"), F.max("last").alias("last"))
        merged = threads.unionByName(latest).groupBy("thread_id").agg(F.max("turns").alias("turns"), F.max("last").alias("last"))
        self.write("threads", merged.where((F.col("last") + self.keep_threads >= late) | F.col("last").isNull()), batch_id)
        self.forget("threads", batch_id)


def run_live(
    live: Live, source: str, checkpoint: str, *, files_per_trigger: int = 1000, end_of_input: bool = False
) -> Live:
    """Read attempts that arrived as JSON files and bring the state up to date.

    With ``end_of_input`` no more attempts are awaited and all requests are closed.
    """
    stream = live.spark.readStream.schema(ATTEMPT).option("maxFilesPerTrigger", files_per_trigger).json(source)
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(live.advance)
        .start()
    )
    query.awaitTermination()
    if end_of_input:
        live.advance(None, END)
    return live


def live_requests(live: Live) -> DataFrame:
    """The last known state of every request, closed or open."""
    versions = live.versions("state")
    state = live.before("state", STATE, END + 1) if versions else live.spark.createDataFrame([], STATE)
    open_ones = state.where("not closing").withColumn("s", _summary(F.col("log"), live.max_retries)).select(
        *REQUEST, F.size("log").cast("bigint").alias("seen"), "s.attempts", "s.status", "s.sql_text", "s.error", "s.error_history",
        F.when(F.col("s.status") == "failed", FAILURE_ANSWER).alias("answer"),
    )
    return live.output("requests", RESULT).unionByName(open_ones)
