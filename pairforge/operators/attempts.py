"""Replay of logged SQL attempts, chat history and stream frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.fixed_values import (
    FAILURE_ANSWER,
    HISTORY_TURNS,
    MAX_RETRIES,
    NO_SQL_ERROR,
    STREAM_DONE,
)
from pairforge.functions.joins import with_position
from pairforge.functions.text import json_text

REQUEST = ["thread_id", "request_ord"]


def response_class(status: Column, body: Column, reason: Column | None = None) -> Column:
    """``outcome`` (ok, sql_error or fatal) and ``error`` text of a database response.

    A null status means the service was not reached; ``reason`` then holds why.
    """
    reason = reason if reason is not None else F.lit(None).cast("string")
    parsed = F.try_parse_json(body)
    detail = F.when(
        parsed.isNotNull(),
        F.coalesce(F.try_variant_get(parsed, "$.detail", "string"), body),
    ).otherwise(F.coalesce(F.nullif(body, F.lit("")), reason, F.lit("")))
    return F.struct(
        F.when(status == 200, "ok").when(status == 422, "sql_error").otherwise("fatal").alias("outcome"),
        F.when(status == 200, F.lit(None).cast("string"))
        .when(status.isNull(), F.concat(F.lit("database service unreachable: "), F.coalesce(reason, F.lit(""))))
        .when(status == 422, detail)
        .otherwise(F.concat(F.lit("query failed ("), status.cast("string"), F.lit("): "), detail))
        .alias("error"),
    )


def attempt_outcome(sql: Column, response: Column, prior_error: Column | None = None) -> Column:
    """``result`` (ok, retryable or fatal) and ``error`` of one attempt.

    Without SQL there was no call: the generator's error is kept.
    """
    prior = prior_error if prior_error is not None else F.lit(None).cast("string")
    no_sql = F.coalesce(sql, F.lit("")) == ""
    return F.struct(
        F.when(no_sql, "retryable")
        .when(response["outcome"] == "ok", "ok")
        .when(response["outcome"] == "sql_error", "retryable")
        .otherwise("fatal")
        .alias("result"),
        F.when(no_sql, F.coalesce(prior, F.lit(NO_SQL_ERROR))).otherwise(response["error"]).alias("error"),
    )


def with_outcome(attempts: DataFrame, generator_error: str | None = None) -> DataFrame:
    """Attempts with ``result`` and ``error``; ``generator_error`` names the column with what the generator said."""
    response = response_class(F.col("http_status"), F.col("body"))
    prior = None if generator_error is None else F.col(generator_error)
    outcome = attempt_outcome(F.col("sql_text"), response, prior)
    return attempts.withColumn("_o", outcome).withColumns(
        {"result": F.col("_o.result"), "error": F.col("_o.error")}
    ).drop("_o")


def attempt_state(outcomes: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Counter and status after each attempt; attempts after a final one are dropped.

    A fatal error ends the request without being counted. Every attempt ends
    the request or adds one to the counter, so only the first ``max_retries``
    can matter, and only those are shuffled.
    """
    ordered = Window.partitionBy(*REQUEST).orderBy("attempt_ord")
    ranked = outcomes.withColumn("_rank", F.row_number().over(ordered))
    outcomes = ranked.where(F.col("_rank") <= max(max_retries, 1)).drop("_rank")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    attempts = F.sum(F.when(F.col("result") == "retryable", 1).otherwise(0)).over(so_far)
    counted = outcomes.withColumn("attempts", attempts.cast("bigint"))
    status = (
        F.when(F.col("result") == "ok", "success")
        .when(F.col("result") == "fatal", "failed")
        .when(F.col("attempts") >= max_retries, "failed")
        .otherwise("retry")
    )
    decided = counted.withColumn("status", status)
    ended = F.sum(F.when(F.col("status") != "retry", 1).otherwise(0)).over(before)
    return decided.withColumn("_ended", F.coalesce(ended, F.lit(0))).where("_ended = 0").drop("_ended")


def error_history(states: DataFrame) -> DataFrame:
    """Ordered error texts of each request up to each attempt; fatal errors add none."""
    line = F.when(
        F.col("result") == "retryable",
        F.concat(
            F.lit("attempt "), F.col("attempts").cast("string"), F.lit(": "),
            F.coalesce(F.concat(F.lit("'"), "sql_text", F.lit("'")), F.lit("None")),
            F.lit(" -> "), F.col("error"),
        ),
    )
    upto = Window.partitionBy(*REQUEST).orderBy("attempt_ord").rowsBetween(Window.unboundedPreceding, 0)
    return states.withColumn("error_history", F.collect_list(line).over(upto))


def route_next(status: Column) -> Column:
    return F.when(status == "retry", "generate_sql").when(status == "success", "present").otherwise(
        "handle_failure"
    )


def schema_context(
    has_history: Column, is_retry: Column, pruned_text: Column, full_text: Column
) -> Column:
    """Schema text a generator call sees; ``pruned_text`` is null for an unreadable reply."""
    return F.when(has_history | is_retry, full_text).otherwise(F.coalesce(pruned_text, full_text))


def history_append(turns: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The append-only log of a thread: every turn with its position, oldest first."""
    return with_position(turns, keys, order)


def history_window(
    turns: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    last_n: int = HISTORY_TURNS,
    *,
    width: int = 100_000,
) -> DataFrame:
    """Every turn with the ``history`` of up to ``last_n`` turns before it.

    A long thread is cut into segments by position, none shorter than the window; the
    last turns of a segment are also handed to the next one, so no thread has to fit one task.
    """
    width = max(width, last_n)
    log = history_append(turns.withColumn("_value", value), keys, order)
    segment = F.floor(F.col("position") / width).cast("long")
    if last_n <= 0:
        return log.withColumn("history", F.filter(F.array("_value"), lambda v: F.lit(False))).drop("_value")
    carries = F.pmod(F.col("position"), F.lit(width)) >= width - last_n
    spread = log.withColumn(
        "_seg", F.explode(F.when(carries, F.array(segment, segment + 1)).otherwise(F.array(segment)))
    )
    frame = Window.partitionBy(*keys, "_seg").orderBy("position").rowsBetween(-last_n, -1)
    return (
        spread.withColumn("history", F.collect_list("_value").over(frame))
        .where(F.col("_seg") == segment)
        .drop("_seg", "_value")
    )


def turn_record(states: DataFrame, answer: Column) -> DataFrame:
    """The turn each finished request appends: its answer, or the failure text."""
    final = states.where(F.col("status") != "retry")
    return final.withColumn(
        "answer", F.when(F.col("status") == "success", answer).otherwise(FAILURE_ANSWER)
    )


def event_frames(updates: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """One data frame per update, an error frame where it failed, and a final end frame."""
    body = F.when(
        F.col("failure").isNotNull(), json_text(F.col("failure").alias("error"))
    ).otherwise(json_text(*fields))
    data = updates.select(
        *keys, F.col(order).cast("bigint").alias("seq"),
        F.concat(F.lit("data: "), body, F.lit("\n\n")).alias("frame"),
    )
    ends = updates.groupBy(*keys).agg((F.max(order) + 1).cast("bigint").alias("seq")).withColumn(
        "frame", F.lit(f"data: {STREAM_DONE}\n\n")
    )
    return data.unionByName(ends)
