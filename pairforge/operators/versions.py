"""Model-version tables: aliases, promotion, registration, artifacts, serving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.fixed_values import (
    ARTIFACT_BUCKET,
    CANDIDATE,
    OBJECT_SCHEME,
    TRACKED_SCHEME,
)
from pairforge.functions.joins import lookup_join, previous_value, with_position
from pairforge.operators.gates import broken_limits


def _promotions(log: DataFrame) -> DataFrame:
    """Promotions of an alias log with the version each made champion, null where none was pending."""
    moves = log.where(F.col("action").isin("register", "promote"))
    pending = F.struct("action", "version")
    last = previous_value(moves, ["model"], "seq", pending, "_last")
    return last.where("action = 'promote'").select(
        "model", "seq",
        F.when(F.col("_last.action") == "register", F.col("_last.version")).alias("champion"),
    )


def promote_candidate(log: DataFrame) -> DataFrame:
    """Every promotion of an alias log with its effect.

    ``log`` holds (model, seq, action, version) with actions ``register`` and
    ``promote``. A promotion takes the last registered version if none was
    promoted since; otherwise it is an error and changes nothing.
    """
    promotions = _promotions(log)
    old = previous_value(promotions, ["model"], "seq", F.col("champion"), "_old")
    changed = F.when(
        F.col("_old").isNotNull() & (F.col("_old") != F.col("champion")), F.col("_old")
    )
    # The champion replaced at the last real change, at or before this promotion.
    prior = previous_value(
        old.withColumn("_changed", changed), ["model"], "seq", F.col("_changed"), "_prior"
    )
    done = F.col("champion").isNotNull()
    return prior.select(
        "model", "seq", "champion",
        F.when(done, F.coalesce("_changed", "_prior")).alias("prev_champion"),
        F.when(~done, F.concat(F.lit("no candidate to promote for "), F.col("model"))).alias("error"),
    )


def alias_state(log: DataFrame) -> DataFrame:
    """Current version per model and alias; null where the alias is not set.

    The champion is the version promoted last, the previous champion the other
    version promoted last; versions are merged before they are ranked.
    """
    latest = _promotions(log).where("champion IS NOT NULL").groupBy("model", "champion").agg(
        F.max("seq").alias("seq")
    )
    rank = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("seq")))
    top = latest.withColumn("_rank", rank).where("_rank <= 2")
    champions = top.groupBy("model").agg(
        F.max(F.when(F.col("_rank") == 1, F.col("champion"))).alias("champion"),
        F.max(F.when(F.col("_rank") == 2, F.col("champion"))).alias("prev_champion"),
    )
    move = F.when(F.col("action").isin("register", "promote"), F.col("seq"))
    models = log.groupBy("model").agg(F.max_by(F.struct("action", "version"), move).alias("_m"))
    return models.join(champions, "model", "left").select(
        "model",
        F.when(F.col("_m.action") == "register", F.col("_m.version")).alias("candidate"),
        "champion", "prev_champion",
    )


def registration_row(
    runs: DataFrame, keys: list[str], order: str, *, lineage: dict[str, Column] | None = None, **limits: float
) -> DataFrame:
    """Runs that break no limit, as numbered versions with the candidate alias.

    A version keeps the columns of its run, its metrics among them, and what it was made from:
    ``lineage`` names columns such as the fingerprint of its data and the hash of its prompt.
    """
    passing = runs.where(F.size(broken_limits(**limits)) == 0)
    numbered = with_position(passing, keys, order)
    return numbered.withColumn("version", F.col("position") + 1).withColumns(
        {"alias": F.lit(CANDIDATE), **(lineage or {})}
    ).drop("position")


def artifact_location(uri: Column, bucket: str = ARTIFACT_BUCKET) -> Column:
    """``location`` (bucket and key) of an artifact address, and ``error`` for other schemes."""
    location = F.when(
        uri.startswith(TRACKED_SCHEME),
        F.concat(
            F.lit(bucket + "/"), F.ltrim(F.substr(uri, F.lit(len(TRACKED_SCHEME) + 1)), F.lit("/"))
        ),
    ).when(uri.startswith(OBJECT_SCHEME), F.substr(uri, F.lit(len(OBJECT_SCHEME) + 1)))
    return F.struct(
        location.alias("location"),
        F.when(
            location.isNull(), F.concat(F.lit("cannot resolve artifact location '"), uri, F.lit("'"))
        ).alias("error"),
    )


def stale_artifacts(stamps: DataFrame, champions: DataFrame) -> DataFrame:
    """What to do with each local copy: keep it, load the champion, or fail.

    ``stamps`` holds (node, model, present, stamped_version, lookup_ok);
    ``champions`` holds (model, champion).
    """
    joined = lookup_join(
        stamps, champions.select("model", "champion"), ["model"], "left", salt_on=["node"]
    )
    found = F.col("lookup_ok") & F.col("champion").isNotNull()
    action = (
        F.when(~found & F.col("present"), "keep")
        .when(~found, "error")
        .when(F.col("present") & F.col("stamped_version").eqNullSafe(F.col("champion")), "keep")
        .otherwise("load")
    )
    return joined.withColumn("action", action)


def serving_manifest(roles: DataFrame, champions: DataFrame, serving_dir: str) -> DataFrame:
    """Per role its base path, with adapter and champion only where an adapter is configured.

    ``roles`` holds (role, adapter) and may hold ``stamp``, the record of a copy that is
    kept locally (registered_model, version, run_id, source); ``champions`` holds
    (model, champion, run_id, source). An adapter without champion is served from its
    stamp; with neither, the role has an ``error`` and no server.
    """
    lookup = champions.where("champion is not null").select(
        F.col("model").alias("adapter"),
        F.struct(
            F.col("model").alias("registered_model"), F.col("champion").alias("version"),
            "run_id", "source",
        ).alias("champion"),
    )
    if "stamp" not in roles.columns:
        roles = roles.withColumn("stamp", F.lit(None).cast(lookup.schema["champion"].dataType))
    joined = lookup_join(roles, lookup, ["adapter"], "left", salt_on=["role"])
    base = F.concat(F.lit(serving_dir + "/"), F.col("role"))
    served = F.coalesce("champion", "stamp")
    missing = F.col("adapter").isNotNull() & served.isNull()
    return joined.select(
        "role",
        F.when(~missing, F.struct(
            F.concat(base, F.lit("/base")).alias("base"),
            F.when(F.col("adapter").isNotNull(), F.concat(base, F.lit("/adapter"))).alias("adapter"),
            F.when(F.col("adapter").isNotNull(), served).alias("champion"),
        )).alias("server"),
        F.when(missing, F.concat(F.lit("no local adapter and no champion for "), "adapter")).alias("error"),
    )
