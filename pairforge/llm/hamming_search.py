"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector becomes a 64-bit code of its signs. Codes are cut into segments and indexed by
(segment, value). In round r every query that is not finished probes all segment values at
distance r of its own; what it meets is verified by the distance of the whole codes. Once
every segment has been probed up to radius r, every code within distance
``segments * (r + 1) - 1`` has been met, so a query is finished as soon as its k-th verified
distance is no larger. Index and probes meet in a shuffle by (segment, value); finished
queries leave the rounds, and only the k best of each query are carried on.

Queries are the rows whose id is divisible by ``every``, against all rows. Ranks go by
distance, then by id; a row is not its own neighbour. Of rows with equal codes only the
``k + 1`` with the smallest ids can be in an answer, and only these are indexed, so copies
make no long lists. An id with several vectors has each of them indexed and asked, and
counts with its smallest distance. Missing or null components count as zero; a vector of
more components than a code has bits fails the job. Rows without id are left out. A query id
without a vector, or without any neighbour, has one row with null rank, neighbour and distance.
An empty table gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairforge.functions.scratch import Stages, stage

BITS, SEGMENTS = 64, 4
SEGMENT_BITS = BITS // SEGMENTS
K, EVERY = 10, 100


def sign_codes(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``code``: bit i is set where component i is above zero; null for a null vector."""
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))
    code = F.aggregate(F.transform(vector, bit), F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))
    too_long = F.raise_error(F.lit(f"a vector has more than {BITS} components")).cast("bigint")
    return vectors.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("id"), F.when(F.size(vector) > BITS, too_long).otherwise(code).alias("code")
    )


def segment_values(code: Column) -> Column:
    """A number per segment: its place above its bits."""
    low = (1 << SEGMENT_BITS) - 1
    own = lambda s: F.shiftright(code, s * SEGMENT_BITS).bitwiseAND(low) + (s << SEGMENT_BITS)
    return F.array(*[own(s) for s in range(SEGMENTS)])


def masks_of(radius: int) -> list[int]:
    """All segment masks with so many bits."""
    return [sum(1 << b for b in c) for c in combinations(range(SEGMENT_BITS), radius)]


def _best(met: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest neighbours of each query; what was met several times counts once."""
    once = met.groupBy("query_id", "neighbor_id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_codes(codes: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, neighbor_id, distance`` for every query id of ``id, code``."""
    spark = codes.sparkSession
    with Stages() as stages:
        codes = stages.write(codes.distinct(), "codes")
        same = Window.partitionBy("code").orderBy("id")
        indexed = codes.where("code is not null").withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
        index = stages.write(indexed.select("id", "code", F.explode(segment_values(F.col("code"))).alias("value")), "segments")
        asked = codes.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("code").alias("query_code"))
        open_queries = stages.write(asked.where("query_code is not null"), "queries")
        best = spark.createDataFrame([], "query_id bigint, neighbor_id bigint, distance int, rank int")
        answers = []
        for radius in range(SEGMENT_BITS + 1):
            probe = F.explode(F.lit(masks_of(radius)))
            probes = (
                open_queries.withColumn("own", F.explode(segment_values(F.col("query_code"))))
                .withColumn("mask", probe)
                .select("query_id", "query_code", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
            )
            # Sizes before an explode would mislead the planner to broadcast one side.
            met = probes.join(index.hint("merge"), "value").where("id <> query_id").select(
                "query_id", F.col("id").alias("neighbor_id"), F.bit_count(F.col("code").bitwiseXOR(F.col("query_code"))).alias("distance")
            )
            best = stages.write(_best(best.drop("rank").unionByName(met), k), "best")
            covered = SEGMENTS * (radius + 1) - 1
            finished = best.where((F.col("rank") == k) & (F.col("distance") <= covered)).select("query_id")
            if radius == SEGMENT_BITS:
                finished = open_queries.select("query_id").distinct()
            answers.append(stage(best.join(finished, "query_id", "left_semi"), "answers"))
            open_queries = stages.write(open_queries.join(finished, "query_id", "left_anti"), "queries")
            best = best.join(finished, "query_id", "left_anti")
            if open_queries.isEmpty():
                break
        found = answers[0]
        for more in answers[1:]:
            found = found.unionByName(more)
        ids = stage(asked.select("query_id").distinct(), "asked")
    return ids.join(found, "query_id", "left").select("query_id", F.col("rank").cast("int").alias("rank"), "neighbor_id", F.col("distance").cast("bigint").alias("distance"))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """The ``k`` rows nearest to each query row, by the Hamming distance of sign codes."""
    return nearest_codes(sign_codes(vectors), k, every)
