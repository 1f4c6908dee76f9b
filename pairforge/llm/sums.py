"""Sums of large vectors over all tasks, formed in Spark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pairforge.functions.scratch import Stages

PARTS = "part bigint, n bigint, total binary"
FAN_IN = 16


def part_of(n: int, total: np.ndarray) -> pa.RecordBatch:
    """What one task has summed, in the form of PARTS."""
    flat = np.ascontiguousarray(total, np.float64).tobytes()
    return pa.record_batch(
        [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([flat], pa.binary())], names=["part", "n", "total"]
    )


def summed(stages: Stages, parts: DataFrame, fan_in: int = FAN_IN) -> tuple[int, np.ndarray | None]:
    """Sums of ``n`` and of ``total`` over rows numbered by ``part``.

    Rows are added up ``fan_in`` at a time, level after level, so that the driver receives one,
    however many tasks there were.
    """

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.float64) for b in group["total"])
        return pa.table({
            "part": pa.array([group["part"][0].as_py() // fan_in], pa.int64()),
            "n": pa.array([sum(group["n"].to_pylist())], pa.int64()), "total": pa.array([total.tobytes()], pa.binary()),
        })

    parts = stages.write(parts, "sums")
    many = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while many > 1:
        by = parts.groupBy(F.expr(f"part div {fan_in}").alias("_by"))
        parts, many = by.applyInArrow(add, PARTS), -(-many // fan_in)
    row = parts.first()
    return (row["n"], np.frombuffer(row["total"], np.float64)) if row else (0, None)
