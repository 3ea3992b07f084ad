"""Attempts as a stream: the state of each task, kept across batches and restarts.

State is a row for each task (attempts, completed, order and status of the last one), in the
query's state store; a replayed or late attempt of a lower order never replaces a later one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "task STRING, seq LONG, status STRING"
OUT = "task STRING, attempts LONG, completed LONG, last_status STRING, action STRING"
_STATE = "attempts LONG, completed LONG, seq LONG, status STRING"


def decide(status: str) -> tuple[str, str]:
    """(status as a resumed queue sees it, what it does)."""
    seen = "interrupted" if status == "running" else status
    return seen, {"complete": "skip", "cancelled": "stop"}.get(seen, "retry")


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    attempts, completed, seq, status = state.get if state.exists else (0, 0, -1, "")
    for rows in batches:
        attempts += len(rows)
        completed += int((rows["status"] == "complete").sum())
        last = rows.loc[rows["seq"].idxmax()]
        if int(last["seq"]) > seq:
            seq, status = int(last["seq"]), str(last["status"])
    state.update((attempts, completed, seq, status))
    seen, action = decide(status)
    yield pd.DataFrame({"task": [key[0]], "attempts": [attempts], "completed": [completed], "last_status": [seen], "action": [action]})


def read(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(folder)


def states(attempts: DataFrame) -> DataFrame:
    """Updates of each task's state, for output mode ``update``."""
    return attempts.groupBy("task").applyInPandasWithState(_advance, OUT, _STATE, "update", GroupStateTimeout.NoTimeout)
