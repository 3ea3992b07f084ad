"""Batch state: attempts, the latest state of each planned task, resume decisions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The states of an attempt.
STATES = ("running", "interrupted", "complete", "failed", "cancelled", "invalid")


def latest_attempts(attempts: DataFrame, task: str, order: Column, *values: str) -> DataFrame:
    """(task, values) of each task's last attempt: one aggregation, no window sort."""
    return attempts.groupBy(task).agg(F.max_by(F.struct(*values), order).alias("v")).select(task, "v.*")


def planned_status(plan: DataFrame, attempts: DataFrame, task: str, order: Column, status: str, verified: Column | None = None) -> DataFrame:
    """(task, status) for every planned task. There is no falling back to an older success."""
    last = latest_attempts(attempts, task, order, status)
    bad = F.lit(False) if verified is None else ~verified
    state = F.when(F.col(status).isNull(), "pending").when(F.col(status) == "running", "interrupted").when(
        (F.col(status) == "complete") & bad, "invalid").otherwise(F.col(status))
    return plan.select(task).join(last, task, "left").select(task, state.alias("status"))


def fold_attempts(attempts: DataFrame, task: str, order: str, status: str) -> DataFrame:
    """(task, attempts, completed, last_status, action): what a resumed queue would do.

    Complete tasks are skipped; cancelled ones stop the run; others get a new attempt.
    """
    out = attempts.groupBy(task).agg(F.count("*").alias("attempts"), F.count_if(F.col(status) == "complete").alias("completed"), F.max_by(status, order).alias("raw"))
    last = F.when(F.col("raw") == "running", "interrupted").otherwise(F.col("raw"))
    action = F.when(last == "complete", "skip").when(last == "cancelled", "stop").otherwise("retry")
    return out.select(task, "attempts", "completed", last.alias("last_status"), action.alias("action"))


def summary(statuses: DataFrame) -> DataFrame:
    return statuses.agg(F.count("*").alias("planned"), F.count_if(F.col("status") == "complete").alias("included"))


def resume_key(*parts: Column) -> Column:
    """Identity of a task's logical inputs."""
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


class Cancelled(Exception):
    """Raised by work that was told to stop: the queue stops with it."""


def run_queue(tasks: list[str], attempts: list[dict], execute: Callable[[str, str], None], verify: Callable[[str, str], bool], save: Callable[[list[dict]], None]) -> list[dict]:
    """Run planned tasks one after another and return all attempts (task, directory, status, message).

    ``save`` writes the journal durably after every change. What ran when the last process ended is
    interrupted. A complete task that ``verify`` confirms is skipped; one that it doesn't is
    invalid and tried again, as failed and interrupted ones are, always in a new directory. A failure doesn't
    stop the queue, a cancellation does.
    """
    attempts = [{**a, "status": "interrupted"} if a["status"] == "running" else dict(a) for a in attempts]
    save(attempts)
    for task in tasks:
        last = next((a for a in reversed(attempts) if a["task"] == task), None)
        if last and last["status"] == "complete":
            if verify(task, last["directory"]):
                continue
            last["status"] = "invalid"
        own = {"task": task, "directory": f"attempt-{uuid.uuid4()}", "status": "running", "message": ""}
        attempts.append(own)
        save(attempts)
        try:
            execute(task, own["directory"])
            own["status"] = "complete" if verify(task, own["directory"]) else "invalid"
        except Cancelled as stop:
            own.update(status="cancelled", message=str(stop))
            save(attempts)
            break
        except Exception as error:  # the next task is independent of this one
            own.update(status="failed", message=str(error))
        save(attempts)
    return attempts


def results_table(plan: DataFrame, attempts: DataFrame, receipts: DataFrame) -> DataFrame:
    """(task, status, files, sha256) for every planned task: the hash over its latest attempt's sealed files, if complete.

    attempts: task, seq, directory, status; receipts: directory, path, sha256.
    """
    last = latest_attempts(attempts, "task", F.col("seq"), "directory", "status")
    sealed = receipts.groupBy("directory").agg(F.count("*").alias("files"), F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "path", "sha256"))), "\n"), 256).alias("sha256"))
    rows = plan.select("task").join(last, "task", "left").join(sealed, "directory", "left")
    done = F.col("status") == "complete"
    state = F.when(F.col("status").isNull(), "pending").when(F.col("status") == "running", "interrupted").otherwise(F.col("status"))
    return rows.select("task", state.alias("status"), F.when(done, F.coalesce("files", F.lit(0))).alias("files"), F.when(done, F.col("sha256")).alias("sha256"))
