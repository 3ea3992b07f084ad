"""Batch state over events: a user is a task, an event an attempt in the order of (ts, event_id)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import batch, validate
from ..streaming import telemetry
from ._register import query, table

#: The attempt state that each type of event stands for.
STATE = {"signup": "running", "view": "failed", "click": "complete", "purchase": "complete", "error": "cancelled"}
_SQL_STATE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE.items()) + " END"


def attempts(spark, sf_dir):
    state = F.element_at(F.create_map(*[F.lit(x) for kv in STATE.items() for x in kv]), F.col("event_type"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("task"), state.alias("state"), F.struct("ts", "event_id").alias("seq"), F.col("value"))


_LAST = f"a AS (SELECT user_id AS task, arg_max({_SQL_STATE}, (ts, event_id)) AS state, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1)"
_STATUS = "CASE WHEN state IS NULL THEN 'pending' WHEN state = 'running' THEN 'interrupted' WHEN state = 'complete' AND NOT (value >= 20) THEN 'invalid' ELSE state END"


@query(f"WITH {_LAST} SELECT c_custkey AS task, {_STATUS} AS status FROM customer LEFT JOIN a ON c_custkey = task")
def latest_attempt_status(spark, sf_dir):
    plan = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("task"))
    last = batch.latest_attempts(attempts(spark, sf_dir), "task", F.col("seq"), "state", "value")
    bad = (F.col("state") == "complete") & (F.col("value") < 20)  # complete, but its output can't be verified
    last = last.withColumn("state", F.when(bad, "invalid").otherwise(F.col("state"))).withColumn("seq", F.lit(0))
    return batch.planned_status(plan, last, "task", F.col("seq"), "state")


@query(f"WITH {_LAST} SELECT count(*) AS planned, count(*) FILTER (({_STATUS}) = 'complete') AS included FROM customer LEFT JOIN a ON c_custkey = task")
def batch_summary(spark, sf_dir):
    return batch.summary(latest_attempt_status(spark, sf_dir))


@query(f"""WITH a AS (SELECT user_id AS task, count(*) AS attempts, count(*) FILTER ({_SQL_STATE} = 'complete') AS completed, arg_max({_SQL_STATE}, (ts, event_id)) AS raw FROM events GROUP BY 1)
SELECT task, attempts, completed, CASE WHEN raw = 'running' THEN 'interrupted' ELSE raw END AS last_status,
  CASE raw WHEN 'complete' THEN 'skip' WHEN 'cancelled' THEN 'stop' ELSE 'retry' END AS action FROM a""")
def attempt_state_fold(spark, sf_dir):
    return batch.fold_attempts(attempts(spark, sf_dir), "task", "seq", "state")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type AS phase, count(*) AS n, round(sum(value), 6) AS seconds FROM events GROUP BY 1, 2""")
def X_tumbling_telemetry(spark, sf_dir):
    """Extension: hourly sums by phase, by the same transformation that the stream uses."""
    return telemetry.tumbling(telemetry.as_telemetry(table(spark, sf_dir, "events")), "1 hour").withColumn("seconds", F.round("seconds", 6))


@query("""WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id AS task, min(ts) AS session_start, count(*) AS n, round(sum(value), 6) AS seconds FROM s GROUP BY user_id, k""")
def X_session_telemetry(spark, sf_dir):
    """Extension: sessions of a task, ended by half an hour without an event."""
    return telemetry.sessions(telemetry.as_telemetry(table(spark, sf_dir, "events")), "30 minutes").withColumn("seconds", F.round("seconds", 6))


@query("""WITH a AS (SELECT 'task-' || user_id AS task, event_id, CASE WHEN event_id % 7 = 0 THEN 'lost' WHEN event_id % 5 = 0 THEN 'running' ELSE 'complete' END AS status FROM events)
SELECT status, count(*) AS n FROM (SELECT task, CASE WHEN status = 'lost' THEN 'status' END AS status FROM a) WHERE status IS NOT NULL GROUP BY 1""")
def journal_problem_counts(spark, sf_dir):
    k = F.col("event_id")
    attempts = table(spark, sf_dir, "events").select(
        F.concat(F.lit("task-"), F.col("user_id").cast("string")).alias("task"), F.lit("attempt-00000000-0000-0000-0000-000000000000").alias("directory"),
        F.when(k % 7 == 0, "lost").when(k % 5 == 0, "running").otherwise("complete").alias("status"))
    found = validate.journal_problems(attempts, attempts.select("task").distinct())
    return found.groupBy(F.col("problem").alias("status")).agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT o_orderkey AS run, CASE WHEN o_orderkey % 7 = 1 THEN 'manifest_changed' WHEN o_orderkey % 5 = 2 THEN 'roi_differs' WHEN o_orderstatus <> 'F' THEN 'not_complete' WHEN o_orderkey % 11 = 3 THEN 'file_name' WHEN o_orderkey % 13 = 4 THEN 'size' END AS problem FROM orders)
SELECT coalesce(problem, 'fits') AS problem, count(*) AS n FROM f GROUP BY 1""")
def figure_association(spark, sf_dir):
    k, lit = F.col("o_orderkey"), F.lit
    figures = table(spark, sf_dir, "orders").select(
        k.alias("run"), lit("a").alias("manifest_sha256"), F.when(k % 7 == 1, "b").otherwise("a").alias("found_manifest_sha256"), lit("r").alias("roi_sha256"), lit("r").alias("found_roi_sha256"),
        F.when(k % 5 == 2, "x").otherwise("roi").alias("roi"), lit("i").alias("image"), lit(0).alias("z"), lit(0).alias("t"), F.when(F.col("o_orderstatus") == "F", "complete").otherwise("open").alias("status"),
        F.when(k % 11 == 3, "../figure.png").otherwise("001-mask-3-figure.png").alias("file"), lit("p").alias("file_sha256"), lit("p").alias("found_file_sha256"), F.when(k % 13 == 4, 9000).otherwise(800).alias("width"), lit(1000).alias("height"))
    own = figures.select("run", lit("roi").alias("run_roi"), lit("i").alias("run_image"), lit(0).alias("run_z"), lit(0).alias("run_t"))
    return validate.figure_problems(figures, own).groupBy(F.coalesce("problem", lit("fits")).alias("problem")).agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id AS task, max(event_id) AS seq, arg_max(event_type, event_id) AS kind FROM events GROUP BY 1)
SELECT CAST(c_custkey AS BIGINT) AS task, CASE WHEN kind IS NULL THEN 'pending' WHEN kind = 'click' THEN 'interrupted' WHEN kind = 'purchase' THEN 'failed' ELSE 'complete' END AS status,
  CASE WHEN kind IS NOT NULL AND kind NOT IN ('click', 'purchase') THEN CAST(2 AS BIGINT) END AS files, CASE WHEN kind IS NOT NULL AND kind NOT IN ('click', 'purchase') THEN sha256('a:' || sha256(CAST(seq AS VARCHAR)) || chr(10) || 'b:' || sha256('')) END AS sha256
FROM customer LEFT JOIN e ON c_custkey = e.task""")
def batch_results_hashes(spark, sf_dir):
    """Status and seal of every planned task."""
    kind = F.when(F.col("event_type") == "click", "running").when(F.col("event_type") == "purchase", "failed").otherwise("complete")
    attempts = table(spark, sf_dir, "events").select(F.col("user_id").alias("task"), F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("directory"), kind.alias("status"))
    both = F.array(F.struct(F.lit("a").alias("path"), F.sha2("directory", 256).alias("sha256")), F.struct(F.lit("b").alias("path"), F.sha2(F.lit(""), 256).alias("sha256")))
    receipts = attempts.select("directory", F.explode(both).alias("f")).select("directory", "f.*")
    return batch.results_table(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("task")), attempts, receipts)
