"""The stream of attempts against the batch fold, over two runs of one checkpoint."""

from pyspark.sql import functions as F

from rasterloom.operators import batch
from rasterloom.streaming import attempts


def test_states_survive_a_restart(spark, tmp_path):
    rows = [("a", 0, "cancelled"), ("a", 3, "complete"), ("b", 1, "failed"), ("c", 2, "running"), ("a", 1, "failed"), ("b", 4, "cancelled"), ("d", 5, "complete"), ("c", 6, "running")]
    folder, seen = str(tmp_path / "in"), {}

    def keep(df, _):
        seen.update({r.task: tuple(r)[1:] for r in df.collect()})

    for part in (rows[:4], rows[4:]):
        spark.createDataFrame(part, "task string, seq long, status string").coalesce(1).write.mode("append").json(folder)
        query = attempts.states(attempts.read(spark, folder)).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()
    fold = batch.fold_attempts(spark.createDataFrame(rows, "task string, seq long, status string"), "task", "seq", "status")
    assert seen == {r.task: tuple(r)[1:] for r in fold.select("task", "attempts", "completed", F.col("last_status"), "action").collect()}
