"""Shared helpers of the training-data operators: scratch tables, digests, columns."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in every contract: space and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \t\n\x0B\f\r]+"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, which ``spark.checkpoint.dir`` names.

    A session on one machine (master local) may leave it unset and gets a local folder; on a
    cluster that is an error, as its machines would not see each other's tables.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share; the master is {master!r}")
    return f"file://{os.path.join(tempfile.gettempdir(), 'rasterloom-scratch')}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """What runs inside hands rows to Python this many at a time, as texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialise(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage and survives the loss of executors. The folder belongs to the
    caller's checkpoint area and is cleaned with it; ``discard`` removes a table before.
    """
    path = f"{scratch_dir(df.sparkSession)}/rasterloom-{tag}-{uuid.uuid4().hex}"
    with small_batches(df.sparkSession):
        df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``materialise`` from the shared folder, once all that reads them has been written."""
    for df in tables:
        if path := getattr(df, "_scratch", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def words_of(text: Column) -> Column:
    """Array of the maximal runs of characters outside SPACES; null text: empty array."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


#: Elements that ``sums_before`` adds up in one run.
RUN = 64


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often its result names it."""
    return F.transform(F.array(value), use)[0]


def sums_before(values: Column) -> Column:
    """Array of the sums of all elements before each one.

    Runs of RUN elements are added up by themselves and then shifted by the sums of the runs before,
    as a fold that appends to one array copies it at each step. Over the runs' sums such a fold remains,
    so the copying still grows with the square of the elements, at about 1 / RUN ** 2 of it.
    """
    def fold(xs: Column, size) -> Column:
        return F.aggregate(xs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda a, x: F.struct((a["at"] + size(x)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))

    def shifted(runs: Column) -> Column:
        heads = fold(runs, lambda r: r["at"])["out"]
        return F.flatten(F.zip_with(runs, heads, lambda r, head: F.transform(r["out"], lambda x: x + head)))

    def cut(xs: Column) -> Column:
        last = F.greatest(F.ceil(F.size(xs) / RUN).cast("int") - 1, F.lit(0))
        return bound(F.transform(F.sequence(F.lit(0), last), lambda b: fold(F.slice(xs, b * RUN + 1, F.lit(RUN)), lambda x: x)), shifted)

    return bound(values, cut)


def has_word(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES)) != ""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Ids up to which an anti join sends its rows to every executor (about 16 bytes each); beyond, Spark joins by id.
BROADCAST_IDS = 500_000


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has a column of that name already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while (name := f"__{name}").lower() in taken:
            pass
        taken.add(name.lower())
        out.append(name)
    return out


def without_texts(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose id and text's hash aren't in ``gone`` (these two columns); null ids are ids of their own."""
    g_id, g_hash = fresh(docs, "gone", "gone_hash")
    listed = materialise(gone.toDF(g_id, g_hash).distinct(), "gone")
    count = listed.count()
    if not count:
        return docs
    listed = F.broadcast(listed) if count <= BROADCAST_IDS else listed
    same = F.col(id_col).eqNullSafe(F.col(g_id)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(g_hash))
    return docs.join(listed, same, "left_anti")
