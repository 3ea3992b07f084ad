"""Sharding by longest processing time first, with groups that stay together.

Groups are the rows of equal text. Those with at least 1/``granularity`` of a shard's mean
size are scheduled by themselves; all smaller groups are first joined, by the hash of
their key, into bundles of about that size. Both kinds are units. Units, sorted by size,
go to the least-loaded shard through a heap, on the driver: there are at most
2 * n_shards * granularity of them (20,000 with the defaults) whatever the input, so the
schedule and the lookup tables that are broadcast have that bound too. The shards' loads
end within about one small unit of each other, unless one group outweighs a whole shard.

Slots number a shard's rows without gaps: rows are dealt into buckets by the hash of the
id and a row number that is written with the row, so that rows that share an id (or have
none) are spread like others, numbered inside each bucket, and shifted by the sizes of the buckets before.

Defined cases: a null text counts as empty (size ``row_overhead``) and forms a group with
the empty ones; a null id and repeated rows get slots like any other (ties among equal
rows are arbitrary); an empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ._common import materialise


@dataclass(frozen=True)
class Sharding:
    n_shards: int = 40
    granularity: int = 250
    row_overhead: int = 16
    rows_per_bucket: int = 50_000


def lpt(units: list[tuple[int, str]], n_shards: int) -> dict[str, int]:
    """Unit key to shard: largest first (ties by key), each to the least-loaded shard (ties: lowest number)."""
    heap = [(0, s) for s in range(n_shards)]
    placed = {}
    for size, key in sorted(units, key=lambda u: (-u[0], u[1])):
        load, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def sized(docs: DataFrame, spec: Sharding, id_col: str, text_col: str) -> DataFrame:
    """Thin rows: __id, __size, __crc, the group's 64-bit key and __row. Different texts of one key only stay together."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("__id"), (F.octet_length(text) + spec.row_overhead).cast("long").alias("__size"),
                       F.crc32(text.cast("binary")).alias("__crc"), F.xxhash64(text).alias("__group"), F.monotonically_increasing_id().alias("__row"))


def assign(rows: DataFrame, spec: Sharding = Sharding()) -> DataFrame:
    """``rows`` (with __size and __group) and their __shard."""
    spark = rows.sparkSession
    groups = materialise(rows.groupBy("__group").agg(F.sum("__size").alias("__bytes")), "groups")
    total = groups.agg(F.sum("__bytes")).first()[0]
    if total is None:
        return rows.withColumn("__shard", F.lit(0))
    units = spec.n_shards * spec.granularity
    least = -(-total // units)
    small = F.pmod(F.col("__group"), F.lit(units)).cast("int")
    key = F.when(F.col("__bytes") >= least, F.concat(F.lit("g"), F.col("__group").cast("string"))).otherwise(F.concat(F.lit("b"), small.cast("string")))
    loads = groups.groupBy(key.alias("key")).agg(F.sum("__bytes").alias("size")).collect()  # at most 2 * units rows
    placed = lpt([(r["size"], r["key"]) for r in loads], spec.n_shards)
    big = spark.createDataFrame([(int(k[1:]), s) for k, s in placed.items() if k[0] == "g"],
                                T.StructType([T.StructField("__group", T.LongType()), T.StructField("__alone", T.IntegerType())]))
    bundles = spark.createDataFrame([(int(k[1:]), s) for k, s in placed.items() if k[0] == "b"],
                                    T.StructType([T.StructField("__bundle", T.IntegerType()), T.StructField("__together", T.IntegerType())]))
    out = rows.withColumn("__bundle", small).join(F.broadcast(big), "__group", "left").join(F.broadcast(bundles), "__bundle", "left")
    return out.withColumn("__shard", F.coalesce("__alone", "__together")).drop("__bundle", "__alone", "__together")


def slots(rows: DataFrame, spec: Sharding = Sharding()) -> DataFrame:
    """``rows`` (written, with __id, __row and __shard) and __slot, gapless from 0 in each shard."""
    buckets = max(8, -(-rows.count() // (spec.n_shards * spec.rows_per_bucket)))
    dealt = rows.withColumn("__bucket", F.pmod(F.xxhash64("__id", "__row", F.lit(7)), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("__shard", "__bucket").count()
    before = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__shard", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__shard", "__bucket").orderBy("__id", "__row")
    numbered = dealt.withColumn("__in", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["__shard", "__bucket"]).withColumn("__slot", F.col("__before") + F.col("__in")).drop("__bucket", "__in", "__before")


def shard_documents(docs: DataFrame, spec: Sharding = Sharding(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard; one row for each row of ``docs``."""
    thin = materialise(sized(docs, spec, id_col, text_col), "sized")
    placed = slots(assign(thin, spec), spec)
    return placed.select(F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
                         F.lit("bytes").alias("law"), F.col("__shard").cast("int").alias("shard"),
                         F.col("__slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
