"""Rendezvous hashing of record keys over weighted shards, with gapless places inside each shard. Native.

Defined cases: a null key is a key of its own; a null text has no bytes; repeated rows get the same shard and places
of their own; an empty table gives an empty result; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import cut, read, unit_hash

SHARDS = 40
#: Sub-ranges of a shard that are numbered apart: no task ever holds a whole shard.
BUCKETS = 256


def best_shard(key: Column, weights: list[float], first: int = 0) -> Column:
    """struct(score, shard) of the winner among shards first, first + 1, ...: score = weight / -ln(hash(key, shard)).

    A key's scores of old shards do not depend on new ones, so a new shard takes keys only into itself.
    """
    scored = F.transform(
        F.array(*[F.lit(float(w)) for w in weights]),
        lambda w, i: F.struct((w / -F.log(unit_hash(key, i + first))).alias("score"), (-(i + first)).alias("minus")),
    )
    top = F.array_max(scored)
    return F.struct(top.score.alias("score"), (-top.minus).cast("int").alias("shard"))


def assign(df: DataFrame, key: str, weights: list[float], grown_weight: float | None = None) -> DataFrame:
    """Adds `shard`, and `grown_shard` for one more shard of grown_weight."""
    df = df.withColumn("_best", best_shard(F.col(key), weights)).withColumn("shard", F.col("_best.shard"))
    if grown_weight is not None:
        extra = best_shard(F.col(key), [grown_weight], first=len(weights))
        moved = extra.score > F.col("_best.score")
        df = df.withColumn("grown_shard", F.when(moved, F.lit(len(weights))).otherwise(F.col("shard")).cast("int"))
    return df.drop("_best")


def number(df: DataFrame, group: str, order: list[str], shards: int, buckets: int = BUCKETS) -> DataFrame:
    """Adds `slot`, gapless from 0 within `group` (values 0 to shards - 1).

    Rows are numbered within hashed sub-ranges; the offsets are shards x buckets rows, whatever the input, so they
    can be broadcast.
    """
    df = df.withColumn("_b", F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(group, "_b")
        .agg(F.count("*").alias("_n"))
        .select(group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    )
    place = F.row_number().over(Window.partitionBy(group, "_b").orderBy(*order))
    out = df.withColumn("_r", place).join(F.broadcast(offsets), [group, "_b"])
    return out.withColumn("slot", (F.col("_o") + F.col("_r") - 1).cast("bigint")).drop("_o", "_r", "_b")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Documents by key over equal shards: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    thin = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    thin = cut(assign(thin, "doc_id", [1.0] * shards, grown_weight=1.0))  # the texts are read once
    out = number(thin, "shard", ["doc_id", "text_crc32", "size"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op1(spark, sf_dir):
    return shard_documents(read(spark, sf_dir, "documents"))
