"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters rows into memory-sized buckets with seeded hashes: the shard comes from the row's key
alone (highest random weight over the shard numbers, so one more shard takes rows only into itself), the
bucket within the shard from key and text, so that neither copies nor a repeated key fill one bucket.
Pass two runs a seeded Fisher-Yates shuffle over each bucket and numbers its rows behind those of the
shard's earlier buckets.

Defined cases: null text has size 8 and checksum 0 and stays null; a null key hashes as a value of its
own; repeated rows take slots of their own; an empty table gives an empty
result; extra columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAW = "key"


def _weights(key: str, shards: int, seed: int) -> Column:
    # -i, so that array_max breaks ties towards the smaller shard
    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.struct(F.xxhash64(F.lit(seed), i, F.col(key)).alias("w"), (-i).alias("n")))


def shard_of(key: str, shards: int, seed: int = 0) -> Column:
    return -F.array_max(_weights(key, shards, seed))["n"]


def shuffle_into_shards(
    df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24, bucket_bytes: int = 16 * 1024 * 1024, seed: int = 20_240_229
) -> DataFrame:
    """All rows as (key, text, size, text_crc32, law, shard, slot, grown_shard, bucket), shuffled.

    `bucket_bytes` bounds the text that one bucket holds in memory, up to one row more.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    # a key's rows are in one shard, which may so be much larger than others: each has buckets by its own size
    totals = dict(map(tuple, df.groupBy(shard_of(key, shards, seed)).agg(F.sum(size)).collect()))
    buckets = [max(1, math.ceil(totals.get(k, 0) / bucket_bytes)) for k in range(shards)]
    of_shard = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("shard") + 1)
    # rows equal in key and text can stand for each other: counted and numbered anew, they spread over buckets, too
    equal = df.select(F.col(key).alias("key"), F.col(text).alias("text")).groupBy("key", "text").agg(F.count("*").alias("n"))
    every = equal.select("key", "text", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("nth"))
    scattered = every.select(
        "key",
        "text",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        shard_of("key", shards, seed).cast("int").alias("shard"),
        shard_of("key", shards + 1, seed).cast("int").alias("grown_shard"),
        F.xxhash64(F.lit(seed + 1), "key", "text", "nth").alias("drawn"),
    )
    scattered = scattered.withColumn("bucket", F.pmod("drawn", of_shard(buckets)).cast("int")).drop("drawn")
    # each bucket is a partition of its own; the permutation depends on the data and the seed alone
    number = (of_shard([sum(buckets[:k]) for k in range(shards)]) + F.col("bucket")).alias("number")
    alone = scattered.select("*", number).repartitionById(sum(buckets), "number")
    held = alone.groupBy("number").agg(
        F.shuffle(F.sort_array(F.collect_list(F.struct("key", "text", "size", "text_crc32", "grown_shard"))), F.lit(seed)).alias("rows")
    )
    counts = scattered.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(number, "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # a row for each bucket, sent to all: else the buckets may be dealt and sorted once more, depending on which side is done first
    placed = held.join(F.broadcast(starts), "number").select("shard", "bucket", "start", F.posexplode("rows").alias("at", "row"))
    return placed.select(
        F.col("row.key").alias(key),
        F.col("row.text").alias(text),
        "row.size",
        "row.text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("start") + F.col("at")).alias("slot"),
        "row.grown_shard",
        "bucket",
    )


def write_shards(df: DataFrame, path: str, **kwargs) -> None:
    """Write the shuffled rows as one folder per shard, each file in slot order."""
    out = shuffle_into_shards(df, **kwargs)
    out.repartition("shard", "bucket").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
