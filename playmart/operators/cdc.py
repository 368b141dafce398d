"""Versions of change-data-capture rows: three rules for "latest", tombstones, and the keys a change touches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playmart.functions.time import Window, local_day


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ("version", "synced_at")) -> DataFrame:
    """The newest row of every key, by the order columns downwards; nulls in it count as found."""
    down = [F.desc(c) if isinstance(c, str) else c for c in order]
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*down))).where("_rn = 1").drop("_rn")


def latest_by_column(df: DataFrame, keys: Sequence[str], columns: Sequence[str], version: str = "version") -> DataFrame:
    """Per key and column the newest value that is not null."""
    return df.groupBy(*keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in columns))


def drop_deleted(df: DataFrame, keys: Sequence[str], when: str = "before") -> DataFrame:
    """Newest rows without tombstones: `before`, an older living version comes back; `after`, the key is gone."""
    living = F.col("is_deleted") == 0
    if when == "before":
        return latest_row(df.where(living), keys)
    if when == "after":
        return latest_row(df, keys).where(living)
    raise ValueError(when)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the newest by an order of one's own."""
    return latest_row(df, keys, order)


def dedup_stage(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One of the identical rows of a key that inclusive window edges leave."""
    return df.dropDuplicates(list(keys))


def latest_per_bucket(df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str | Column], offset_hours: int = -3) -> DataFrame:
    """The newest row of every key and local day."""
    return latest_row(df.withColumn("local_day", local_day(time, offset_hours)), [*keys, "local_day"], order)


def impacted_keys(df: DataFrame, key: str, column: str, window: Window) -> DataFrame:
    """The keys that changed in the window; what follows recomputes their full history."""
    return df.where(window.holds(column)).select(key).where(F.col(key).isNotNull()).distinct()


def impacted_union(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """The ids of several frames, as long, once each; frames without the column are skipped."""
    parts = [f.select(F.col(column).cast("long").alias(column)) for f in frames if column in f.columns]
    if not parts:
        raise ValueError(f"no frame has {column}")
    return reduce(DataFrame.unionByName, parts).where(F.col(column).isNotNull()).distinct()
