"""Merging, replacing, updating and deleting rows; run history and cursors."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions.time import hours, minutes, ts


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return df.withColumn("_n", F.count("*").over(W.partitionBy(*keys))).where("_n > 1").drop("_n")


def _checked(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fails while it runs if a key without nulls occurs more than once."""
    whole = F.lit(True)
    for k in keys:
        whole &= F.col(k).isNotNull()
    twice = whole & (F.count("*").over(W.partitionBy(*keys)) > 1)
    return source.withColumn("_new", F.when(twice, F.raise_error(F.lit("several source rows for one key"))).otherwise(F.lit(True)).cast("boolean"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], strict: bool = True) -> DataFrame:
    """Matched rows take all columns of the source and keep their others; unmatched source rows are inserted."""
    s = _checked(source, keys) if strict else source.withColumn("_new", F.lit(True))
    s = s.select(*keys, "_new", *(F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys))
    both = target.join(s, list(keys), "full_outer")
    return both.select(*(F.when(F.col("_new"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in source.columns and c not in keys else F.col(c) for c in target.columns))


def upsert_partial(target: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One wide table from narrow sources, merged one after another; each touches its own columns."""
    for source, keys in sources:
        target = upsert(target, source, keys)
    return target


def replace_by_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows of every key in the source go; all source rows come."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").select(target.columns).unionByName(source, allowMissingColumns=True)


def update_then_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Mapping[str, Column], insert: Mapping[str, Column] | None = None) -> DataFrame:
    """Matched rows take the `update` expressions, unmatched source rows come in by `insert`.

    Of several source rows of a matched key the first in order of their columns counts. Expressions see the target's columns as old_<name> and the source's as new_<name>.
    """
    t = target.select(*keys, F.lit(True).alias("_old"), *(F.col(c).alias(f"old_{c}") for c in target.columns))
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*([c for c in source.columns if c not in keys] or [F.lit(0)])))
    s = source.select(*keys, F.lit(True).alias("_new"), nth.alias("_nth"), *(F.col(c).alias(f"new_{c}") for c in source.columns))
    both, out, insert = t.join(s, list(keys), "full_outer"), [], insert or {}
    both = both.where("_old is null or _nth is null or _nth = 1")
    for c in target.columns:
        kind = target.schema[c].dataType
        fresh = insert.get(c, F.col(f"new_{c}") if c in source.columns else F.lit(None))
        out.append(
            F.col(c) if c in keys else F.when(F.col("_old") & F.col("_new"), update.get(c, F.col(f"old_{c}"))).when(F.col("_old"), F.col(f"old_{c}")).otherwise(fresh).cast(kind).alias(c)
        )
    return both.select(*out)


def update_only(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Matched rows take the columns, nulls too; nothing is inserted. One row per key of the source counts."""
    s = source.dropDuplicates(list(keys)).select(*keys, F.lit(True).alias("_new"), *(F.col(c).alias(f"_s_{c}") for c in columns))
    both = target.join(s, list(keys), "left")
    return both.select(*(F.when(F.col("_new"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns))


def delete_where(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """The rows that a delete leaves; without a predicate, none."""
    return df.limit(0) if predicate is None else df.where(~F.coalesce(predicate, F.lit(False)))


def run_history(events: DataFrame, as_of: datetime | str, stale_minutes: int = 30, error_length: int = 60_000) -> DataFrame:
    """One row per (tenant, operation, start_time) from start and close events.

    `events`: tenant, operation, start_time, event_order, status, ended_at, error. The newest event decides the
    status; a run without a close is RUNNING, and stale after `stale_minutes`.
    Error texts are long and much alike, so they are cut and packed before they are sorted and shuffled.
    """
    newest = F.max_by(F.struct("status", "ended_at", "error"), "event_order").alias("e")
    texts = events.withColumn("error", F.substring("error", 1, error_length))
    runs = _packed(texts, "error").groupBy("tenant", "operation", "start_time").agg(newest)
    seconds = F.unix_micros(F.col("e.ended_at").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))
    runs = runs.select(
        "tenant",
        "operation",
        "start_time",
        F.col("e.ended_at").alias("ended_at"),
        F.col("e.status").alias("status"),
        F.round(seconds.cast("decimal(24,0)") / 1_000_000, 2).cast("decimal(12,2)").alias("duration_seconds"),
        F.col("e.error").alias("error"),
        ((F.col("e.status") == "RUNNING") & (F.col("start_time") < ts(as_of) - minutes(stale_minutes))).alias("is_stale"),
    )
    return _unpacked(runs, "error")


#: Texts that are packed, or unpacked into one Arrow batch, at once.
PACKED_ROWS = 256


def _texts(df: DataFrame, column: str, kind: str, f: Callable[[bytes], bytes]) -> DataFrame:
    """`column` with a function of its bytes, as `kind`, in small Arrow batches."""
    at, arrow = df.columns.index(column), pa.binary() if kind == "binary" else pa.string()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, PACKED_ROWS):
                part = batch.slice(k, PACKED_ROWS)
                values = pa.array([None if v is None else f(v) for v in part.column(at).cast(pa.binary()).to_pylist()], pa.binary()).cast(arrow)
                yield part.set_column(at, pa.field(column, arrow), values)

    schema = T.StructType([T.StructField(x.name, T.BinaryType() if kind == "binary" else T.StringType()) if x.name == column else x for x in df.schema])
    return df.mapInArrow(each, schema)


def _packed(df: DataFrame, column: str) -> DataFrame:
    return _texts(df, column, "binary", lambda v: zlib.compress(v, 1))


def _unpacked(df: DataFrame, column: str) -> DataFrame:
    return _texts(df, column, "string", zlib.decompress)


def low_cursor(tables: Mapping[str, DataFrame], column: str = "updated_at", overlap_hours: int = 4) -> DataFrame:
    """One row: the smallest of the tables' newest times, less the overlap; empty tables do not count, only empty ones fail."""
    newest = None
    for df in tables.values():
        one = df.agg(F.max(column).alias("newest"))
        newest = one if newest is None else newest.union(one)
    low = F.min("newest")
    return newest.agg(F.when(low.isNull(), F.raise_error(F.lit("all tables are empty")).cast("timestamp_ntz")).otherwise(low - hours(overlap_hours)).alias("start"))
