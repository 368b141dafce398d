"""Reading changes, ids, days and files; appending and exporting."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType

from playmart.functions.time import Window, days, hours, ts
from playmart.operators.source_marts import freshness_gate


def read_changes(df: DataFrame, column: str, start: datetime | str | None = None, end: datetime | str | None = None) -> DataFrame:
    """All rows; those after `start`, without it; or those from `start` to `end`, with both."""
    if end is not None and start is None:
        raise ValueError("an end needs a start")
    return df.where(Window(start, end, "both" if end is not None else "neither").holds(column))


def read_by_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """The rows with one of the ids, and the ids without a row."""
    wanted = ids.select(key).distinct()
    return df.join(wanted, key, "left_semi"), wanted.join(df, key, "left_anti")


def read_csv_aux(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, sep=";", header=True, schema=schema)


def export_audit_csv(df: DataFrame, path: str, enabled: bool = True, sep: str = ";") -> None:
    if enabled:
        df.write.csv(path, sep=sep, header=True)


def read_sales_source(df: DataFrame, columns: Sequence[str], mode: str, as_of: datetime | str | None = None, created: str = "created_at") -> DataFrame:
    """`history`: all rows; `incremental`: those created in the seven days before `as_of`."""
    if mode not in ("history", "incremental"):
        raise ValueError(mode)
    chosen = df.select(*columns)
    return chosen if mode == "history" else chosen.where(F.col(created) >= ts(as_of) - days(7))


def read_sales_jdbc(
    spark: SparkSession, url: str, table: str, columns: Sequence[str], mode: str, as_of: datetime | str | None = None, created: str = "created_at",
    split: tuple[str, object, object, int] | None = None, **options: str,
) -> DataFrame:
    """The same from a relational source: columns and the bound on `created` go to the source.

    `split`: (column, lowest, highest, connections) reads ranges of a number or time at once, on as many connections.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        column, low, high, connections = split
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(connections))
    return read_sales_source(reader.load(), columns, mode, as_of, created)


def append_rows(df: DataFrame, path: str) -> None:
    """Append, with NaN of float columns as null."""
    clean = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    df.withColumns(clean).write.mode("append").parquet(path)


def read_by_event_days(df: DataFrame, time: str, wanted: Sequence[date | str], offset_hours: int = 0) -> DataFrame:
    """The rows of the chosen local days by event time, whenever they changed. The scan gets the days as bounds on `time`."""
    days_on = sorted({date.fromisoformat(str(d)[:10]) for d in wanted})
    spans: list[list[date]] = []
    for d in days_on:  # days that follow each other are one span
        if spans and d - spans[-1][1] == timedelta(1):
            spans[-1][1] = d
        else:
            spans.append([d, d])
    edge = lambda d: ts(d) - hours(offset_hours)
    inside = [(F.col(time) >= edge(first)) & (F.col(time) < edge(last + timedelta(1))) for first, last in spans]
    return df.where(reduce(Column.__or__, inside, F.lit(False)))


def merge_partitions(path: str, source: DataFrame, keys: Sequence[str], partition: str, merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]) -> None:
    """Merge (`tables.upsert`, `tables.replace_by_keys`) into a table partitioned by one of its keys.

    Only partitions that the source has rows for are read and written; those names are the one thing that the driver sees.
    """
    if partition not in keys:
        raise ValueError("a key that does not hold the partition may have rows in any")
    spark = source.sparkSession
    touched = [r[0] for r in source.select(partition).distinct().collect()]
    target = spark.read.parquet(path)
    held = target.where(reduce(Column.__or__, (F.col(partition).eqNullSafe(F.lit(v)) for v in touched), F.lit(False)))
    merged = merge(held, source, keys).select(target.columns)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def pushed_maximum(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row, `newest`: the largest number in a column of whole numbers or times (as microseconds), taken from Parquet footers.

    Spark gives maxima of numbers and days to the scan, not of times, so the column is read as its number. A file's
    columns have to be in the table's order; a row group without statistics, as one of nulls alone, fails.
    """
    whole = StructType([StructField(f.name, LongType()) if f.name == column else f for f in spark.read.parquet(path).schema])
    apart = spark.newSession()  # so that its settings are nobody else's
    apart.conf.set("spark.sql.sources.useV1SourceList", "")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return apart.read.schema(whole).parquet(path).agg(F.max(column).alias("newest"))


def newest_time(spark: SparkSession, path: str, column: str) -> datetime | None:
    """The newest time of a Parquet table's column of times without zone; none without one.

    The footers' maximum counts once a search for rows from there on, which statistics cut to the row groups that may
    hold one, finds just that time. Whatever else holds (other units, other orders of columns, no statistics), the
    column is scanned.
    """
    column_from = lambda df: df.agg(F.max(column).alias("newest")).first()["newest"]
    table = spark.read.parquet(path)
    try:
        number = pushed_maximum(spark, path, column).first()["newest"]
        claimed = None if number is None else datetime(1970, 1, 1) + timedelta(microseconds=number)
    except (Py4JJavaError, PySparkException, OverflowError):
        claimed = None
    if claimed is not None and column_from(table.where(F.col(column) >= ts(claimed))) == claimed:
        return claimed
    return column_from(table)


def low_cursor_of_tables(spark: SparkSession, tables: Sequence[tuple[str, str]], overlap_hours: int = 4) -> datetime:
    """`operators.tables.low_cursor` over (path, time column) of stored tables, by their footers: the smallest of their newest times, less the overlap."""
    newest = [t for t in (newest_time(spark, *table) for table in tables) if t is not None]
    if not newest:
        raise ValueError("all tables are empty")
    return min(newest) - timedelta(hours=overlap_hours)


def freshness_of_table(spark: SparkSession, path: str, column: str, as_of: date | str, offset_hours: int = -3) -> DataFrame:
    """`operators.source_marts.freshness_gate` over a stored table, by its footers. The newest time has the newest local day, as the offset is one for all."""
    newest = spark.createDataFrame([(newest_time(spark, path, column),)], "newest timestamp_ntz")
    return freshness_gate(newest, "newest", as_of, offset_hours)


def read_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """An ad-hoc SELECT over frames, named in braces."""
    return spark.sql(sql, **frames)
