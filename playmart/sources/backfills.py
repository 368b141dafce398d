"""A backfill as a table in windows: each is loaded once, counted while it is written, and skipped by later runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart.functions.time import Window, ts
from playmart.operators import cdc
from playmart.operators.backfill import window_plan

LOG = "window_id int, first_day date, last_day date, source_n long, target_n long, equal boolean"


def _found(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _planned(rows: DataFrame, path: str, time: str, limit: int) -> DataFrame:
    """Day and window; what the first run planned holds for all later ones."""
    plan = _found(rows.sparkSession, f"{path}/plan")
    if plan is None:
        window_plan(rows, time, limit).coalesce(1).write.mode("overwrite").parquet(f"{path}/plan")
        plan = rows.sparkSession.read.parquet(f"{path}/plan")
    return plan


def backfill_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per window that was loaded: its days, ids as counted on the way and as stored, and whether they are equal.

    A window that was loaded again has its last count.
    """
    log = _found(spark, f"{path}/log")
    if log is None:
        return spark.createDataFrame([], LOG)
    last = F.max_by(F.struct("first_day", "last_day", "source_n", "target_n", "equal"), "run").alias("w")
    return log.groupBy("window_id").agg(last).select("window_id", "w.*")


def read_backfill(spark: SparkSession, path: str) -> DataFrame:
    """Newest living rows over all loaded windows: an id with times in two windows has its newest row only."""
    return cdc.latest_row(spark.read.parquet(f"{path}/rows"), ["id"])


def run_backfill(
    grants: DataFrame, path: str, start: datetime | str, cut: datetime | str, limit: int = 900_000, time: str = "awarding_time", windows_at_once: int = 200, at_most: int | None = None,
) -> DataFrame:
    """Load [start, cut) into `path` by windows of whole days with up to `limit` rows each, and return the log.

    A window holds the newest living row per id of its own days, so it can be loaded by itself and again: a run takes the
    windows without an equal count, replaces their partitions and leaves the others alone. `windows_at_once` windows are
    one job, which reads their days only; its counts are taken while it writes and compared with those of the stored
    files. The log is written after each job: a run that breaks off loses one job's work. `at_most` ends a run after so many windows.
    Only one row per window comes to the driver. Rows without a time are `backfill_null_time`'s. Start, cut and limit
    hold for the path: another range needs another path. Later changes of loaded windows are the incremental load's.
    """
    spark = grants.sparkSession
    inside = grants.where(Window(start, cut).holds(time))
    plan = _planned(inside, path, time, limit)
    done = backfill_log(spark, path).where("equal").select("window_id")
    windows = plan.groupBy("window_id").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")).join(done, "window_id", "left_anti")
    left = windows.orderBy("window_id").limit(at_most).collect() if at_most is not None else windows.orderBy("window_id").collect()
    for k in range(0, len(left), windows_at_once):
        _load(inside, plan, path, time, [(w["window_id"], w["first_day"], w["last_day"]) for w in left[k : k + windows_at_once]])
    return backfill_log(spark, path)


def _load(inside: DataFrame, plan: DataFrame, path: str, time: str, windows: Sequence[tuple[int, date, date]]) -> None:
    spark, numbers = inside.sparkSession, [w for w, _, _ in windows]
    first, after = min(a for _, a, _ in windows), max(b for _, _, b in windows) + timedelta(1)
    days = plan.where(F.col("window_id").isin(numbers))
    rows = inside.where((F.col(time) >= ts(first)) & (F.col(time) < ts(after)) & (F.col("is_deleted") == 0))
    rows = rows.withColumn("_day", F.to_date(time)).join(F.broadcast(days.withColumnRenamed("day", "_day")), "_day").drop("_day")  # one row for each day
    # counted in the tasks that write: those count once, however often a lost executor's work before them is done again
    counted = Observation()
    newest = cdc.latest_row(rows, ["window_id", "id"]).hint("rebalance", "window_id")
    newest = newest.observe(counted, F.count(F.lit(1)).alias("all"), *(F.count_if(F.col("window_id") == n).alias(f"w{n}") for n in numbers))
    newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_id").parquet(f"{path}/rows")
    stored = _stored(spark, f"{path}/rows", numbers)
    log = [(n, a, b, counted.get.get(f"w{n}") or 0, stored.get(n, 0)) for n, a, b in windows]
    log = spark.createDataFrame([(*w, w[3] == w[4]) for w in log], LOG)
    log.withColumn("run", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/log")


def _stored(spark: SparkSession, path: str, numbers: Sequence[int]) -> dict[int, int]:
    """Rows of each window as the files say; a window without a living row has no files."""
    rows = _found(spark, path)
    if rows is None or "window_id" not in rows.columns:
        return {}
    return {r[0]: r[1] for r in rows.where(F.col("window_id").isin(list(numbers))).groupBy("window_id").agg(F.count("*")).collect()}
