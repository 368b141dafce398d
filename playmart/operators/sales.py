"""Sales feed: valid rows, rejects and their log, stage and merge."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import ts
from playmart.operators.tables import update_then_insert


def split_valid(sales: DataFrame, as_of: datetime | str, column: str = "created_at") -> tuple[DataFrame, DataFrame]:
    """(valid, rejects): rows with a readable time, as a timestamp, and the others with reason and time."""
    read = sales.withColumn("_at", F.try_to_timestamp(F.col(column)).cast("timestamp_ntz"))
    valid = read.where("_at is not null").withColumn(column, F.col("_at")).drop("_at")
    reason = F.when(F.col(column).isNull(), "MISSING_CREATED_AT").otherwise("INVALID_CREATED_AT")
    rejects = read.where("_at is null").drop("_at").withColumns({"reason": reason, "rejected_at": ts(as_of)})
    return valid, rejects


def reject_log(log: DataFrame, rejects: DataFrame, key: str = "tx_id") -> DataFrame:
    """The log after the rejects: known ones are refreshed and counted once, new ones count one."""
    columns = [c for c in rejects.columns if c != key and c in log.columns]
    update = {c: F.col(f"new_{c}") for c in columns} | {"last_seen": F.col("new_rejected_at"), "times": F.col("old_times") + 1}
    return update_then_insert(log, rejects, [key], update, {"first_seen": F.col("new_rejected_at"), "last_seen": F.col("new_rejected_at"), "times": F.lit(1)})


def sale_stage(valid: DataFrame, as_of: datetime | str) -> DataFrame:
    return valid.withColumnRenamed("tag", "sale_tag").withColumns({"updated_at": ts(as_of), "imported_at": ts(as_of)})


def sale_upsert(sales: DataFrame, stage: DataFrame) -> DataFrame:
    """Merge on (tx_id, created_at): known sales take all of the stage, its import time too."""
    keys = ["tx_id", "created_at"]
    return update_then_insert(sales, stage, keys, {c: F.col(f"new_{c}") for c in stage.columns if c not in keys})
