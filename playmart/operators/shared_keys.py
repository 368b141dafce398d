"""Payment keys that several clients share: snapshots, their differences, and soft deletion."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import ts

KEYS = ["client_id", "pix_key", "pix_type"]
#: Names of account status codes (fixed values).
STATUS_NAMES = {
    1: "Active", 5: "Locked", 7: "Suspended", 8: "Disabled", 9: "SelfExcluded", 10: "RegulationRestricted", 11: "SystemExcluded", 12: "CentralizedExcluded", 13: "BrazilProgram",
    14: "BeneficioContinuado", 15: "RenegociacaoFies", 16: "FiesEmpreendedor",
}


def code_name(code: str | Column, names: dict[int, str], unknown: str = "Unknown") -> Column:
    c = F.col(code) if isinstance(code, str) else code
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(table[c], F.lit(unknown))


def shared_keys(usage: DataFrame) -> DataFrame:
    """Active, non-blank keys of more than one client, and how many."""
    active = usage.where(F.col("is_active") & (F.trim("pix_key") != ""))
    # one row per key and client first: a key that millions share is counted in parts
    each = active.select("pix_key", "client_id").distinct()
    return each.groupBy("pix_key").agg(F.count("client_id").alias("accounts")).where("accounts > 1")


def shared_key_snapshot(usage: DataFrame, users: DataFrame, run_id: int, as_of: datetime | str) -> DataFrame:
    """One row per shared key, client and key type, with the client's registration and status."""
    rows = usage.where("is_active").join(shared_keys(usage), "pix_key")
    u = users.select(F.col("id").alias("client_id"), "registration_date", "status")
    return rows.join(u, "client_id", "left").select(
        F.lit(run_id).cast("long").alias("run_id"), "pix_key", "client_id", "pix_type", "accounts", "uses", "registration_date", "status",
        code_name("status", STATUS_NAMES).alias("status_name"), ts(as_of).alias("snapshot_at"),
    )


def shared_key_diff(history: DataFrame, run: int, previous: int | None) -> DataFrame:
    """Keys and clients that are new in the run, or whose status has another name now, with the run's number of accounts.

    Codes without a name, and no code, have one name in common.
    """
    now = history.where(F.col("run_id") == run).groupBy("pix_key", "client_id").agg(F.max("accounts").alias("accounts"), F.max("status_name").alias("status"))
    old = history.where(F.col("run_id") == (F.lit(previous) if previous is not None else F.lit(None))).groupBy("pix_key", "client_id")
    old = old.agg(F.max("status_name").alias("previous_status"), F.lit(True).alias("_was"))
    both = now.join(old, ["pix_key", "client_id"], "left").where(F.col("_was").isNull() | (F.col("status") != F.col("previous_status")))
    return both.select("pix_key", "client_id", "accounts", "status", "previous_status", F.when(F.col("_was").isNull(), "new").otherwise("status changed").alias("change"))


def previous_run(history: DataFrame, run: int) -> DataFrame:
    """One row: the newest earlier run that left rows, else null."""
    return history.where(F.col("run_id") < run).agg(F.max("run_id").alias("previous_run"))


def soft_delete_sync(usage: DataFrame, recomputed: DataFrame, scope: DataFrame | None, as_of: datetime | str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Active rows in scope that the recomputation lacks become inactive; recomputed rows are merged as active.

    `scope`: the impacted clients (incremental), None: all.
    """
    now, none = ts(as_of), F.lit(None).cast("timestamp_ntz")
    old = usage if scope is None else usage.join(scope.select("client_id", F.lit(True).alias("_scope")).distinct(), "client_id", "left")
    inside = F.lit(True) if scope is None else F.coalesce("_scope", F.lit(False))
    new = recomputed.select(*keys, F.col("uses").alias("_uses"), F.lit(True).alias("_new"))
    both = old.withColumn("_in", inside).join(new, list(keys), "full_outer")
    gone = F.col("_new").isNull() & F.col("_in") & F.col("is_active")
    return both.select(
        *keys,
        F.coalesce("_uses", "uses").alias("uses"),
        F.when(F.col("_new"), F.lit(True)).when(gone, F.lit(False)).otherwise(F.col("is_active")).alias("is_active"),
        F.when(F.col("_new"), none).when(gone, now).otherwise(F.col("deleted_at")).alias("deleted_at"),
        F.when(F.col("_new") | gone, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )
