"""Queries of version handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import Window
from playmart.operators import cdc
from playmart.plans.registry import query
from playmart.sources.testdata import Data

COLUMNS = ["id", "version", "client_id", "status", "cost", "awarding_time", "is_deleted"]


@query(
    f"""SELECT {', '.join(COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants) WHERE rn = 1""",
    "v_grants",
)
def B1_latest_row(d: Data) -> DataFrame:
    return cdc.latest_row(d.v_grants, ["id"]).select(COLUMNS)


@query(
    """SELECT id, arg_max(client_id, version) AS client_id, arg_max(cost, version) AS cost, arg_max(awarding_time, version) AS awarding_time FROM v_grants GROUP BY id""",
    "v_grants",
)
def B2_latest_by_column(d: Data) -> DataFrame:
    return cdc.latest_by_column(d.v_grants, ["id"], ["client_id", "cost", "awarding_time"])


@query(
    """SELECT id, version, 'before' AS rule FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM v_grants WHERE is_deleted = 0) WHERE rn = 1
    UNION ALL SELECT id, version, 'after' FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM v_grants) WHERE rn = 1 AND is_deleted = 0""",
    "v_grants",
)
def B3_drop_deleted(d: Data) -> DataFrame:
    before, after = (cdc.drop_deleted(d.v_grants, ["id"], w).select("id", "version", F.lit(w).alias("rule")) for w in ("before", "after"))
    return before.union(after)


@query(
    "SELECT client_id, id, reuse_number FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY reuse_number DESC, version DESC, id DESC) AS rn FROM v_grants) WHERE rn = 1",
    "v_grants",
)
def B4_distinct_on(d: Data) -> DataFrame:
    return cdc.distinct_on(d.v_grants, ["client_id"], ["reuse_number", "version", "id"]).select("client_id", "id", "reuse_number")


@query("SELECT DISTINCT client_id, bonus_id FROM v_grants", "v_grants")
def B5_dedup_stage(d: Data) -> DataFrame:
    return cdc.dedup_stage(d.v_grants.select("client_id", "bonus_id"), ["client_id", "bonus_id"])


@query(
    """SELECT client_id, type_id, CAST(created_at - INTERVAL 3 HOURS AS DATE) AS local_day, balance, event_id
    FROM (SELECT *, row_number() OVER (PARTITION BY client_id, type_id, CAST(created_at - INTERVAL 3 HOURS AS DATE) ORDER BY synced_at DESC, event_id DESC) AS rn FROM v_balance) WHERE rn = 1""",
    "v_balance",
)
def B6_latest_per_bucket(d: Data) -> DataFrame:
    return cdc.latest_per_bucket(d.v_balance, ["client_id", "type_id"], "created_at", ["synced_at", "event_id"]).select("client_id", "type_id", "local_day", "balance", "event_id")


_WINDOW = Window("2000-03-01 00:00:00", "2000-04-01 00:00:00")


@query(
    """SELECT client_id, CAST(count(*) AS BIGINT) AS grants FROM v_grants WHERE client_id IN (
      SELECT client_id FROM v_grants WHERE synced_at >= TIMESTAMP '2000-03-01 00:00:00' AND synced_at < TIMESTAMP '2000-04-01 00:00:00') GROUP BY client_id""",
    "v_grants",
)
def B7_impacted_keys(d: Data) -> DataFrame:
    touched = cdc.impacted_keys(d.v_grants, "client_id", "synced_at", _WINDOW)
    return d.v_grants.join(touched, "client_id", "left_semi").groupBy("client_id").agg(F.count("*").alias("grants"))


@query(
    """SELECT client_id FROM v_grants WHERE client_id IS NOT NULL AND status = 3 UNION SELECT client_id FROM v_balance UNION SELECT client_id FROM v_pix WHERE status = 7""",
    "v_grants", "v_balance", "v_pix",
)
def B8_impacted_union(d: Data) -> DataFrame:
    return cdc.impacted_union([d.v_grants.where("status = 3"), d.v_balance, d.v_user_daily, d.v_pix.where("status = 7")], "client_id")
