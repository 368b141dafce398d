"""Queries of the streaming jobs; each equals its batch twin once all files are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.scratch import shared_path
from playmart.plans.registry import query
from playmart.sources.testdata import VIEWS, Data, _named
from playmart.streaming import jobs
from playmart.streaming.jobs import KeyedTable


def stream(d: Data, table: str) -> DataFrame:
    # as a pattern, since a table may be one file, which a stream does not take for a folder
    return d.spark.readStream.schema(getattr(d, table).schema).parquet(f"{d.sf_dir}/{table}.parque[t]")


def view_stream(d: Data, view: str) -> DataFrame:
    """A view over one table as a stream."""
    (table,), sql = VIEWS[view]
    return d.spark.sql(_named(sql, (table,)), **{table: stream(d, table)})


def collected(d: Data, found: DataFrame, keys: list[str]) -> DataFrame:
    """Run an aggregate in update mode: the newest state of every key. One that falls below a bound again is not taken back."""
    table = KeyedTable(d.spark, shared_path(d.spark, "collected"), found.schema, keys)
    return jobs.run_available(found, table, lambda held, batch: batch, "update")


@query(
    """SELECT id, version, l_suppkey, synced_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn
      FROM (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS version, l_suppkey, l_shipdate AS synced_at FROM lineitem)) WHERE rn = 1"""
)
def S1_stream_upsert(d: Data) -> DataFrame:
    rows = stream(d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS id", "l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS version", "l_suppkey", "l_shipdate AS synced_at")
    return jobs.stream_upsert(rows, KeyedTable(d.spark, shared_path(d.spark, "grants"), rows.schema, ["id"]))


@query(
    """SELECT client_id, w AS window_start, CAST(count(DISTINCT type_id) AS INTEGER) AS distinct_bonuses, CAST(count(type_id) AS BIGINT) AS value
    FROM (SELECT client_id, type_id, balance, unnest(range(12)) AS k, date_trunc('hour', created_at) - to_hours(CAST(k AS INTEGER)) AS w FROM v_balance WHERE type_id <> 99) GROUP BY 1, 2
    HAVING count(DISTINCT type_id) >= 2 AND sum(CASE WHEN type_id = 3 THEN coalesce(balance, 0) ELSE 0 END) = 0""",
    "v_balance",
)
def S2_stream_burst(d: Data) -> DataFrame:
    rows = view_stream(d, "v_balance").where("type_id <> 99")
    rows = rows.where("client_id is not null").select("client_id", "type_id", "created_at", F.when(F.col("type_id") == 3, F.col("balance")).alias("prize"))
    return jobs.run_windows(rows, shared_path(d.spark, "bursts"), "created_at", "type_id", 720, 60, 2, ["client_id"], F.col("prize"))


@query(
    """SELECT client_id, product_id, w AS window_start, CAST(count(*) AS BIGINT) AS value
    FROM (SELECT client_id, product_id, unnest(range(24)) AS k, date_trunc('hour', bet_time) - to_hours(CAST(k AS INTEGER)) AS w FROM v_bets) GROUP BY 1, 2, 3 HAVING count(*) >= 2""",
    "v_bets",
)
def S3_stream_reuse(d: Data) -> DataFrame:
    rows = view_stream(d, "v_bets").select("client_id", "product_id", "bet_time")
    found = jobs.run_windows(rows, shared_path(d.spark, "reuse"), "bet_time", "product_id", 1440, 60, 2, ["client_id", "product_id"])
    return found.select("client_id", "product_id", "window_start", "value")


@query(
    """SELECT 'balance' AS report, CAST(client_id AS VARCHAR) AS key, CAST(max(balance) AS DECIMAL(18,2)) AS ref_value, max(created_at) AS last_fired
    FROM (SELECT *, max(CAST(created_at AS DATE)) OVER (PARTITION BY client_id) AS last_day FROM v_balance WHERE type_id = 2 AND created_at IS NOT NULL)
    WHERE CAST(created_at AS DATE) = last_day GROUP BY client_id""",
    "v_balance",
)
def S4_stream_alert_gate(d: Data) -> DataFrame:
    rows = view_stream(d, "v_balance").where("type_id = 2").select("client_id", F.col("balance").alias("value"), "created_at")
    fired = jobs.stream_alert_gate(rows, "balance", ["client_id"], "created_at")
    log = jobs.append_available(fired, shared_path(d.spark, "alert-log"), shared_path(d.spark, "stream"))
    return log.groupBy("report", "key").agg(*(F.max_by(c, "times").alias(c) for c in ("ref_value", "last_fired")))


@query(
    """SELECT product_id, date_trunc('hour', bet_time) AS local_hour, CAST(sum(CASE WHEN bonus_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_bonus, CAST(sum(CASE WHEN bet_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS bet_qty,
      CAST(sum(CASE WHEN win_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS win_qty, CAST(sum(bet_amount) AS DECIMAL(18,2)) AS bet_total, CAST(sum(win_amount) AS DECIMAL(18,2)) AS win_total,
      CAST(sum(coalesce(bet_amount, 0) - coalesce(win_amount, 0)) AS DECIMAL(18,2)) AS ggr FROM v_bets GROUP BY 1, 2""",
    "v_bets",
)
def S5_stream_game_hourly(d: Data) -> DataFrame:
    return collected(d, jobs.stream_game_hourly(view_stream(d, "v_bets")), ["product_id", "local_hour"])


@query("SELECT id, version FROM v_grants WHERE synced_at - creation_time > INTERVAL 96 HOURS", "v_grants")
def S6_late_report(d: Data) -> DataFrame:
    return jobs.late_report(d.v_grants, "creation_time", "synced_at", 96).select("id", "version")
