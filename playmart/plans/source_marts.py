"""Queries of the aggregates over sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import Window
from playmart.operators import source_marts as marts
from playmart.plans.registry import query
from playmart.sources import files
from playmart.sources.testdata import Data

START = "2024-01-25 00:00:00"
TZ = "America/Sao_Paulo"
_MINE = "is_deleted = 0 AND state NOT IN (1, 4) AND product_id <> 6 AND partner_id = 180"
# the zone has had no daylight saving since 2019: UTC-3
_EDGE = """WITH mine AS (SELECT * FROM v_bets WHERE {mine}),
    touched AS (SELECT DISTINCT client_id FROM mine WHERE updated_at > TIMESTAMP '2024-01-25 00:00:00')
    SELECT client_id, CAST({pick}(bet_time) - INTERVAL 3 HOURS AS DATE) AS bet_day, arg_{pick}(bet_amount, (bet_time, id)) AS bet_amount, max(updated_at) AS updated_at
    FROM mine WHERE client_id IN (SELECT client_id FROM touched) GROUP BY client_id"""


@query(_EDGE.format(mine=_MINE, pick="min"), "v_bets")
def C1_first_bet(d: Data) -> DataFrame:
    return marts.first_bet(d.v_bets, START, 180, tz=TZ)


@query(_EDGE.format(mine=_MINE, pick="max"), "v_bets")
def C2_last_bet(d: Data) -> DataFrame:
    return marts.last_bet(d.v_bets, START, 180, tz=TZ)


_CLIENTS = """SELECT user_id AS client_id, event_id AS session, ts AS updated_at, ts - INTERVAL 30 DAYS AS created_at FROM events WHERE event_type IN ('signup', 'view')"""
_TOTALS = """SELECT b.client_id, CAST(sum(CASE WHEN bet_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS bet_qty, CAST(sum(coalesce(bet_amount, 0)) AS DECIMAL(18,2)) AS bet_total,
      CAST(sum(CASE WHEN win_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS win_qty, CAST(sum(coalesce(win_amount, 0)) AS DECIMAL(18,2)) AS win_total,
      CAST(sum(coalesce(bet_amount, 0) - coalesce(win_amount, 0)) AS DECIMAL(18,2)) AS ggr, max(b.updated_at) AS updated_at, CAST(min(c.created_at) AS DATE) AS created_day
    FROM v_bets b JOIN c ON b.client_id = c.client_id GROUP BY b.client_id"""
_NEWEST_CLIENT = f"""all_clients AS ({_CLIENTS}),
    newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY session DESC, updated_at DESC) AS rn FROM all_clients) WHERE rn = 1)"""


@query(f"WITH {_NEWEST_CLIENT}, c AS (SELECT * FROM newest WHERE updated_at > TIMESTAMP '2024-01-29 00:00:00') {_TOTALS}", "v_bets")
def C3_bet_totals(d: Data) -> DataFrame:
    return marts.bet_totals(d.v_bets, d.spark.sql(_CLIENTS.replace("FROM events", "FROM {events}"), events=d.events), "2024-01-29 00:00:00")


@query(f"WITH {_NEWEST_CLIENT}, c AS (SELECT * FROM newest WHERE client_id IN (SELECT id FROM v_user WHERE status <> 1)) {_TOTALS}", "v_bets", "v_user")
def C4_bet_totals_for_ids(d: Data) -> DataFrame:
    clients = d.spark.sql(_CLIENTS.replace("FROM events", "FROM {events}"), events=d.events)
    return marts.bet_totals_for_ids(d.v_bets, clients, d.v_user.where("status <> 1").select(F.col("id").alias("client_id")))


@query(
    f"""SELECT product_id, date_trunc('hour', bet_time - INTERVAL 3 HOURS) AS local_hour, CAST(sum(CASE WHEN bonus_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_bonus,
      CAST(sum(CASE WHEN bet_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS bet_qty, CAST(sum(CASE WHEN win_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS win_qty,
      CAST(sum(bet_amount) AS DECIMAL(18,2)) AS bet_total, CAST(sum(win_amount) AS DECIMAL(18,2)) AS win_total, CAST(sum(coalesce(bet_amount, 0) - coalesce(win_amount, 0)) AS DECIMAL(18,2)) AS ggr
    FROM v_bets WHERE {_MINE} AND updated_at > TIMESTAMP '2024-01-25 00:00:00' AND product_id IN (SELECT p_partkey FROM part WHERE p_partkey % 5 <> 0) GROUP BY 1, 2""",
    "v_bets",
)
def C5_game_hourly(d: Data) -> DataFrame:
    return marts.game_hourly(d.v_bets, d.part.select(F.col("p_partkey").alias("product_id")).where("product_id % 5 <> 0"), START, 180, TZ)


_BALANCE = """SELECT client_id, CAST(created_at - INTERVAL 3 HOURS AS DATE) AS ref_date,
      CAST(sum(CASE WHEN type_id = 1 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS in_use, CAST(sum(CASE WHEN type_id = 2 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS available,
      CAST(sum(CASE WHEN type_id = 3 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS booking, CAST(sum(CASE WHEN type_id = 12 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS bonus,
      CAST(sum(balance) AS DECIMAL(18,2)) AS total, max(synced_at) AS updated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY client_id, type_id, CAST(created_at - INTERVAL 3 HOURS AS DATE) ORDER BY synced_at DESC, event_id DESC) AS rn FROM v_balance WHERE {where})
    WHERE rn = 1 GROUP BY 1, 2"""


@query(_BALANCE.format(where="synced_at >= TIMESTAMP '2024-01-05 10:00:00' AND synced_at < TIMESTAMP '2024-01-20 03:00:00'"), "v_balance")
def C6_balance_daily(d: Data) -> DataFrame:
    return marts.balance_window(d.v_balance, Window("2024-01-05 10:00:00", "2024-01-20 03:00:00"), "changed")


STATUSES = (7, 8, 2)
_PIX = """SELECT client_id, pix_key, pix_type, CAST(count(*) AS BIGINT) AS uses
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_pix WHERE partner_id = 180 {touched})
    WHERE rn = 1 AND status IN (7, 8, 2) AND pix_key IS NOT NULL GROUP BY 1, 2, 3"""


@query(_PIX.format(touched=""), "v_pix")
def C7_pix_usage_full(d: Data) -> DataFrame:
    return marts.pix_usage_full(d.v_pix, 180, STATUSES)


@query(
    _PIX.format(
        touched="AND client_id IN (SELECT client_id FROM v_pix WHERE partner_id = 180 AND synced_at >= TIMESTAMP '2000-03-01 00:00:00' AND synced_at < TIMESTAMP '2000-03-20 00:00:00')"
    ),
    "v_pix",
)
def C8_pix_usage_incremental(d: Data) -> DataFrame:
    return marts.pix_usage_incremental(d.v_pix, 180, Window("2000-03-01 00:00:00", "2000-03-20 00:00:00"), STATUSES)


_BONUS_WINDOW = Window("1999-01-01 00:00:00", "2000-01-01 00:00:00")


@query(
    """SELECT id, client_id, bonus_id, status, awarding_time, cost FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants
      WHERE is_deleted = 0 AND synced_at >= TIMESTAMP '1999-01-01 00:00:00' AND synced_at < TIMESTAMP '2000-01-01 00:00:00') WHERE rn = 1 AND status <> 4""",
    "v_grants",
)
def C9_user_bonus(d: Data) -> DataFrame:
    return marts.user_bonus(d.v_grants, _BONUS_WINDOW, extra=F.col("status") != 4).select("id", "client_id", "bonus_id", "status", "awarding_time", "cost")


_BONUSES = "SELECT p_size AS bonus_id, p_partkey AS version, p_partkey AS synced_at, 180 + p_partkey % 2 AS partner_id, CASE WHEN p_partkey % 11 = 3 THEN 1 ELSE 0 END AS is_deleted, p_name AS name FROM part"


def _bonuses(d: Data) -> DataFrame:
    return d.spark.sql(_BONUSES.replace("FROM part", "FROM {part}"), part=d.part)


@query(
    f"""WITH b AS ({_BONUSES}) SELECT bonus_id, version, name FROM (SELECT *, row_number() OVER (PARTITION BY bonus_id ORDER BY version DESC) AS rn FROM b WHERE is_deleted = 0 AND partner_id = 180)
    WHERE rn = 1"""
)
def C10_bonus_dim(d: Data) -> DataFrame:
    return marts.bonus_dim(_bonuses(d), 180).select("bonus_id", "version", "name")


@query(
    f"""WITH b AS ({_BONUSES}), g AS (SELECT *, bonus_id * 5 + id % 5 AS bonus FROM v_grants)
    SELECT id, bonus AS bonus_id, version FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM g
      WHERE is_deleted = 0 AND bonus IN (SELECT bonus_id FROM b WHERE is_deleted = 0 AND partner_id = 180)) WHERE rn = 1""",
    "v_grants",
)
def C11_bonus_product_bridge(d: Data) -> DataFrame:
    bridge = d.v_grants.withColumn("bonus_id", F.col("bonus_id") * 5 + F.col("id") % 5).drop("partner_id")
    return marts.bonus_product_bridge(bridge, _bonuses(d), 180).select("id", "bonus_id", "version")


@query(
    """SELECT id, status, reuse_number FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants WHERE is_deleted = 0
      AND (synced_at >= TIMESTAMP '1998-01-01 00:00:00' AND synced_at < TIMESTAMP '1998-03-01 00:00:00' OR synced_at >= TIMESTAMP '1999-06-01 00:00:00' AND synced_at < TIMESTAMP '1999-07-01 00:00:00'))
    WHERE rn = 1""",
    "v_grants",
)
def C12_trigger_ref_patch(d: Data) -> DataFrame:
    windows = [Window("1998-01-01 00:00:00", "1998-03-01 00:00:00"), Window("1999-06-01 00:00:00", "1999-07-01 00:00:00")]
    return marts.trigger_ref_patch(d.v_grants, windows, ["status", "reuse_number"])


@query(
    """WITH n AS (SELECT max(CAST(created_at - INTERVAL 3 HOURS AS DATE)) AS newest_day FROM v_balance)
    SELECT newest_day, CAST(DATE '2024-02-01' - 1 - newest_day AS INTEGER) AS days_late, CASE WHEN DATE '2024-02-01' - 1 - newest_day <= 0 THEN 'ok' WHEN DATE '2024-02-01' - 1 - newest_day = 1 THEN 'skip' ELSE 'fail' END AS gate FROM n""",
    "v_balance",
)
def C13_freshness_gate(d: Data) -> DataFrame:
    return marts.freshness_gate(d.v_balance, "created_at", "2024-02-01")


@query(
    """WITH n AS (SELECT max(CAST(o_orderdate - INTERVAL 3 HOURS AS DATE)) AS newest_day FROM orders)
    SELECT newest_day, CAST(DATE '2001-08-02' - 1 - newest_day AS INTEGER) AS days_late, CASE WHEN DATE '2001-08-02' - 1 - newest_day <= 0 THEN 'ok' WHEN DATE '2001-08-02' - 1 - newest_day = 1 THEN 'skip' ELSE 'fail' END AS gate FROM n"""
)
def C13_freshness_gate_table(d: Data) -> DataFrame:
    return files.freshness_of_table(d.spark, f"{d.sf_dir}/orders.parquet", "o_orderdate", "2001-08-02")


@query(
    """WITH u AS (SELECT id, status FROM v_user WHERE id % 10 <> 3), c AS (SELECT user_id AS id, CAST(sum(deposit_qty) AS BIGINT) AS deposits FROM v_user_daily WHERE user_id % 10 <> 4 GROUP BY 1),
    b AS (SELECT client_id AS id, CAST(count(*) AS BIGINT) AS bets FROM v_bets GROUP BY 1)
    SELECT coalesce(u.id, c.id, b.id) AS id, status, deposits, bets FROM u FULL JOIN c ON u.id = c.id FULL JOIN b ON coalesce(u.id, c.id) = b.id""",
    "v_user", "v_user_daily", "v_bets",
)
def C14_user_assemble(d: Data) -> DataFrame:
    cash = d.v_user_daily.where("user_id % 10 <> 4").groupBy(F.col("user_id").alias("id")).agg(F.sum("deposit_qty").alias("deposits"))
    bets = d.v_bets.groupBy(F.col("client_id").alias("id")).agg(F.count("*").alias("bets"))
    return marts.user_assemble(d.v_user.where("id % 10 <> 3").select("id", "status"), cash, bets)
