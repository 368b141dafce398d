"""Queries of sources, sinks and table maintenance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.scratch import shared_path
from playmart.functions.time import minutes, ts
from playmart.operators import cdc, tables
from playmart.plans.registry import query
from playmart.sources import files
from playmart.sources.testdata import Data


@query(
    """SELECT id, updated_at, 'open' AS mode FROM v_bets WHERE updated_at > TIMESTAMP '2024-01-20 00:00:00'
    UNION ALL SELECT id, updated_at, 'both' FROM v_bets WHERE updated_at BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-11 12:00:00'
    UNION ALL SELECT id, updated_at, 'all' FROM v_bets""",
    "v_bets",
)
def A1_read_changes(d: Data) -> DataFrame:
    bets = d.v_bets.select("id", "updated_at")
    opened = files.read_changes(bets, "updated_at", "2024-01-20 00:00:00").withColumn("mode", F.lit("open"))
    both = files.read_changes(bets, "updated_at", "2024-01-10 00:00:00", "2024-01-11 12:00:00").withColumn("mode", F.lit("both"))
    return opened.union(both).union(files.read_changes(bets, "updated_at").withColumn("mode", F.lit("all")))


@query(
    """WITH ids AS (SELECT DISTINCT c_custkey * 3 AS id FROM customer)
    SELECT u.id, u.status, TRUE AS found FROM v_user u WHERE u.id IN (SELECT id FROM ids)
    UNION ALL SELECT id, NULL, FALSE FROM ids WHERE id NOT IN (SELECT id FROM v_user)""",
    "v_user",
)
def A2_read_by_ids(d: Data) -> DataFrame:
    ids = d.customer.select((F.col("c_custkey") * 3).alias("id"))
    rows, missing = files.read_by_ids(d.v_user, ids)
    return rows.select("id", "status", F.lit(True).alias("found")).unionByName(missing.select("id", F.lit(None).cast("int").alias("status"), F.lit(False).alias("found")))


@query("SELECT c_custkey AS id, c_mktsegment AS segment FROM customer")
def A3_read_csv_aux(d: Data) -> DataFrame:
    path = shared_path(d.spark, "aux")
    files.export_audit_csv(d.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), path)
    return files.read_csv_aux(d.spark, path, "id long, segment string")


_SALE_COLUMNS = ["tx_id", "created_at", "user_id", "amount", "status", "tag"]
_TIMED_SALES = "SELECT l_orderkey * 10 + l_linenumber AS tx_id, l_shipdate AS created_at, l_suppkey AS user_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_linestatus AS status, l_returnflag AS tag"


@query(
    f"""WITH s AS ({_TIMED_SALES} FROM lineitem)
    SELECT *, 'incremental' AS mode FROM s WHERE created_at >= TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 7 DAYS UNION ALL SELECT *, 'history' FROM s"""
)
def A4_read_sales_source(d: Data) -> DataFrame:
    sales = d.spark.sql(_TIMED_SALES + ", l_tax AS unused FROM {lineitem}", lineitem=d.lineitem)
    new = files.read_sales_source(sales, _SALE_COLUMNS, "incremental", "2001-06-01 00:00:00").withColumn("mode", F.lit("incremental"))
    return new.union(files.read_sales_source(sales, _SALE_COLUMNS, "history").withColumn("mode", F.lit("history")))


@query(
    """SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_discount > 0 THEN l_discount END AS discount FROM lineitem WHERE l_linenumber <= 3
    UNION ALL SELECT l_orderkey * 10 + l_linenumber, CASE WHEN l_discount > 0 THEN l_discount END FROM lineitem WHERE l_linenumber > 3"""
)
def A5_append_rows(d: Data) -> DataFrame:
    path = shared_path(d.spark, "appended")
    rows = d.lineitem.select("l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_discount") > 0, F.col("l_discount")).otherwise(float("nan")).alias("discount"))
    for part in (rows.where("l_linenumber <= 3"), rows.where("l_linenumber > 3")):
        files.append_rows(part.drop("l_linenumber"), path)
    return d.spark.read.schema("id long, discount double").parquet(path)


@query("SELECT id, version, cost FROM v_grants WHERE cost IS NULL OR cost <= 25", "v_grants")
def A6_delete_where(d: Data) -> DataFrame:
    return tables.delete_where(d.v_grants.select("id", "version", "cost"), F.col("cost") > 25)


@query("SELECT id, status, tax_number FROM v_user WHERE status = 8", "v_user")
def A7_export_audit_csv(d: Data) -> DataFrame:
    path = shared_path(d.spark, "audit")
    files.export_audit_csv(d.v_user.where("status = 8").select("id", "status", "tax_number"), path, sep=",")
    return d.spark.read.csv(path, header=True, schema="id long, status int, tax_number string")


_NEWEST = """newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants) WHERE rn = 1),
    older AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants WHERE version % 3 <> 0) WHERE rn = 1)"""


def _old_and_new(d: Data) -> tuple[DataFrame, DataFrame]:
    """Grants as loaded without a third of the versions, and the newest."""
    return cdc.latest_row(d.v_grants.where("version % 3 <> 0"), ["id"]), cdc.latest_row(d.v_grants, ["id"])


@query(
    f"""WITH {_NEWEST}, s AS (SELECT id, status, cost FROM newest WHERE status < 7)
    SELECT coalesce(t.id, s.id) AS id, t.client_id, CASE WHEN s.id IS NOT NULL THEN s.status ELSE t.status END AS status,
           CASE WHEN s.id IS NOT NULL THEN s.cost ELSE t.cost END AS cost, t.reuse_number
    FROM older t FULL JOIN s ON t.id = s.id""",
    "v_grants",
)
def A8_upsert(d: Data) -> DataFrame:
    old, new = _old_and_new(d)
    return tables.upsert(old.select("id", "client_id", "status", "cost", "reuse_number"), new.where("status < 7").select("id", "status", "cost"), ["id"])


@query("SELECT id, version FROM v_grants WHERE id IN (SELECT id FROM v_grants GROUP BY id HAVING count(*) > 1)", "v_grants")
def A9_duplicate_keys(d: Data) -> DataFrame:
    return tables.duplicate_keys(d.v_grants.select("id", "version"), ["id"])


@query(
    """WITH s AS (SELECT client_id, bonus_id, id FROM v_grants WHERE version % 5 = 0)
    SELECT t.client_id, t.bonus_id, t.id FROM v_grants t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.client_id = t.client_id AND s.bonus_id = t.bonus_id)
    UNION ALL SELECT * FROM s""",
    "v_grants",
)
def A10_replace_by_keys(d: Data) -> DataFrame:
    rows = d.v_grants.select("client_id", "bonus_id", "id")
    return tables.replace_by_keys(rows, d.v_grants.where("version % 5 = 0").select("client_id", "bonus_id", "id"), ["client_id", "bonus_id"])


def _in_partitions(d: Data, merge: Callable) -> DataFrame:
    """Grants by bonus in a partitioned folder; the source has rows of two of its partitions."""
    path = shared_path(d.spark, "by-bonus")
    rows = d.v_grants.where("client_id is not null").groupBy("client_id", "bonus_id").agg(F.max("id").alias("id"), F.max("version").alias("version"))
    rows.write.partitionBy("bonus_id").parquet(path)
    new = rows.where("bonus_id in (3, 7) and version % 5 = 0").withColumn("id", -F.col("id"))
    files.merge_partitions(path, new, ["client_id", "bonus_id"], "bonus_id", merge)
    return d.spark.read.parquet(path).withColumn("bonus_id", F.col("bonus_id").cast("long"))


_BY_BONUS = """SELECT client_id, CAST(bonus_id AS BIGINT) AS bonus_id, CASE WHEN bonus_id IN (3, 7) AND version % 5 = 0 THEN -id ELSE id END AS id, version
    FROM (SELECT client_id, bonus_id, max(id) AS id, max(version) AS version FROM v_grants WHERE client_id IS NOT NULL GROUP BY 1, 2)"""


@query(_BY_BONUS, "v_grants")
def A8_upsert_partitions(d: Data) -> DataFrame:
    return _in_partitions(d, tables.upsert)


@query(_BY_BONUS, "v_grants")
def A10_replace_partitions(d: Data) -> DataFrame:
    return _in_partitions(d, tables.replace_by_keys)


@query(
    """WITH a AS (SELECT user_id, ref_date, deposit_amount FROM v_user_daily WHERE deposit_qty > 0), b AS (SELECT user_id, ref_date, withdraw_amount FROM v_user_daily WHERE withdraw_qty > 0),
    c AS (SELECT user_id, ref_date, bet_amount, ggr FROM v_user_daily WHERE bet_qty > 0)
    SELECT coalesce(a.user_id, b.user_id, c.user_id) AS user_id, coalesce(a.ref_date, b.ref_date, c.ref_date) AS ref_date, deposit_amount, withdraw_amount, bet_amount, ggr
    FROM a FULL JOIN b ON a.user_id = b.user_id AND a.ref_date = b.ref_date
    FULL JOIN c ON coalesce(a.user_id, b.user_id) = c.user_id AND coalesce(a.ref_date, b.ref_date) = c.ref_date""",
    "v_user_daily",
)
def A11_upsert_partial(d: Data) -> DataFrame:
    days, keys = d.v_user_daily, ["user_id", "ref_date"]
    empty = days.select(*keys, "deposit_amount", "withdraw_amount", "bet_amount", "ggr").limit(0)
    narrow = [
        days.where("deposit_qty > 0").select(*keys, "deposit_amount"),
        days.where("withdraw_qty > 0").select(*keys, "withdraw_amount"),
        days.where("bet_qty > 0").select(*keys, "bet_amount", "ggr"),
    ]
    return tables.upsert_partial(empty, [(s, keys) for s in narrow])


@query(
    f"""WITH {_NEWEST}
    SELECT coalesce(t.id, s.id) AS id, CASE WHEN t.id IS NULL THEN s.status WHEN s.id IS NULL THEN t.status ELSE greatest(t.status, s.status) END AS status,
           CASE WHEN t.id IS NULL THEN 1 WHEN s.id IS NULL THEN t.reuse_number ELSE t.reuse_number + 1 END AS reuse_number
    FROM older t FULL JOIN (SELECT * FROM newest WHERE reuse_number > 20) s ON t.id = s.id""",
    "v_grants",
)
def A12_update_then_insert(d: Data) -> DataFrame:
    old, new = _old_and_new(d)
    return tables.update_then_insert(
        old.select("id", "status", "reuse_number"),
        new.where("reuse_number > 20").select("id", "status"),
        ["id"],
        {"status": F.greatest("old_status", "new_status"), "reuse_number": F.col("old_reuse_number") + 1},
        {"reuse_number": F.lit(1)},
    )


@query(
    f"""WITH {_NEWEST}
    SELECT t.id, t.client_id, CASE WHEN s.id IS NOT NULL THEN s.awarding_time ELSE t.awarding_time END AS awarding_time
    FROM older t LEFT JOIN (SELECT * FROM newest WHERE status >= 3) s ON t.id = s.id""",
    "v_grants",
)
def A13_update_only(d: Data) -> DataFrame:
    old, new = _old_and_new(d)
    return tables.update_only(old.select("id", "client_id", "awarding_time"), new.where("status >= 3"), ["id"], ["awarding_time"])


def _run_events(d: Data) -> DataFrame:
    """A start for most bets, a close for two of three; some closes come without a start."""
    bets = d.v_bets.select(
        F.concat(F.lit("tenant"), (F.col("id") % 2).cast("string")).alias("tenant"), F.concat(F.lit("job"), F.col("product_id").cast("string")).alias("operation"),
        F.col("bet_time").alias("start_time"), "id", "state",
    )
    none = F.lit(None)
    starts = bets.where("id % 10 <> 0").select("tenant", "operation", "start_time", F.lit(1).alias("event_order"), F.lit("RUNNING").alias("status"), none.cast("timestamp_ntz").alias("ended_at"), none.cast("string").alias("error"))
    status = F.when(F.col("state") == 0, "FAILED").when(F.col("state") == 1, "SKIPPED").otherwise("SUCCESS")
    closes = bets.where("id % 3 <> 0").select(
        "tenant", "operation", "start_time", F.lit(2), status, F.col("start_time") + minutes(7), F.when(F.col("state") == 0, F.repeat(F.lit("error "), 11_000))
    )
    return starts.union(closes)


@query(
    """SELECT 'tenant' || CAST(id % 2 AS VARCHAR) AS tenant, 'job' || CAST(product_id AS VARCHAR) AS operation, bet_time AS start_time,
           CASE WHEN id % 3 <> 0 THEN bet_time + INTERVAL 7 MINUTES END AS ended_at,
           CASE WHEN id % 3 = 0 THEN 'RUNNING' WHEN state = 0 THEN 'FAILED' WHEN state = 1 THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
           CASE WHEN id % 3 <> 0 THEN CAST(420 AS DECIMAL(12,2)) END AS duration_seconds,
           CASE WHEN id % 3 <> 0 AND state = 0 THEN substr(repeat('error ', 11000), 1, 60000) END AS error,
           id % 3 = 0 AND bet_time < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 MINUTES AS is_stale
    FROM v_bets WHERE id % 10 <> 0 OR id % 3 <> 0""",
    "v_bets",
)
def A14_run_history(d: Data) -> DataFrame:
    return tables.run_history(_run_events(d), "2024-01-31 00:00:00")


@query(
    """SELECT min(m) - INTERVAL 4 HOURS AS start FROM (SELECT max(updated_at) AS m FROM v_bets UNION ALL SELECT max(synced_at) FROM v_grants
    UNION ALL SELECT max(synced_at) FROM v_balance WHERE type_id = 1000)""",
    "v_bets", "v_grants", "v_balance",
)
def A15_low_cursor(d: Data) -> DataFrame:
    named = lambda df, c: df.select(F.col(c).alias("updated_at"))
    return tables.low_cursor({"bets": named(d.v_bets, "updated_at"), "grants": named(d.v_grants, "synced_at"), "none": named(d.v_balance.where("type_id = 1000"), "synced_at")})


@query("SELECT least((SELECT max(ts) FROM events), (SELECT max(l_shipdate) FROM lineitem), (SELECT max(o_orderdate) FROM orders)) - INTERVAL 4 HOURS AS start")
def A15_low_cursor_tables(d: Data) -> DataFrame:
    times = {"events": "ts", "lineitem": "l_shipdate", "orders": "o_orderdate"}
    low = files.low_cursor_of_tables(d.spark, [(f"{d.sf_dir}/{t}.parquet", c) for t, c in times.items()])
    return d.spark.range(1).select(ts(low).alias("start"))


@query("SELECT id, bet_time, bet_amount FROM v_bets WHERE CAST(bet_time AS DATE) IN (DATE '2024-01-03', DATE '2024-01-17')", "v_bets")
def A16_read_by_event_days(d: Data) -> DataFrame:
    return files.read_by_event_days(d.v_bets.select("id", "bet_time", "bet_amount"), "bet_time", ["2024-01-03", "2024-01-17"])


@query("SELECT client_id, CAST(count(*) AS BIGINT) AS grants FROM v_grants WHERE status IN (6, 8) GROUP BY client_id", "v_grants")
def A17_read_query(d: Data) -> DataFrame:
    return files.read_query(d.spark, "SELECT client_id, count(*) AS grants FROM {grants} WHERE status IN (6, 8) GROUP BY client_id", grants=d.v_grants)
