"""Queries of shared keys and the sales feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import ts
from playmart.operators import sales, shared_keys, source_marts
from playmart.plans.registry import query
from playmart.sources.testdata import Data

NOW = "2001-08-02 00:00:00"
_STATUSES = (7, 8, 2)
#: Usage after the older half of the versions and after all; the newest row of a payment decides.
_USAGE = """SELECT client_id, pix_key, pix_type, CAST(count(*) AS BIGINT) AS uses FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_pix WHERE partner_id = 180 {old})
    WHERE rn = 1 AND status IN (7, 8, 2) GROUP BY 1, 2, 3"""
_NEW, _OLD = _USAGE.format(old=""), _USAGE.format(old="AND version % 2 = 0")
_ACTIVE = """active AS (SELECT *, pix_type <> 4 OR uses > 1 AS is_active FROM usage)"""
_SHARED = "shared AS (SELECT pix_key, CAST(count(DISTINCT client_id) AS BIGINT) AS accounts FROM active WHERE is_active AND trim(pix_key) <> '' GROUP BY 1 HAVING count(DISTINCT client_id) > 1)"
_NAMES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in shared_keys.STATUS_NAMES.items())


def usage(d: Data, old: bool = False) -> DataFrame:
    rows = d.v_pix.where("version % 2 = 0") if old else d.v_pix
    return source_marts.pix_usage_full(rows, 180, _STATUSES)


def active(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_active", (F.col("pix_type") != 4) | (F.col("uses") > 1))


def _snapshot_sql(run: int, rows: str) -> str:
    return f"""SELECT CAST({run} AS BIGINT) AS run_id, a.pix_key, a.client_id, a.pix_type, s.accounts, a.uses, u.registration_date, u.status,
      coalesce(CASE u.status {_NAMES} END, 'Unknown') AS status_name, TIMESTAMP '{NOW}' AS snapshot_at
    FROM (SELECT *, pix_type <> 4 OR uses > 1 AS is_active FROM ({rows})) a
    JOIN (SELECT pix_key, CAST(count(DISTINCT client_id) AS BIGINT) AS accounts FROM ({rows}) WHERE (pix_type <> 4 OR uses > 1) AND trim(pix_key) <> '' GROUP BY 1 HAVING count(DISTINCT client_id) > 1) s
      ON a.pix_key = s.pix_key LEFT JOIN v_user u ON a.client_id = u.id WHERE a.is_active"""


@query(f"WITH usage AS ({_NEW}), {_ACTIVE}, {_SHARED} SELECT * FROM shared", "v_pix")
def H1_shared_keys(d: Data) -> DataFrame:
    return shared_keys.shared_keys(active(usage(d)))


@query(_snapshot_sql(2, _NEW), "v_pix", "v_user")
def H2_shared_key_snapshot(d: Data) -> DataFrame:
    return shared_keys.shared_key_snapshot(active(usage(d)), d.v_user, 2, NOW)


def history(d: Data) -> DataFrame:
    """Two runs; some accounts had another or no status in the first."""
    first = shared_keys.shared_key_snapshot(active(usage(d, old=True)), d.v_user, 4, NOW)
    c = F.col("client_id")
    first = first.withColumn("status", F.when(c % 5 == 0, F.lit(None)).when(c % 7 == 0, 3).otherwise(F.col("status")).cast("int"))
    first = first.withColumn("status_name", shared_keys.code_name("status", shared_keys.STATUS_NAMES))
    return first.unionByName(shared_keys.shared_key_snapshot(active(usage(d)), d.v_user, 9, NOW))


@query(
    f"""WITH old AS ({_snapshot_sql(4, _OLD)}), new AS ({_snapshot_sql(9, _NEW)}),
    o AS (SELECT pix_key, client_id, max(CASE WHEN client_id % 5 = 0 OR client_id % 7 = 0 THEN 'Unknown' ELSE status_name END) AS previous_status FROM old GROUP BY 1, 2),
    n AS (SELECT pix_key, client_id, max(accounts) AS accounts, max(status_name) AS status FROM new GROUP BY 1, 2)
    SELECT n.pix_key, n.client_id, accounts, status, previous_status, CASE WHEN o.pix_key IS NULL THEN 'new' ELSE 'status changed' END AS change
    FROM n LEFT JOIN o ON n.pix_key = o.pix_key AND n.client_id = o.client_id WHERE o.pix_key IS NULL OR status <> previous_status""",
    "v_pix", "v_user",
)
def H3_shared_key_diff(d: Data) -> DataFrame:
    return shared_keys.shared_key_diff(history(d), 9, 4)


@query(f"SELECT CASE WHEN EXISTS (SELECT 1 FROM ({_snapshot_sql(4, _OLD)})) THEN CAST(4 AS BIGINT) END AS previous_run", "v_pix", "v_user")
def H4_snapshot_registry(d: Data) -> DataFrame:
    return shared_keys.previous_run(history(d), 9)


@query(
    f"""WITH old AS ({_OLD}), new AS ({_NEW}), scope AS (SELECT DISTINCT client_id FROM v_pix WHERE client_id % 3 <> 0), recomputed AS (SELECT * FROM new WHERE client_id % 3 <> 0 AND uses % 5 <> 3)
    SELECT coalesce(o.client_id, n.client_id) AS client_id, coalesce(o.pix_key, n.pix_key) AS pix_key, coalesce(o.pix_type, n.pix_type) AS pix_type, coalesce(n.uses, o.uses) AS uses,
      CASE WHEN n.client_id IS NOT NULL THEN TRUE WHEN o.client_id % 3 <> 0 THEN FALSE ELSE o.pix_type <> 4 OR o.uses > 1 END AS is_active,
      CASE WHEN n.client_id IS NOT NULL THEN NULL WHEN o.client_id % 3 <> 0 AND (o.pix_type <> 4 OR o.uses > 1) THEN TIMESTAMP '{NOW}' WHEN NOT (o.pix_type <> 4 OR o.uses > 1) THEN TIMESTAMP '2000-01-01 00:00:00' END AS deleted_at,
      CASE WHEN n.client_id IS NOT NULL OR o.client_id % 3 <> 0 AND (o.pix_type <> 4 OR o.uses > 1) THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '2000-01-01 00:00:00' END AS updated_at
    FROM old o FULL JOIN recomputed n ON o.client_id = n.client_id AND o.pix_key = n.pix_key AND o.pix_type = n.pix_type""",
    "v_pix",
)
def H5_soft_delete_sync(d: Data) -> DataFrame:
    then = ts("2000-01-01 00:00:00")
    held = active(usage(d, old=True)).withColumns({"deleted_at": F.when(~F.col("is_active"), then), "updated_at": then})
    recomputed = usage(d).where("client_id % 3 <> 0 and uses % 5 <> 3")
    return shared_keys.soft_delete_sync(held, recomputed, d.v_pix.where("client_id % 3 <> 0").select("client_id"), NOW)


_TIME = "TRY_CAST(created_at AS TIMESTAMP)"
_REASON = "CASE WHEN created_at IS NULL THEN 'MISSING_CREATED_AT' ELSE 'INVALID_CREATED_AT' END"


@query(
    f"""SELECT tx_id, line, {_TIME} AS at, NULL AS reason FROM v_sales WHERE {_TIME} IS NOT NULL UNION ALL SELECT tx_id, line, NULL, {_REASON} FROM v_sales WHERE {_TIME} IS NULL""",
    "v_sales",
)
def I1_split_valid(d: Data) -> DataFrame:
    valid, rejects = sales.split_valid(d.v_sales, NOW)
    return valid.select("tx_id", "line", F.col("created_at").alias("at"), F.lit(None).cast("string").alias("reason")).union(
        rejects.select("tx_id", "line", F.lit(None).cast("timestamp_ntz"), "reason")
    )


_REJECTS = f"rejects AS (SELECT tx_id, max(amount) AS amount, max({_REASON}) AS reason FROM v_sales WHERE {_TIME} IS NULL GROUP BY tx_id)"


@query(
    f"""WITH {_REJECTS}, log AS (SELECT tx_id, CAST(0 AS DECIMAL(18,2)) AS amount, 'OLD' AS reason, TIMESTAMP '2001-01-01 00:00:00' AS first_seen, TIMESTAMP '2001-01-01 00:00:00' AS last_seen, 4 AS times
      FROM rejects WHERE tx_id % 2 = 0 UNION ALL SELECT -1, 0, 'OLD', TIMESTAMP '2001-01-01 00:00:00', TIMESTAMP '2001-01-01 00:00:00', 4)
    SELECT coalesce(l.tx_id, r.tx_id) AS tx_id, CASE WHEN r.tx_id IS NULL THEN l.amount ELSE r.amount END AS amount, coalesce(r.reason, l.reason) AS reason,
      coalesce(l.first_seen, TIMESTAMP '{NOW}') AS first_seen, CASE WHEN r.tx_id IS NULL THEN l.last_seen ELSE TIMESTAMP '{NOW}' END AS last_seen,
      CASE WHEN l.tx_id IS NULL THEN 1 WHEN r.tx_id IS NULL THEN l.times ELSE l.times + 1 END AS times
    FROM log l FULL JOIN rejects r ON l.tx_id = r.tx_id""",
    "v_sales",
)
def I2_reject_log(d: Data) -> DataFrame:
    _, rejects = sales.split_valid(d.v_sales, NOW)
    one = rejects.groupBy("tx_id").agg(F.max("amount").alias("amount"), F.max("reason").alias("reason"), F.max("rejected_at").alias("rejected_at"))
    then = ts("2001-01-01 00:00:00")
    ids = one.where("tx_id % 2 = 0").select("tx_id").union(d.spark.range(1).select(F.lit(-1).cast("long")))
    log = ids.select("tx_id", F.lit(0).cast("decimal(18,2)").alias("amount"), F.lit("OLD").alias("reason"), then.alias("first_seen"), then.alias("last_seen"), F.lit(4).alias("times"))
    return sales.reject_log(log, one)


@query(f"SELECT tx_id, line, {_TIME} AS created_at, tag AS sale_tag, TIMESTAMP '{NOW}' AS updated_at, TIMESTAMP '{NOW}' AS imported_at FROM v_sales WHERE {_TIME} IS NOT NULL", "v_sales")
def I3_sale_stage(d: Data) -> DataFrame:
    return sales.sale_stage(sales.split_valid(d.v_sales, NOW)[0], NOW).select("tx_id", "line", "created_at", "sale_tag", "updated_at", "imported_at")


_SALES = f"SELECT tx_id, {_TIME} AS created_at, max(amount) AS amount, max(status) AS status FROM v_sales WHERE {_TIME} IS NOT NULL GROUP BY 1, 2"


@query(
    f"""WITH s AS ({_SALES})
    SELECT tx_id, created_at, CASE WHEN amount > 50000 THEN amount ELSE CAST(1 AS DECIMAL(18,2)) END AS amount, CASE WHEN amount > 50000 THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '2001-01-01 00:00:00' END AS imported_at
    FROM s WHERE tx_id % 2 = 0 OR amount > 50000""",
    "v_sales",
)
def I4_sale_upsert(d: Data) -> DataFrame:
    rows = sales.split_valid(d.v_sales, NOW)[0].groupBy("tx_id", "created_at").agg(F.max("amount").alias("amount"), F.max("status").alias("status"))
    held = rows.where("tx_id % 2 = 0").select("tx_id", "created_at", F.lit(1).cast("decimal(18,2)").alias("amount"), ts("2001-01-01 00:00:00").alias("imported_at"))
    return sales.sale_upsert(held, rows.where("amount > 50000").select("tx_id", "created_at", "amount", ts(NOW).alias("imported_at")))
