"""Views of the driver's tables in the shape of player-activity sources, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (tables or views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_user_daily": (
        ("orders",),
        """
        SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS ref_date,
               CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS deposit_amount,
               COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS deposit_qty,
               CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS withdraw_amount,
               COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS withdraw_qty,
               CAST(SUM(CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS bet_amount,
               COUNT(CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' THEN 1 END) AS bet_qty,
               CAST(SUM(CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS bonus_amount,
               COUNT(CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 1 END) AS bonus_qty,
               CAST(SUM(CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS ggr
        FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)""",
    ),
    "v_grants": (
        ("lineitem", "orders"),
        """
        SELECT l_orderkey * 10 + l_linenumber AS id,
               l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS version,
               l_shipdate AS synced_at,
               CASE WHEN l_partkey % 50 = 7 THEN 1 ELSE 0 END AS is_deleted,
               CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE o_custkey END AS client_id,
               l_suppkey % 10 AS bonus_id,
               180 + l_linenumber % 2 AS partner_id,
               CAST(l_quantity AS INT) % 10 AS status,
               CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS bonus_prize,
               CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS cost,
               CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS turnover_left,
               CAST(l_quantity AS INT) AS reuse_number,
               o_orderdate AS creation_time,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE l_shipdate END AS awarding_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "v_pix": (
        ("lineitem", "orders"),
        """
        SELECT l_orderkey * 10 + l_linenumber AS id,
               l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS version,
               l_shipdate AS synced_at, 0 AS is_deleted, o_custkey AS client_id, 180 + l_linenumber % 2 AS partner_id,
               'K' || CAST(l_partkey AS VARCHAR(20)) || '-' || CAST(l_suppkey % 10 AS VARCHAR(20)) || '-' || l_returnflag AS pix_key,
               l_linenumber % 4 + 1 AS pix_type, CAST(l_quantity AS INT) % 10 AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "v_user": (
        ("customer", "v_user_daily"),
        """
        SELECT c_custkey AS id, DATE '1995-01-01' + CAST(c_custkey % 365 AS INT) AS registration_date,
               CASE WHEN c_custkey % 5 = 0 OR first_deposit IS NULL THEN DATE '1970-01-01' ELSE first_deposit END AS first_deposit_date,
               CASE WHEN c_custkey % 3 = 0 OR first_withdraw IS NULL THEN DATE '1970-01-01' ELSE first_withdraw END AS first_withdraw_date,
               CASE WHEN c_custkey % 11 = 0 THEN 8 ELSE 1 END AS status,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS VARCHAR(20)) END AS tax_number,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 130 AS VARCHAR(20)) END AS phone,
               CAST(c_nationkey AS VARCHAR(20)) AS first_name, c_mktsegment AS last_name,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE DATE '1980-01-01' + CAST(c_custkey % 200 AS INT) END AS birth_date
        FROM customer LEFT JOIN (
          SELECT user_id, MIN(CASE WHEN deposit_qty > 0 THEN ref_date END) AS first_deposit,
                 MIN(CASE WHEN withdraw_qty > 0 THEN ref_date END) AS first_withdraw
          FROM v_user_daily GROUP BY user_id) f ON c_custkey = f.user_id""",
    ),
    "v_balance": (
        ("events",),
        """
        SELECT user_id AS client_id,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 12 ELSE 99 END AS type_id,
               CAST(value AS DECIMAL(18,2)) AS balance, ts AS created_at, ts AS synced_at, event_id
        FROM events""",
    ),
    "v_bets": (
        ("events",),
        """
        SELECT event_id AS id, user_id AS client_id, 180 + event_id % 2 AS partner_id, event_id % 12 AS product_id, event_id % 7 AS state,
               CAST(value AS DECIMAL(18,2)) AS bet_amount,
               CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END AS win_amount,
               CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(18,2)) END AS bonus_amount,
               ts AS bet_time, ts AS updated_at, event_id AS version, 0 AS is_deleted
        FROM events""",
    ),
    "v_sales": (
        ("lineitem",),
        """
        SELECT l_orderkey * 10 + l_linenumber AS tx_id,
               CASE WHEN l_partkey % 41 = 0 THEN 'not a date' WHEN l_partkey % 43 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR(20)) END AS created_at,
               l_suppkey AS user_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_linestatus AS status, l_returnflag AS tag, l_partkey AS line
        FROM lineitem""",
    ),
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Data:
    """The driver's tables and the views over them, as frames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        needs, sql = VIEWS[f"v_{name.removeprefix('v_')}"]
        return self.spark.sql(_named(sql, needs), **{n: getattr(self, n) for n in needs})


def _named(sql: str, needs: tuple[str, ...]) -> str:
    """FROM x and JOIN x with the frame x in the place of the name."""
    for name in needs:
        for word in ("FROM", "JOIN"):
            sql = sql.replace(f"{word} {name} ", f"{word} {{{name}}} ").replace(f"{word} {name}\n", f"{word} {{{name}}}\n")
        if sql.endswith(f"FROM {name}"):
            sql = sql[: -len(name)] + f"{{{name}}}"
    return sql


def with_views(sql: str, *views: str) -> str:
    """A statement for DuckDB, with the views that it names in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for below in VIEWS[name][0]:
            if below in VIEWS:
                need(below)
        if name not in order:
            order.append(name)

    for v in views:
        need(v)
    if not order:
        return sql
    head = ",\n".join(f"{v} AS ({VIEWS[v][1]})" for v in order)
    body = sql.strip()
    return f"WITH {head},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {head}\n{body}"
