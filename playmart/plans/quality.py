"""Queries of reconciliation, backfills and protected columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.scratch import shared_path
from playmart.functions.time import Window
from playmart.operators import activity, backfill, cdc, protect, quality, source_marts
from playmart.plans.activity import ACTIVE, METRICS_SQL
from playmart.plans.bonus import LIVE, live, live_once
from playmart.plans.registry import query
from playmart.sources.backfills import backfill_log, read_backfill, run_backfill
from playmart.sources.testdata import Data

MONEY = "decimal(18,2)"
_CASH_SQL = """SELECT CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 'deposit' ELSE 'withdraw' END AS kind, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')"""
_BETS_SQL = "SELECT o_orderkey, o_orderdate AS bet_time, CAST(o_totalprice AS DECIMAL(18,2)) AS bet_amount FROM orders WHERE o_orderstatus = 'O'"


def _sql(d: Data, text: str) -> DataFrame:
    return d.spark.sql(text.replace("FROM orders", "FROM {orders}"), orders=d.orders)


def cash(d: Data) -> DataFrame:
    return _sql(d, _CASH_SQL)


def bets(d: Data) -> DataFrame:
    return _sql(d, _BETS_SQL)


def games(d: Data) -> DataFrame:
    """The target misses some bets."""
    return bets(d).where("o_orderkey % 100 <> 0").groupBy(F.col("bet_time").alias("local_hour")).agg(F.sum("bet_amount").cast(MONEY).alias("bet_total"))


_DAILY = f"""cash AS ({_CASH_SQL}), bets AS ({_BETS_SQL}),
    c AS (SELECT day, CAST(sum(amount) FILTER (kind = 'deposit') AS DECIMAL(18,2)) AS deposits, CAST(sum(amount) FILTER (kind = 'withdraw') AS DECIMAL(18,2)) AS withdrawals FROM cash GROUP BY 1),
    u AS (SELECT ref_date AS day, CAST(sum(bet_amount) AS DECIMAL(18,2)) AS user_bets, CAST(sum(ggr) AS DECIMAL(18,2)) AS ggr FROM v_user_daily GROUP BY 1),
    g AS (SELECT CAST(bet_time AS DATE) AS day, CAST(sum(bet_amount) AS DECIMAL(18,2)) AS bets FROM bets WHERE o_orderkey % 100 <> 0 GROUP BY 1),
    b AS (SELECT CAST(bet_time AS DATE) AS day, CAST(sum(bet_amount) AS DECIMAL(18,2)) AS bets FROM bets GROUP BY 1),
    r AS (SELECT registration_date AS day, CAST(count(*) AS BIGINT) AS registrations FROM v_user GROUP BY 1),
    target AS (SELECT day, deposits, withdrawals, user_bets, ggr, bets, registrations FROM c FULL JOIN u USING (day) FULL JOIN g USING (day) FULL JOIN r USING (day)),
    source_left AS (SELECT day, bets, deposits, withdrawals, registrations FROM b LEFT JOIN c USING (day) LEFT JOIN r USING (day)),
    source_all AS (SELECT day, bets, deposits, withdrawals, registrations FROM b FULL JOIN c USING (day) FULL JOIN r USING (day))"""
_V = ("v_user_daily", "v_user")


def target(d: Data) -> DataFrame:
    return quality.target_daily_totals(cash(d), d.v_user_daily, games(d), d.v_user)


@query(f"WITH {_DAILY} SELECT * FROM target", *_V)
def J1_target_daily_totals(d: Data) -> DataFrame:
    return target(d)


def _flags(columns: str = "") -> str:
    return ", ".join(f"CASE WHEN coalesce(s.{c} <> t.{c}, TRUE) THEN 'wrong' ELSE 'right' END AS {c}_check" for c in quality.COMPARED)


_BOTH = ", ".join(f"s.{c} AS source_{c}, t.{c} AS target_{c}" for c in quality.COMPARED)


@query(f"WITH {_DAILY} SELECT s.day, {_flags()} FROM source_all s JOIN target t ON s.day = t.day", *_V)
def J2_recon_flags(d: Data) -> DataFrame:
    s = quality.source_daily_totals(bets(d), cash(d), d.v_user, "full_outer").select("day", *(F.col(c).alias(f"source_{c}") for c in quality.COMPARED))
    t = target(d).select("day", *(F.col(c).alias(f"target_{c}") for c in quality.COMPARED))
    return quality.recon_flags(s.join(t, "day")).select("day", *(f"{c}_check" for c in quality.COMPARED))


@query(f"WITH {_DAILY} SELECT coalesce(s.day, t.day) AS day, {_BOTH}, {_flags()} FROM source_left s FULL JOIN target t ON s.day = t.day", *_V)
def J3_recon_daily(d: Data) -> DataFrame:
    return quality.reconcile(quality.source_daily_totals(bets(d), cash(d), d.v_user), target(d))


_IN = "BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'"


@query(
    f"""WITH {_DAILY} SELECT coalesce(s.day, t.day) AS day, {_BOTH}, {_flags()} FROM (SELECT * FROM source_left WHERE day NOT {_IN}) s FULL JOIN (SELECT * FROM target WHERE day NOT {_IN}) t ON s.day = t.day
    UNION ALL SELECT coalesce(s.day, t.day), {_BOTH}, {_flags()} FROM (SELECT * FROM source_all WHERE day {_IN}) s FULL JOIN (SELECT * FROM target WHERE day {_IN}) t ON s.day = t.day""",
    *_V,
)
def J4_recon_period(d: Data) -> DataFrame:
    held = quality.reconcile(quality.source_daily_totals(bets(d), cash(d), d.v_user), target(d))
    return quality.recon_period(held, quality.source_daily_totals(bets(d), cash(d), d.v_user, "full_outer"), target(d), "1996-01-01", "1996-03-31")


_TWO = f"""{LIVE}, l AS (SELECT id, CAST(awarding_time AS DATE) AS d, cost AS v, synced_at AS u FROM live WHERE id % 11 <> 0),
    r AS (SELECT id, CASE WHEN id % 13 = 0 THEN CAST(awarding_time AS DATE) - 1 ELSE CAST(awarding_time AS DATE) END AS d, CASE WHEN id % 17 = 0 THEN cost + 1 ELSE cost END AS v, CASE WHEN id % 2 = 0 THEN synced_at + INTERVAL 1 HOUR ELSE synced_at END AS u FROM live WHERE id % 19 <> 0),
    again AS (SELECT id, d, v - 1 AS v, u - INTERVAL 2 HOUR AS u FROM r WHERE id % 23 = 0),
    j AS (SELECT coalesce(l.id, r.id) AS id, l.id IS NULL AS no_l, r.id IS NULL AS no_r, l.d AS ld, r.d AS rd, l.v AS lv, r.v AS rv, coalesce(r.u > l.u, FALSE) AS explained FROM l FULL JOIN r ON l.id = r.id),
    diffs AS (SELECT id, 'only_left' AS kind, explained FROM j WHERE no_r UNION ALL SELECT id, 'only_right', explained FROM j WHERE no_l
      UNION ALL SELECT id, 'date', explained FROM j WHERE NOT no_l AND NOT no_r AND ld IS DISTINCT FROM rd UNION ALL SELECT id, 'value', explained FROM j WHERE NOT no_l AND NOT no_r AND lv IS DISTINCT FROM rv)"""


def _two(d: Data) -> tuple[DataFrame, DataFrame]:
    i, at = F.col("id"), F.to_date("awarding_time")
    # read for digests, rows and repeated keys
    rows = live_once(d, "id", "awarding_time", "cost", "synced_at")
    left = rows.where("id % 11 <> 0").select("id", at.alias("d"), F.col("cost").alias("v"), F.col("synced_at").alias("u"))
    right = rows.where("id % 19 <> 0").select(
        "id", F.when(i % 13 == 0, F.date_sub(at, 1)).otherwise(at).alias("d"), F.when(i % 17 == 0, (F.col("cost") + 1).cast(MONEY)).otherwise(F.col("cost")).alias("v"),
        F.when(i % 2 == 0, F.col("synced_at") + F.make_dt_interval(F.lit(0), F.lit(1))).otherwise(F.col("synced_at")).alias("u"),
    )
    # older rows of some ids, which do not count but as repeated
    older = right.where(i % 23 == 0).select("id", "d", (F.col("v") - 1).cast(MONEY).alias("v"), (F.col("u") - F.make_dt_interval(F.lit(0), F.lit(2))).alias("u"))
    return left, right.union(older)


@query(f"WITH {_TWO} SELECT * FROM diffs", "v_grants")
def J5_compare_results(d: Data) -> DataFrame:
    return quality.compare_results(*_two(d), "id", "d", "v", "u")[0]


@query(
    f"""WITH {_TWO} SELECT kind, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (explained) AS BIGINT) AS explained FROM diffs GROUP BY 1
    UNION ALL SELECT 'repeated_left', CAST(0 AS BIGINT), CAST(0 AS BIGINT) 
    UNION ALL SELECT 'repeated_right', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT) FROM (SELECT id FROM (SELECT id FROM r UNION ALL SELECT id FROM again) GROUP BY id HAVING count(*) > 1)""",
    "v_grants",
)
def J5_compare_summary(d: Data) -> DataFrame:
    return quality.compare_results(*_two(d), "id", "d", "v", "u")[1]


WINDOWS = [("1999-01-01", "1999-03-31"), ("1999-04-01", "1999-12-31"), ("2030-01-01", "2030-01-31")]
_LABEL = "CASE WHEN CAST({c} AS DATE) BETWEEN DATE '1999-01-01' AND DATE '1999-03-31' THEN 0 WHEN CAST({c} AS DATE) BETWEEN DATE '1999-04-01' AND DATE '1999-12-31' THEN 1 END"


def _counts_sql(source: str, target: str, column: str) -> str:
    part = f"SELECT {_LABEL.format(c=column)} AS w, count(DISTINCT id) AS n FROM"
    return f"""SELECT w.w AS window_id, CAST(coalesce(s.n, 0) AS BIGINT) AS source_n, CAST(coalesce(t.n, 0) AS BIGINT) AS target_n, coalesce(s.n, 0) = coalesce(t.n, 0) AS equal
    FROM (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS w) w LEFT JOIN ({part} {source} GROUP BY 1) s ON w.w = s.w LEFT JOIN ({part} {target} GROUP BY 1) t ON w.w = t.w"""


@query(f"WITH {LIVE} {_counts_sql('v_grants WHERE is_deleted = 0', 'live WHERE id % 50 <> 1', 'awarding_time')}", "v_grants")
def J6_window_count_check(d: Data) -> DataFrame:
    return quality.window_count_check(d.v_grants, live(d).where("id % 50 <> 1"), WINDOWS)


_NEVER = "never AS (SELECT * FROM (SELECT id, arg_max(awarding_time, version) AS awarding_time, arg_max(creation_time, version) AS creation_time FROM v_grants WHERE is_deleted = 0 GROUP BY id) WHERE awarding_time IS NULL)"


@query(f"WITH {LIVE}, {_NEVER} {_counts_sql('never', 'live WHERE awarding_time IS NULL', 'creation_time')}", "v_grants")
def J7_window_count_check_null_time(d: Data) -> DataFrame:
    return quality.window_count_check_null_time(d.v_grants, live(d), WINDOWS)


_YEAR = "{c} >= TIMESTAMP '1999-01-01 00:00:00' AND {c} < TIMESTAMP '2000-01-01 00:00:00'"
YEAR = Window("1999-01-01 00:00:00", "2000-01-01 00:00:00")


@query(
    f"""WITH {LIVE}, n AS (SELECT (SELECT count(DISTINCT id) FROM v_grants WHERE is_deleted = 0 AND {_YEAR.format(c='awarding_time')}) AS source_n, (SELECT count(DISTINCT id) FROM live WHERE {_YEAR.format(c='awarding_time')}) AS target_n)
    SELECT source_n, target_n, source_n - target_n AS difference FROM n""",
    "v_grants",
)
def J8_history_total(d: Data) -> DataFrame:
    return quality.history_total(d.v_grants, live(d), YEAR)


@query(
    f"""WITH {LIVE}, s AS (SELECT CAST(awarding_time AS DATE) AS day, count(*) AS n, sum(cost) AS c FROM live WHERE awarding_time IS NOT NULL GROUP BY 1),
    t AS (SELECT CAST(awarding_time AS DATE) AS day, count(*) AS n, sum(cost) AS c FROM live WHERE awarding_time IS NOT NULL AND id % 200 <> 3 GROUP BY 1)
    SELECT coalesce(s.day, t.day) AS day, CAST(coalesce(s.n, 0) AS BIGINT) AS source_n, CAST(coalesce(t.n, 0) AS BIGINT) AS target_n, CAST(coalesce(s.c, 0) AS DECIMAL(18,2)) AS source_sum, CAST(coalesce(t.c, 0) AS DECIMAL(18,2)) AS target_sum,
      coalesce(s.n, 0) <> coalesce(t.n, 0) OR abs(coalesce(s.c, 0) - coalesce(t.c, 0)) > 0.01 AS diverges FROM s FULL JOIN t ON s.day = t.day""",
    "v_grants",
)
def J9_history_by_day(d: Data) -> DataFrame:
    rows = live(d).where("awarding_time is not null")
    return quality.history_by_day(rows, rows.where("id % 200 <> 3"), "awarding_time", "cost")


@query(
    f"""WITH m AS (SELECT DISTINCT user_id FROM v_user_daily WHERE user_id % 7 <> 0), r AS (SELECT DISTINCT user_id FROM v_user_daily WHERE {ACTIVE})
    SELECT (SELECT count(*) FROM v_user) AS users, (SELECT count(*) FROM m) AS metrics, (SELECT count(*) FROM r) AS reactivation, (SELECT count(*) FROM v_user WHERE id NOT IN (SELECT user_id FROM m)) AS without_metrics,
      (SELECT count(*) FROM v_user WHERE id NOT IN (SELECT user_id FROM r)) AS without_reactivation""",
    *_V,
)
def J10_coverage_check(d: Data) -> DataFrame:
    metrics = activity.user_metrics(d.v_user_daily)
    return quality.coverage_check(d.v_user, metrics.where("user_id % 7 <> 0"), metrics.where("last_activity is not null"))


@query("SELECT DISTINCT client_id AS id FROM v_grants WHERE client_id IS NOT NULL AND client_id NOT IN (SELECT id FROM v_user WHERE status = 1)", "v_grants", "v_user")
def J11_missing_ids(d: Data) -> DataFrame:
    source = d.v_grants.select(F.col("client_id").alias("id")).where("id is not null")
    return quality.missing_ids(source, d.v_user.where("status = 1"))


@query("WITH h AS (SELECT id FROM v_user WHERE tax_number IS NULL OR phone IS NULL OR birth_date IS NULL) SELECT id, (SELECT count(*) > 400 FROM h) AS use_backfill FROM h", "v_user", "v_user_daily")
def J12_incomplete_ids(d: Data) -> DataFrame:
    return quality.incomplete_ids(d.v_user, ["tax_number", "phone", "birth_date"], limit=400)


@query(f"SELECT CAST(awarding_time AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM v_grants WHERE {_YEAR.format(c='awarding_time')} AND partner_id = 180 GROUP BY 1", "v_grants")
def K1_daily_profile(d: Data) -> DataFrame:
    return backfill.daily_profile(d.v_grants, "awarding_time", YEAR, F.col("partner_id") == 180)


LIMIT = 500
_GREEDY = f"""RECURSIVE days AS (SELECT CAST(awarding_time AS DATE) AS day, count(*) AS n, row_number() OVER (ORDER BY CAST(awarding_time AS DATE)) AS k FROM (SELECT l_shipdate AS awarding_time FROM lineitem
        WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O') AND {_YEAR.format(c='l_shipdate')}) GROUP BY 1),
    fold AS (SELECT k, day, 0 AS window_id, n AS held FROM days WHERE k = 1 UNION ALL
      SELECT d.k, d.day, CASE WHEN f.held + d.n <= {LIMIT} THEN f.window_id ELSE f.window_id + 1 END, CASE WHEN f.held + d.n <= {LIMIT} THEN f.held + d.n ELSE d.n END FROM fold f JOIN days d ON d.k = f.k + 1)"""


@query(
    f"""WITH {_GREEDY} SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS version, CAST(window_id AS INTEGER) AS window_id
    FROM lineitem JOIN fold ON CAST(l_shipdate AS DATE) = day WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O')"""
)
def K2_volume_windows(d: Data) -> DataFrame:
    return backfill.volume_windows(d.v_grants.where(YEAR.holds("awarding_time")), "awarding_time", LIMIT).select("id", "version", "window_id")


@query("SELECT event_id FROM v_balance WHERE CAST(created_at - INTERVAL 3 HOURS AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'", "v_balance")
def K3_filter_days(d: Data) -> DataFrame:
    return backfill.filter_days(d.v_balance, "created_at", "2024-01-10 15:00:00", "2024-01-13 03:00:00").select("event_id")


@query("SELECT event_id, CAST((CAST(created_at AS DATE) - DATE '2024-01-03') // 7 AS INTEGER) AS window_id FROM v_balance WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-26'", "v_balance")
def K4_fixed_windows(d: Data) -> DataFrame:
    return backfill.fixed_windows(d.v_balance, "created_at", "2024-01-03", "2024-01-26", 7).select("event_id", "window_id")


@query("SELECT id, CAST(date_trunc('month', registration_date) AS DATE) AS month FROM v_user", "v_user", "v_user_daily")
def K5_month_windows(d: Data) -> DataFrame:
    return backfill.month_windows(d.v_user, "registration_date").select("id", "month")


@query(
    f"""SELECT id, version FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants WHERE is_deleted = 0 AND {_YEAR.format(c='awarding_time')}) WHERE rn = 1""",
    "v_grants",
)
def K6_backfill(d: Data) -> DataFrame:
    return backfill.backfill(d.v_grants, YEAR.start, YEAR.end, 5000)[0].select("id", "version")


_LIVING = """SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS version, l_shipdate AS synced_at, l_shipdate AS awarding_time FROM lineitem
    WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O') AND l_partkey % 50 <> 7"""


def _loaded(d: Data) -> str:
    """A backfill that broke off after three windows and was run again."""
    path = shared_path(d.spark, "backfill")
    run_backfill(d.v_grants, path, YEAR.start, YEAR.end, LIMIT, at_most=3)
    run_backfill(d.v_grants, path, YEAR.start, YEAR.end, LIMIT)
    return path


@query(
    f"""WITH {_GREEDY} SELECT id, version, CAST(window_id AS INTEGER) AS window_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM ({_LIVING})
      JOIN fold ON CAST(awarding_time AS DATE) = day) WHERE rn = 1"""
)
def K6_backfill_table(d: Data) -> DataFrame:
    return read_backfill(d.spark, _loaded(d)).select("id", "version", "window_id")


@query(
    f"""WITH {_GREEDY} SELECT CAST(w.window_id AS INTEGER) AS window_id, CAST(min(w.day) AS DATE) AS first_day, CAST(max(w.day) AS DATE) AS last_day, CAST(count(DISTINCT id) AS BIGINT) AS source_n, CAST(count(DISTINCT id) AS BIGINT) AS target_n, true AS equal
    FROM fold w LEFT JOIN ({_LIVING}) ON CAST(awarding_time AS DATE) = w.day GROUP BY 1"""
)
def K6_backfill_log(d: Data) -> DataFrame:
    return backfill_log(d.spark, _loaded(d))


@query(
    f"""SELECT id, version FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants WHERE is_deleted = 0 AND {_YEAR.format(c='creation_time')}) WHERE rn = 1 AND awarding_time IS NULL""",
    "v_grants",
)
def K7_backfill_null_time(d: Data) -> DataFrame:
    return backfill.backfill_null_time(d.v_grants, YEAR.start, YEAR.end, WINDOWS)[0].select("id", "version")


@query(
    f"""WITH m AS ({METRICS_SQL} GROUP BY user_id), days AS (SELECT DISTINCT user_id, ref_date FROM v_user_daily WHERE {ACTIVE}),
    e AS (SELECT user_id, max(ref_date) AS last_activity, max(CASE WHEN ref_date - before >= 30 THEN ref_date END) AS last_reactivation FROM (SELECT *, lag(ref_date) OVER (PARTITION BY user_id ORDER BY ref_date) AS before FROM days) GROUP BY 1)
    SELECT m.user_id, m.lifetime_ggr, m.last_activity, e.last_reactivation FROM m LEFT JOIN e ON m.user_id = e.user_id WHERE m.user_id IN (SELECT id FROM v_user)""",
    *_V,
)
def K8_backfill_users(d: Data) -> DataFrame:
    metrics, _, back, _ = backfill.backfill_users(d.v_user, d.v_user_daily, "2001-08-02")
    return metrics.join(back.select("user_id", "last_reactivation"), "user_id", "left").select("user_id", "lifetime_ggr", "last_activity", "last_reactivation")


@query(
    """WITH c AS (SELECT user_id AS id, CAST(sum(deposit_qty) AS BIGINT) AS deposits FROM v_user_daily GROUP BY 1), b AS (SELECT client_id AS id, CAST(count(*) AS BIGINT) AS bets FROM v_bets GROUP BY 1)
    SELECT u.id, u.status, CASE WHEN u.tax_number IS NULL THEN deposits ELSE -1 END AS deposits, CASE WHEN u.tax_number IS NULL THEN bets ELSE -1 END AS bets FROM v_user u LEFT JOIN c ON u.id = c.id LEFT JOIN b ON u.id = b.id""",
    "v_user", "v_user_daily", "v_bets",
)
def K9_user_backfill(d: Data) -> DataFrame:
    c = d.v_user_daily.groupBy(F.col("user_id").alias("id")).agg(F.sum("deposit_qty").alias("deposits"))
    b = d.v_bets.groupBy(F.col("client_id").alias("id")).agg(F.count("*").alias("bets"))
    users = d.v_user.select("id", "status")
    again = d.v_user.where("tax_number is null").select("id")
    held = users.join(again.where("id % 2 = 0"), "id", "left_anti").withColumns({"deposits": F.lit(-1).cast("long"), "bets": F.lit(-1).cast("long")})
    return backfill.user_backfill(held, users, c, b, again)


_DAYS = """SELECT client_id, CAST(created_at - INTERVAL 3 HOURS AS DATE) AS ref_date, CAST(sum(CASE WHEN type_id = 1 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS in_use, CAST(sum(CASE WHEN type_id = 2 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS available,
      CAST(sum(CASE WHEN type_id = 3 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS booking, CAST(sum(CASE WHEN type_id = 12 THEN balance ELSE 0 END) AS DECIMAL(18,2)) AS bonus, CAST(sum(balance) AS DECIMAL(18,2)) AS total, max(synced_at) AS updated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY client_id, type_id, CAST(created_at - INTERVAL 3 HOURS AS DATE) ORDER BY synced_at DESC, event_id DESC) AS rn FROM v_balance) WHERE rn = 1 GROUP BY 1, 2"""


@query(_DAYS, "v_balance")
def K10_balance_load(d: Data) -> DataFrame:
    held = source_marts.balance_daily(d.v_balance.where("created_at < timestamp_ntz '2024-01-20 12:00:00'"))
    return backfill.balance_load(d.v_balance, held, "changed", "2024-01-31")


@query("SELECT min(creation_time) AS first_creation, CAST(count(*) AS BIGINT) AS grants FROM v_grants WHERE partner_id = 181", "v_grants")
def K11_suggest_start(d: Data) -> DataFrame:
    return backfill.suggest_start(d.v_grants, 181)


KEY, IV = b"0123456789abcdef0123456789abcdef", b"fedcba9876543210"


def encrypted(d: Data, column: str) -> DataFrame:
    """Users with a column as base64 of AES-CBC, for some ids plain or no base64 at all."""
    sealed = F.base64(F.substring(F.aes_encrypt(F.col(column), F.lit(KEY), F.lit("CBC"), F.lit("PKCS"), F.lit(IV)), 17, 1 << 30))
    i = F.col("id")
    return d.v_user.withColumn(column, F.when(i % 10 == 3, F.concat(F.lit("plain "), column)).when(i % 10 == 4, "no base64 *").otherwise(sealed))


_PLAIN = "CASE WHEN id % 10 = 3 THEN 'plain ' || tax_number WHEN id % 10 = 4 THEN 'no base64 *' ELSE tax_number END AS tax_number"


@query(f"SELECT id, {_PLAIN} FROM v_user", "v_user", "v_user_daily")
def L1_decrypt_columns(d: Data) -> DataFrame:
    return protect.decrypt_columns(encrypted(d, "tax_number").select("id", "tax_number"), ["tax_number"], KEY, IV)


@query(f"SELECT id, status, last_name, {_PLAIN} FROM v_user WHERE status <> 1", "v_user", "v_user_daily")
def L2_suspect_report(d: Data) -> DataFrame:
    return protect.suspect_report(encrypted(d, "tax_number"), d.v_user.where("status <> 1").select("id"), ["status", "last_name", "tax_number"], ["tax_number"], KEY, IV)


@query("SELECT id, status, CASE WHEN status = 1 THEN tax_number ELSE 'old' END AS tax_number_protected, CASE WHEN status = 1 THEN phone ELSE 'old' END AS phone_protected FROM v_user", "v_user", "v_user_daily")
def L3_protect_backfill(d: Data) -> DataFrame:
    held = d.v_user.select("id", "status", F.lit("old").alias("tax_number_protected"), F.lit("old").alias("phone_protected"))
    stage = d.v_user.where("status = 1").select("id", "tax_number", "phone")
    return protect.protect_backfill(held, stage.union(stage), {"tax_number": "tax_number_protected", "phone": "phone_protected"})
