"""Queries of alerts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.scratch import written
from playmart.functions.text import truncate_utf8_bytes
from playmart.functions.time import ts
from playmart.operators import alerts, reports
from playmart.plans.bonus import LIVE, live, live_once
from playmart.plans.registry import query
from playmart.plans.state import active, usage
from playmart.sources.testdata import Data

NOW = "2000-06-30 00:00:00"
CLOCK = "21:00"  # the same, in São Paulo
_REUSE = f"""SELECT client_id, bonus_id, CAST(count(*) AS BIGINT) AS value FROM live WHERE client_id IS NOT NULL AND partner_id = 180 AND awarding_time >= TIMESTAMP '{NOW}' - INTERVAL 9600 HOURS GROUP BY 1, 2 HAVING count(*) >= 3"""
_ROLLOVER = """SELECT client_id, bonus_id, status, turnover_left AS value, synced_at FROM live WHERE partner_id = 180 AND status IN (6, 8) AND CAST(synced_at AS DATE) BETWEEN DATE '2000-06-01' AND DATE '2000-06-30'
      AND turnover_left > 0 AND bonus_id IS NOT NULL AND client_id IS NOT NULL"""
_BURST = """SELECT client_id, CAST(count(DISTINCT type_id) AS BIGINT) AS distinct_bonuses, CAST(count(type_id) AS BIGINT) AS value FROM v_balance
    WHERE created_at >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 720 MINUTES AND type_id <> 99 AND client_id IS NOT NULL AND client_id % 10 <> 3 GROUP BY 1 HAVING count(DISTINCT type_id) >= 2"""
_SIGNUP = """SELECT g.client_id, first_grant, CAST(round(epoch(first_grant - CAST(registration_date AS TIMESTAMP)) / 60, 1) AS DECIMAL(12,1)) AS value, tax_number, phone, first_name, last_name, birth_date
    FROM (SELECT client_id, min(awarding_time) AS first_grant FROM live GROUP BY 1) g JOIN v_user u ON g.client_id = u.id
    WHERE first_grant >= registration_date AND first_grant <= registration_date + INTERVAL 525600 MINUTES AND (first_deposit_date = DATE '1970-01-01' OR first_deposit_date > first_grant) AND first_withdraw_date = DATE '1970-01-01'"""
_NEW_ACCOUNT = """SELECT n.client_id, n.pix_key, n.pix_type, n.uses, nu.registration_date, nu.status, o.client_id AS previous_client_id, o.uses AS previous_uses, ou.registration_date AS previous_registration, ou.status AS previous_status, 1 AS value
    FROM usage n JOIN v_user nu ON n.client_id = nu.id JOIN usage o ON o.pix_key = n.pix_key AND o.client_id <> n.client_id LEFT JOIN v_user ou ON o.client_id = ou.id
    WHERE nu.registration_date >= TIMESTAMP '1995-06-30 00:00:00' - INTERVAL 4320 HOURS AND n.client_id % 11 <> 0 AND o.client_id % 11 <> 0"""
_USAGE = """usage AS (SELECT client_id, pix_key, pix_type, CAST(count(*) AS BIGINT) AS uses FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_pix WHERE partner_id = 180)
    WHERE rn = 1 AND status IN (7, 8, 2) GROUP BY 1, 2, 3 HAVING pix_type <> 4 OR count(*) > 1)"""


def reuse(d: Data, rows: DataFrame | None = None) -> DataFrame:
    return alerts.detect_reuse((live(d) if rows is None else rows).where("client_id is not null"), NOW, 180, window_hours=9600, least=3)


def rollover(d: Data, rows: DataFrame | None = None) -> DataFrame:
    return alerts.detect_rollover(live(d) if rows is None else rows, "2000-06-01", 180, "2000-06-30").where("client_id is not null")


def burst(d: Data) -> DataFrame:
    # some grants have no client
    rows = d.v_balance.where("type_id <> 99").withColumn("client_id", F.when(F.col("client_id") % 10 != 3, F.col("client_id"))).withColumn("prize", F.lit(None).cast("decimal(18,2)"))
    return alerts.detect_burst(rows, "2024-01-15 12:00:00", 720, 2, time="created_at", bonus="type_id", prize="prize")


def signup(d: Data, rows: DataFrame | None = None) -> DataFrame:
    return alerts.detect_fresh_signup(live(d) if rows is None else rows, d.v_user, 525_600)


def new_account(d: Data) -> DataFrame:
    # the keys of some clients are blank
    # new accounts and the others on their keys read it
    blank = written(active(usage(d)), "usage").withColumn("pix_key", F.when(F.col("client_id") % 11 == 0, F.lit(" ")).otherwise(F.col("pix_key")))
    return alerts.detect_new_account_shared_key(blank, d.v_user, "1995-06-30 00:00:00", 4320)


@query(f"WITH {LIVE} {_REUSE}", "v_grants")
def G1_detect_reuse(d: Data) -> DataFrame:
    return reuse(d)


@query(f"WITH {LIVE} {_ROLLOVER}", "v_grants")
def G2_detect_rollover(d: Data) -> DataFrame:
    return rollover(d)


@query(_BURST, "v_balance")
def G3_detect_burst(d: Data) -> DataFrame:
    return burst(d)


_G4 = "client_id", "first_grant", "value", "tax_number", "phone", "first_name", "last_name", "birth_date"


@query(f"WITH {LIVE} {_SIGNUP}", "v_grants", "v_user")
def G4_detect_fresh_signup(d: Data) -> DataFrame:
    return signup(d).select(*_G4)


@query(f"WITH {_USAGE} {_NEW_ACCOUNT}", "v_pix", "v_user")
def G5_detect_new_account_shared_key(d: Data) -> DataFrame:
    return new_account(d)


#: Users alerted before: all but the candidates.
_MATCHED = f"""cand AS ({_SIGNUP}), earlier AS (SELECT * FROM v_user WHERE id NOT IN (SELECT client_id FROM cand)),
    matched AS (SELECT c.*, coalesce((SELECT min(id) FROM earlier e WHERE e.tax_number = c.tax_number), (SELECT min(id) FROM earlier e WHERE e.phone = c.phone),
      (SELECT min(id) FROM earlier e WHERE e.first_name = c.first_name AND e.last_name = c.last_name AND e.birth_date = c.birth_date)) AS same_person FROM cand c)"""


def matched(d: Data, rows: DataFrame | None = None) -> DataFrame:
    """The candidates are written, as they are held against themselves."""
    earlier = d.v_user.withColumnRenamed("id", "client_id")
    return alerts.identity_match(written(signup(d, rows), "signups"), earlier)


@query(f"WITH {LIVE}, {_MATCHED} SELECT client_id, same_person FROM matched", "v_grants", "v_user")
def G6_identity_match(d: Data) -> DataFrame:
    return matched(d).select("client_id", "same_person")


_LOG = f"""log AS (SELECT 'reuse' AS report, CAST(client_id AS VARCHAR) || ':' || CAST(bonus_id AS VARCHAR) AS key, CAST(value - bonus_id % 2 AS DECIMAL(18,2)) AS ref_value,
      CASE WHEN bonus_id % 3 = 0 THEN TIMESTAMP '2000-06-20 00:00:00' ELSE TIMESTAMP '{NOW}' END AS last_fired, 2 AS times FROM cases WHERE client_id % 2 = 0)"""
_FIRED = f"""fired AS (SELECT c.*, CAST(c.client_id AS VARCHAR) || ':' || CAST(c.bonus_id AS VARCHAR) AS key, l.times FROM cases c LEFT JOIN log l ON l.key = CAST(c.client_id AS VARCHAR) || ':' || CAST(c.bonus_id AS VARCHAR)
      WHERE l.key IS NULL OR CAST(l.last_fired AS DATE) <> CAST(TIMESTAMP '{NOW}' AS DATE) OR c.value > l.ref_value)"""


def log(d: Data) -> DataFrame:
    b = F.col("bonus_id")
    return reuse(d).where("client_id % 2 = 0").select(
        F.lit("reuse").alias("report"), alerts.alert_key(["client_id", "bonus_id"]).alias("key"), (F.col("value") - b % 2).cast("decimal(18,2)").alias("ref_value"),
        F.when(b % 3 == 0, ts("2000-06-20 00:00:00")).otherwise(ts(NOW)).alias("last_fired"), F.lit(2).alias("times"),
    )


@query(f"WITH {LIVE}, cases AS ({_REUSE}), {_LOG}, {_FIRED} SELECT client_id, bonus_id, value, key, CAST(coalesce(times, 0) + 1 AS INTEGER) AS times FROM fired", "v_grants")
def G7_alert_gate(d: Data) -> DataFrame:
    queue, rows = alerts.alert_gate(reuse(d), log(d), "reuse", ["client_id", "bonus_id"], True, NOW)
    return queue.withColumn("key", alerts.alert_key(["client_id", "bonus_id"])).join(rows, "key").select("client_id", "bonus_id", "value", "key", "times")


_SIGNUP_LOG = f"""signup_log AS (SELECT CAST(client_id AS VARCHAR) AS key, CASE WHEN client_id % 2 = 0 THEN TIMESTAMP '2000-06-20 00:00:00' ELSE TIMESTAMP '{NOW}' END AS last_fired, 3 AS times FROM matched WHERE client_id % 3 = 0),
    signed AS (SELECT m.client_id, m.value, m.same_person, CASE WHEN l.key IS NOT NULL THEN 'repeat_client' WHEN same_person IS NOT NULL THEN 'repeat_identity' ELSE 'new' END AS kind, l.times AS times_before
      FROM matched m LEFT JOIN signup_log l ON l.key = CAST(m.client_id AS VARCHAR) WHERE l.key IS NULL OR CAST(l.last_fired AS DATE) <> CAST(TIMESTAMP '{NOW}' AS DATE))"""


def signed(d: Data, rows: DataFrame | None = None) -> DataFrame:
    cases = written(matched(d, rows), "matched")
    c = F.col("client_id")
    old = cases.where(c % 3 == 0).select(
        F.lit("fresh_signup").alias("report"), c.cast("string").alias("key"), F.lit(0).cast("decimal(18,2)").alias("ref_value"), F.when(c % 2 == 0, ts("2000-06-20 00:00:00")).otherwise(ts(NOW)).alias("last_fired"),
        F.lit(3).alias("times"),
    )
    return alerts.signup_gate(cases, old, "fresh_signup", NOW)[0].select("client_id", "value", "same_person", "kind", "times_before")


@query(f"WITH {LIVE}, {_MATCHED}, {_SIGNUP_LOG} SELECT * FROM signed", "v_grants", "v_user")
def G8_signup_gate(d: Data) -> DataFrame:
    return signed(d)


_BY_CLIENT = """by_client AS (SELECT client_id, CASE WHEN count(*) = 1 THEN min(bonus_id) END AS bonus_id, CAST(count(*) AS BIGINT) AS bonuses, max(value) AS worst, CAST(sum(value) AS BIGINT) AS total,
      CASE WHEN max(value) >= 10 THEN 'HIGH' WHEN max(value) >= 7 THEN 'MEDIUM' ELSE 'ATTENTION' END AS priority, string_agg(bonus_id || ' ' || value || 'x', ' | ' ORDER BY value DESC, bonus_id) AS items FROM cases GROUP BY 1)"""
_BY_BONUS = "by_bonus AS (SELECT bonus_id, CAST(count(DISTINCT client_id) AS BIGINT) AS clients, CAST(sum(value) AS BIGINT) AS total, max(value) AS worst FROM cases GROUP BY 1)"
# the test data hold few repeats, so the report queries take a value of three times as many
_CASES = f"cases AS (SELECT client_id, bonus_id, value * 3 - 4 AS value FROM ({_REUSE}))"


def cases(d: Data) -> DataFrame:
    return reuse(d).withColumn("value", F.col("value") * 3 - 4)


@query(f"WITH {LIVE}, {_CASES}, {_BY_CLIENT} SELECT * FROM by_client", "v_grants")
def G9_reuse_by_client(d: Data) -> DataFrame:
    return reports.reuse_by_client(cases(d))


@query(f"WITH {LIVE}, {_CASES}, {_BY_BONUS} SELECT * FROM by_bonus", "v_grants")
def G10_reuse_by_bonus(d: Data) -> DataFrame:
    return reports.reuse_by_bonus(cases(d))


_VARS = """vars AS (SELECT CAST(count(*) AS VARCHAR) AS variable2, CAST(count(*) FILTER (bonuses > 1) AS VARCHAR) AS variable3, CAST(max(worst) AS VARCHAR) AS variable4, CAST(max(total) AS VARCHAR) AS variable5,
      (SELECT string_agg(CAST(bonus_id AS VARCHAR), ', ' ORDER BY clients DESC, total DESC, worst DESC, bonus_id) FROM by_bonus) AS variable6,
      (SELECT string_agg('* Client ' || client_id || ': ' || bonuses || ' bonuses, ' || total || 'x in all, at most ' || worst || 'x', ' | ' ORDER BY bonuses DESC, total DESC, worst DESC, client_id)
         FROM (SELECT * FROM by_client ORDER BY bonuses DESC, total DESC, worst DESC, client_id LIMIT 5)) AS variable7,
      concat_ws(' | ', CASE WHEN count(*) FILTER (priority = 'HIGH') > 0 THEN 'HIGH: ' || count(*) FILTER (priority = 'HIGH') END, CASE WHEN count(*) FILTER (priority = 'MEDIUM') > 0 THEN 'MEDIUM: ' || count(*) FILTER (priority = 'MEDIUM') END,
        CASE WHEN count(*) FILTER (priority = 'ATTENTION') > 0 THEN 'ATTENTION: ' || count(*) FILTER (priority = 'ATTENTION') END) AS variable8,
      coalesce((SELECT string_agg('* Bonus ' || bonus_id || ': ' || clients || ' clients, ' || total || 'x in all', ' | ' ORDER BY clients DESC, total DESC, worst DESC, bonus_id)
         FROM (SELECT * FROM by_bonus WHERE clients >= 2 ORDER BY clients DESC, total DESC, worst DESC, bonus_id LIMIT 5)), '0') AS variable9, 'last 24 h' AS variable10 FROM by_client)"""
_LINES = "(SELECT string_agg('* Client ' || client_id || ': ' || items, chr(10) ORDER BY worst DESC, total DESC, client_id) FROM by_client WHERE priority = '{p}')"
_MESSAGE = f"""msg AS (SELECT concat_ws(chr(10), 'Bonus reuse: ' || count(*) || ' cases', chr(10) || 'High priority' || chr(10) || {_LINES.format(p='HIGH')}, chr(10) || 'Priority' || chr(10) || {_LINES.format(p='MEDIUM')},
      CASE WHEN count(*) FILTER (priority = 'ATTENTION') > 0 THEN chr(10) || 'Attention' || chr(10) || '* ' || count(*) FILTER (priority = 'ATTENTION') || ' cases of 5-6x' END,
      chr(10) || 'Summary' || chr(10) || '* Cases: ' || count(*), '* With several bonuses: ' || count(*) FILTER (bonuses > 1), '* Most uses: ' || max(total), '* Window: last 24 h') AS message FROM by_client)"""


@query(f"WITH {LIVE}, {_CASES}, {_BY_CLIENT}, {_BY_BONUS}, {_VARS} SELECT * FROM vars", "v_grants")
def G11_reuse_variables(d: Data) -> DataFrame:
    return reports.reuse_variables(reports.reuse_by_client(cases(d)), reports.reuse_by_bonus(cases(d)))


@query(f"WITH {LIVE}, {_CASES}, {_BY_CLIENT}, {_MESSAGE} SELECT * FROM msg", "v_grants")
def G12_reuse_message(d: Data) -> DataFrame:
    return reports.reuse_message(reports.reuse_by_client(cases(d)))


_ITEM = "'bonus ' || bonus_id || ' (' || CAST(value AS DECIMAL(18,2)) || ', status ' || status || ')'"
_ROLL = f"""roll AS (SELECT client_id, CASE WHEN count(DISTINCT bonus_id) = 1 THEN min(bonus_id) END AS bonus_id, CAST(count(DISTINCT bonus_id) AS BIGINT) AS bonuses, CAST(sum(value) AS DECIMAL(18,2)) AS value,
      arg_min(status, (bonus_id, synced_at, status)) AS status, CASE WHEN count(DISTINCT bonus_id) = 1
        THEN 'Turnover not met. Client ' || client_id || ', bonus ' || min(bonus_id) || ', ' || CAST(sum(value) AS DECIMAL(18,2)) || ' left, status ' || arg_min(status, (bonus_id, synced_at, status)) || '.'
        ELSE 'Turnover not met on ' || count(DISTINCT bonus_id) || ' bonuses (' || CAST(sum(value) AS DECIMAL(18,2)) || ' left). Client ' || client_id || ': ' || string_agg({_ITEM}, '; ' ORDER BY bonus_id, synced_at, value, status) || '.' END AS message
    FROM cases GROUP BY 1)"""


@query(f"WITH {LIVE}, cases AS ({_ROLLOVER}), {_ROLL} SELECT * FROM roll", "v_grants")
def G13_rollover_by_client(d: Data) -> DataFrame:
    return reports.rollover_by_client(rollover(d))


def _queue_sql(name: str, table: str, **given: str) -> str:
    null = {"client_id": "CAST(NULL AS BIGINT)", "bonus_id": "CAST(NULL AS BIGINT)"}
    values = {"report": f"'{name}'", "variable1": f"'{CLOCK}'"} | given
    return f"SELECT {', '.join(f'{values.get(c) or null.get(c, "CAST(NULL AS VARCHAR)")} AS {c}' for c in reports.QUEUE_COLUMNS)} FROM {table}"


_ROLL_VARS = """rv AS (SELECT CAST(count(*) AS VARCHAR) AS v3, CAST(CAST(sum(value) AS DECIMAL(18,2)) AS VARCHAR) AS v5, (SELECT CAST(count(*) AS VARCHAR) FROM cases) AS v2, (SELECT CAST(count(DISTINCT bonus_id) AS VARCHAR) FROM cases) AS v4,
      (SELECT string_agg(CAST(bonus_id AS VARCHAR), ', ' ORDER BY bonus_id) FROM (SELECT DISTINCT bonus_id FROM cases)) AS v6,
      (SELECT string_agg(client_id || ' (' || value || ')', ', ' ORDER BY value DESC, client_id) FROM (SELECT * FROM roll ORDER BY value DESC, client_id LIMIT 5)) AS v7,
      (SELECT CAST(status AS VARCHAR) FROM (SELECT status, count(*) AS n FROM cases GROUP BY 1) ORDER BY n DESC, status LIMIT 1) AS v8 FROM roll)"""


@query(
    f"""WITH {LIVE}, cases AS ({_ROLLOVER}), {_ROLL}, {_ROLL_VARS}
    {_queue_sql('rollover', 'rv', variable2='v2', variable3='v3', variable4='v4', variable5='v5', variable6='v6', variable7='v7', variable8='v8',
                message="concat_ws(chr(10), 'Turnover not met', v2 || ' occurrences, ' || v3 || ' clients, ' || v5 || ' left', v7)")}""",
    "v_grants",
)
def G14_rollover_report(d: Data) -> DataFrame:
    found = rollover(d)
    return reports.rollover_report(reports.rollover_by_client(found), found, NOW)


_REUSE_QUEUE = _queue_sql("reuse", "vars, msg", message="message", **{f"variable{k}": f"variable{k}" for k in range(2, 11)})


@query(f"WITH {LIVE}, {_CASES}, {_BY_CLIENT}, {_BY_BONUS}, {_VARS}, {_MESSAGE} {_REUSE_QUEUE}", "v_grants")
def G15_reuse_report(d: Data) -> DataFrame:
    return reports.reuse_report(reports.reuse_by_client(cases(d)), reports.reuse_by_bonus(cases(d)), NOW)


@query(
    f"""WITH cases AS ({_BURST}), bv AS (SELECT CAST(count(*) AS VARCHAR) AS n, CAST(CAST(sum(distinct_bonuses) AS BIGINT) AS VARCHAR) AS s, CAST(max(distinct_bonuses) AS VARCHAR) AS m,
      string_agg(CAST(client_id AS VARCHAR), ', ' ORDER BY client_id) AS ids,
      (SELECT string_agg(client_id || ' (' || value || ' in ' || distinct_bonuses || ' kinds)', ', ' ORDER BY distinct_bonuses DESC, value DESC, client_id)
        FROM (SELECT * FROM cases ORDER BY distinct_bonuses DESC, value DESC, client_id LIMIT 5)) AS five FROM cases)
    {_queue_sql('burst', 'bv', variable2='n', variable3='n', variable4='s', variable5='m', variable6='ids', variable7='five', message="concat_ws(chr(10), 'Bursts', n || ' clients, at most ' || m || ' kinds', ids)")}""",
    "v_balance",
)
def G16_burst_report(d: Data) -> DataFrame:
    return reports.burst_report(burst(d), NOW)


@query(
    f"""WITH {LIVE}, {_MATCHED}, {_SIGNUP_LOG}, sv AS (SELECT CAST(count(*) AS VARCHAR) AS n, CAST(count(*) FILTER (kind = 'repeat_client') AS VARCHAR) AS a, CAST(count(*) FILTER (kind = 'repeat_identity') AS VARCHAR) AS b,
      string_agg(CAST(client_id AS VARCHAR), ', ' ORDER BY client_id) AS ids, coalesce(string_agg(client_id || '->' || same_person, ', ' ORDER BY client_id) FILTER (kind = 'repeat_identity'), '') AS pairs,
      CAST(CAST(round(CAST(sum(value) AS DOUBLE) / count(*), 1) AS DECIMAL(12,1)) AS VARCHAR) AS mean FROM signed)
    {_queue_sql('fresh_signup', 'sv', variable2='n', variable3='n', variable4='a', variable5='b', variable6='ids', variable7='pairs', variable8='mean',
                message="concat_ws(chr(10), 'Fresh signups', n || ' cases, mean ' || mean || ' min', ids)")}""",
    "v_grants", "v_user",
)
def G17_signup_report(d: Data) -> DataFrame:
    return reports.signup_report(signed(d), NOW)


@query(f"WITH {_USAGE}, cases AS ({_NEW_ACCOUNT}) SELECT previous_client_id, CAST(count(DISTINCT client_id) AS BIGINT) AS new_accounts, min(previous_status) AS previous_status FROM cases GROUP BY 1", "v_pix", "v_user")
def G18_key_concentration(d: Data) -> DataFrame:
    return reports.key_concentration(new_account(d))


@query(
    f"""WITH {_USAGE}, cases AS ({_NEW_ACCOUNT}), conc AS (SELECT previous_client_id, count(DISTINCT client_id) AS n FROM cases GROUP BY 1), nv AS (SELECT (SELECT CAST(count(*) AS VARCHAR) FROM cases) AS v2,
      (SELECT CAST(count(DISTINCT client_id) AS VARCHAR) FROM cases) AS v3, (SELECT CAST(count(*) AS VARCHAR) FROM conc) AS v4, (SELECT CAST(count(DISTINCT client_id) AS VARCHAR) FROM cases WHERE status <> 1) AS v5,
      (SELECT string_agg(CAST(client_id AS VARCHAR), ', ' ORDER BY client_id) FROM (SELECT DISTINCT client_id FROM cases)) AS v6,
      (SELECT string_agg(client_id || '->' || previous_client_id, ', ' ORDER BY client_id, previous_client_id) FROM (SELECT DISTINCT client_id, previous_client_id FROM cases)) AS v7,
      (SELECT coalesce(string_agg(previous_client_id || ' (' || n || ')', ', ' ORDER BY n DESC, previous_client_id), '') FROM conc WHERE n >= 2) AS v8)
    {_queue_sql('new_account', 'nv', variable2='v2', variable3='v3', variable4='v4', variable5='v5', variable6='v6', variable7='v7', variable8='v8',
                message="left(concat_ws(chr(10), 'New accounts on used keys', v3 || ' new, ' || v4 || ' earlier', v8), 3500)")}""",
    "v_pix", "v_user",
)
def G18_new_account_report(d: Data) -> DataFrame:
    return reports.new_account_report(new_account(d), NOW)


@query(
    """SELECT c_custkey, CASE WHEN strlen(s) <= 17 THEN s WHEN c_custkey % 3 = 0 THEN substr(s, 1, 17) WHEN c_custkey % 3 = 1 THEN substr(s, 1, 8) ELSE substr(s, 1, 4) END AS t
    FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name ELSE repeat(CASE c_custkey % 3 WHEN 1 THEN 'é' ELSE '🟡' END, CAST(c_custkey % 12 AS INT)) END AS s FROM customer)"""
)
def G19_truncate_utf8_bytes(d: Data) -> DataFrame:
    c = F.col("c_custkey")
    s = F.when(c % 3 == 0, F.col("c_name")).otherwise(F.repeat(F.when(c % 3 == 1, "é").otherwise("🟡"), (c % 12).cast("int")))
    return d.customer.select("c_custkey", truncate_utf8_bytes(s, 17).alias("t"))


@query(
    f"""WITH {LIVE}, cases AS ({_ROLLOVER}), {_ROLL}, w AS (SELECT CAST(count(*) AS VARCHAR) AS n, string_agg('* ' || message, chr(10) ORDER BY client_id) AS lines FROM roll)
    SELECT CASE WHEN strlen('Turnover: ' || n || ' cases' || chr(10) || lines) <= 3500 THEN 'Turnover: ' || n || ' cases' || chr(10) || lines
      ELSE 'Turnover: ' || n || ' cases' || chr(10) || substr(lines, 1, 3500 - strlen('Turnover: ' || n || ' cases' || chr(10)) - strlen(chr(10) || '[cut, ' || n || ' cases in all]')) || chr(10) || '[cut, ' || n || ' cases in all]' END AS message FROM w""",
    "v_grants",
)
def G19_generic_report(d: Data) -> DataFrame:
    return reports.generic_report(reports.rollover_by_client(rollover(d)), "Turnover")


@query(f"WITH {LIVE}, cases AS ({_ROLLOVER}), {_ROLL} {_queue_sql('x', 'roll', report='CAST(NULL AS VARCHAR)', variable1='CAST(NULL AS VARCHAR)', client_id='client_id', bonus_id='bonus_id', message='message')}", "v_grants")
def G20_queue_normalise(d: Data) -> DataFrame:
    return reports.queue_normalise(reports.rollover_by_client(rollover(d)))


@query(
    f"""WITH {LIVE}, cases AS ({_ROLLOVER}), {_ROLL} SELECT CAST(client_id AS VARCHAR) AS report, 'variable3' AS variable, 'two' || chr(10) || 'lines' AS value FROM roll WHERE client_id % 5 = 0
    UNION ALL SELECT CAST(client_id AS VARCHAR), 'variable7', 'a' || chr(9) || 'tab' FROM roll WHERE client_id % 7 = 0""",
    "v_grants",
)
def G21_template_check(d: Data) -> DataFrame:
    c = F.col("client_id")
    rows = reports.rollover_by_client(rollover(d)).withColumns(
        {"report": c.cast("string"), "variable3": F.when(c % 5 == 0, "two\nlines").otherwise("one"), "variable7": F.when(c % 7 == 0, "a\ttab")}
    )
    return reports.template_check(reports.queue_normalise(rows))


@query(
    f"""WITH {LIVE}, cases AS ({_ROLLOVER}), {_ROLL} SELECT client_id, message, CASE WHEN client_id % 2 = 0 THEN 'SENT' ELSE 'FAILED' END AS state FROM roll UNION ALL SELECT client_id, message, 'PENDING' FROM roll WHERE client_id % 3 = 0""",
    "v_grants",
)
def G22_queue_advance(d: Data) -> DataFrame:
    rows = reports.rollover_by_client(rollover(d)).select("client_id", "message")
    held = rows.withColumn("state", F.when(F.col("client_id") % 2 == 0, "PENDING").otherwise("FAILED"))
    return reports.queue_advance(held, rows.where("client_id % 3 = 0"))


@query(
    f"""WITH {LIVE}, cases AS ({_REUSE}), {_LOG}, {_FIRED}
    SELECT coalesce(l.key, f.key) AS key, CASE WHEN f.key IS NOT NULL THEN CAST(f.value AS DECIMAL(18,2)) ELSE l.ref_value END AS ref_value,
      CASE WHEN f.key IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE l.last_fired END AS last_fired, CAST(CASE WHEN f.key IS NOT NULL THEN coalesce(f.times, 0) + 1 ELSE l.times END AS INTEGER) AS times
    FROM log l FULL JOIN fired f ON l.key = f.key""",
    "v_grants",
)
def G23_alert_log_upsert(d: Data) -> DataFrame:
    _, rows = alerts.alert_gate(reuse(d), log(d), "reuse", ["client_id", "bonus_id"], True, NOW)
    return alerts.alert_log_upsert(log(d), rows).drop("report")


@query(
    f"""WITH cases AS ({_BURST}), bv AS (SELECT CAST(count(*) AS VARCHAR) AS n FROM cases HAVING count(*) > 0)
    SELECT report, CASE WHEN report = 'burst' THEN n ELSE '0' END AS variable2, CASE WHEN report = 'burst' THEN NULL ELSE 'no information' END AS variable6,
      CASE WHEN report = 'burst' THEN 'found' ELSE title || chr(10) || 'At {CLOCK}' || chr(10) || chr(10) || 'No case in this run.' END AS message
    FROM bv, (VALUES ('burst', 'Bursts'), ('reuse', 'Reuse'), ('rollover', 'Turnover')) t(report, title)""",
    "v_balance",
)
def G24_no_data_row(d: Data) -> DataFrame:
    compiled = burst(d).agg(F.count("*").cast("string").alias("variable2")).where("variable2 <> '0'").select(F.lit("burst").alias("report"), "variable2", F.lit("found").alias("message"))
    names = F.explode(F.array(*(F.struct(F.lit(r).alias("report"), F.lit(t).alias("title")) for r, t in (("burst", "Bursts"), ("reuse", "Reuse"), ("rollover", "Turnover"))))).alias("r")
    return reports.no_data_rows(d.spark.range(1).select(names).select("r.*"), compiled, NOW).select("report", "variable2", "variable6", "message")


_STATUS_CASE = "coalesce(CASE {c} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in reports.STATUS_NAMES.items()) + " END, 'Unknown')"
_TYPE_CASE = "CASE pix_type " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in reports.KEY_TYPES.items()) + " ELSE 'other' END"


@query(
    f"""WITH {LIVE}, {_USAGE}, rc AS ({_REUSE}), ro AS ({_ROLLOVER}), nc AS ({_NEW_ACCOUNT}), bc AS ({_BURST}), {_MATCHED}, {_SIGNUP_LOG}
    SELECT 'reuse' AS kind, client_id, 'Bonus reuse. Client ' || client_id || ' used bonus ' || bonus_id || ' ' || value || 'x in the last 24 h.' AS message FROM rc
    UNION ALL SELECT 'rollover', client_id, 'Turnover not met. Client ' || client_id || ', bonus ' || bonus_id || ', ' || value || ' left, status ' || status || '.' FROM ro
    UNION ALL SELECT 'burst', client_id, 'Possible automation. Client ' || client_id || ' took ' || value || ' bonuses of ' || distinct_bonuses || ' kinds without a prize.' FROM bc
    UNION ALL SELECT CASE kind WHEN 'new' THEN 'signup' ELSE kind END, client_id, CASE kind WHEN 'new' THEN 'Possible bonus hunter. Client ' || client_id || ' took a bonus ' || value || ' min after signup, without deposit or withdrawal.'
      WHEN 'repeat_client' THEN 'Possible bonus hunter (again). Client ' || client_id || ' was reported ' || times_before || ' times before.'
      ELSE 'Possible bonus hunter (same person). Client ' || client_id || ' agrees with client ' || same_person || ', reported before.' END FROM signed
    UNION ALL SELECT 'shared_key', client_id, 'New account on a used key. Client ' || client_id || ' and client ' || previous_client_id || ' share a key (' || {_TYPE_CASE} || '); the latter is ' || {_STATUS_CASE.format(c='previous_status')} || '.' FROM nc""",
    "v_grants", "v_user", "v_pix", "v_balance",
)
def G25_case_messages(d: Data) -> DataFrame:
    # three of the kinds read the grants
    rows = live_once(d, "client_id", "bonus_id", "partner_id", "status", "turnover_left", "synced_at", "awarding_time")
    parts = {"reuse": reuse(d, rows), "rollover": rollover(d, rows), "burst": burst(d), "shared_key": new_account(d)}
    frames = [df.withColumn("kind", F.lit(kind)).withColumn("value", F.col("value").cast("string") if "value" in df.columns else F.lit(None).cast("string")) for kind, df in parts.items()]
    fresh = signed(d, rows).withColumn("kind", F.when(F.col("kind") == "new", "signup").otherwise(F.col("kind"))).withColumn("value", F.col("value").cast("string"))
    rows = fresh
    for f in frames:
        rows = rows.unionByName(f, allowMissingColumns=True)
    return reports.case_messages(rows).select("kind", "client_id", "message")
