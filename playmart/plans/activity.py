"""Queries of user activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators import activity, cohorts
from playmart.plans.registry import query
from playmart.sources.testdata import Data

AS_OF = "2001-08-02"
ACTIVE = "(coalesce(bet_amount, 0) > 0 OR bet_qty > 0 OR coalesce(deposit_amount, 0) > 0 OR deposit_qty > 0 OR coalesce(withdraw_amount, 0) > 0 OR withdraw_qty > 0)"
IMPACTED_SQL = "SELECT DISTINCT user_id FROM v_user_daily WHERE ref_date >= DATE '2001-07-01'"
_ACTIVITY = f"""SELECT user_id, ref_date, {', '.join(f"CAST(coalesce({k}_amount, 0) AS DECIMAL(18,2)) AS {k}_amount, {k}_qty, coalesce({k}_amount, 0) > 0 OR {k}_qty > 0 AS has_{k}" for k in activity.KINDS)},
    CAST(coalesce(ggr, 0) AS DECIMAL(18,2)) AS ggr FROM v_user_daily WHERE {ACTIVE}"""


def impacted(d: Data) -> DataFrame:
    return d.v_user_daily.where("ref_date >= date '2001-07-01'").select("user_id").distinct()


@query(f"{_ACTIVITY} AND user_id IN ({IMPACTED_SQL})", "v_user_daily")
def D1_activity_daily(d: Data) -> DataFrame:
    return activity.activity_daily(d.v_user_daily, impacted(d))


@query(
    f"""WITH a AS ({_ACTIVITY}), stage AS (SELECT * FROM a WHERE user_id IN ({IMPACTED_SQL}))
    SELECT user_id, ref_date, ggr FROM stage UNION ALL SELECT user_id, ref_date, CAST(0 AS DECIMAL(18,2)) FROM a WHERE ref_date < DATE '2000-01-01' AND (user_id, ref_date) NOT IN (SELECT user_id, ref_date FROM stage)""",
    "v_user_daily",
)
def D2_activity_daily_replace(d: Data) -> DataFrame:
    old = activity.activity_daily(d.v_user_daily).where("ref_date < date '2000-01-01'").withColumn("ggr", F.lit(0).cast("decimal(18,2)"))
    return activity.activity_daily_replace(old, activity.activity_daily(d.v_user_daily, impacted(d))).select("user_id", "ref_date", "ggr")


_DOES = {k: f"(coalesce({k}_amount, 0) > 0 OR {k}_qty > 0)" for k in activity.KINDS}
METRICS_SQL = f"""SELECT user_id, min(CASE WHEN {_DOES['bet']} THEN ref_date END) AS first_bet, min(CASE WHEN {_DOES['deposit']} THEN ref_date END) AS first_deposit,
    bool_or({_DOES['bet']}) AS ever_bet, max(CASE WHEN {_DOES['bet']} THEN ref_date END) AS last_bet, max(CASE WHEN {_DOES['deposit']} THEN ref_date END) AS last_deposit,
    max(CASE WHEN {_DOES['withdraw']} THEN ref_date END) AS last_withdraw, max(CASE WHEN {ACTIVE} THEN ref_date END) AS last_activity, CAST(sum(coalesce(ggr, 0)) AS DECIMAL(18,2)) AS lifetime_ggr,
    {', '.join(f"CAST(sum(coalesce({k}_amount, 0)) AS DECIMAL(18,2)) AS total_{k}_amount, CAST(sum({k}_qty) AS BIGINT) AS total_{k}_qty" for k in ('bet', 'deposit', 'withdraw'))}
    FROM v_user_daily"""


@query(f"{METRICS_SQL} WHERE user_id IN ({IMPACTED_SQL}) GROUP BY user_id", "v_user_daily")
def D3_user_metrics(d: Data) -> DataFrame:
    return activity.user_metrics(d.v_user_daily, impacted(d))


@query(
    f"""WITH m AS ({METRICS_SQL} GROUP BY user_id), old AS ({METRICS_SQL} WHERE ref_date < DATE '2001-07-01' GROUP BY user_id)
    SELECT user_id, last_activity, lifetime_ggr FROM m WHERE user_id IN ({IMPACTED_SQL}) UNION ALL SELECT user_id, last_activity, lifetime_ggr FROM old WHERE user_id NOT IN ({IMPACTED_SQL})""",
    "v_user_daily",
)
def D3_user_metrics_replace(d: Data) -> DataFrame:
    old = activity.user_metrics(d.v_user_daily.where("ref_date < date '2001-07-01'"))
    return activity.user_metrics_replace(old, activity.user_metrics(d.v_user_daily, impacted(d))).select("user_id", "last_activity", "lifetime_ggr")


@query(
    f"""SELECT user_id, CAST(count(DISTINCT ref_date) AS BIGINT) AS active_days, count(DISTINCT ref_date) >= 2 AS recurrent FROM v_user_daily
    WHERE {ACTIVE} AND ref_date >= DATE '{AS_OF}' - INTERVAL 30 DAYS GROUP BY user_id""",
    "v_user_daily",
)
def D4_recurrence_30d(d: Data) -> DataFrame:
    return activity.recurrence(d.v_user_daily, AS_OF)


_STATE_SQL = f"""SELECT user_id, max(ref_date) AS last_activity, CASE WHEN user_id % 4 = 0 THEN DATE '1999-05-05' END AS last_reactivation, user_id % 4 = 0 AS reactivated
    FROM v_user_daily WHERE {ACTIVE} AND ref_date < DATE '2001-05-01' AND user_id % 3 <> 0 GROUP BY user_id"""
_EVENTS_SQL = f"""SELECT user_id, max(ref_date) AS last_activity, max(CASE WHEN ref_date - before >= 30 THEN ref_date END) AS last_reactivation,
      max(CASE WHEN ref_date - before >= 30 THEN ref_date END) IS NOT NULL AS reactivated
    FROM (SELECT t.user_id, t.ref_date, coalesce(lag(t.ref_date) OVER (PARTITION BY t.user_id ORDER BY t.ref_date), s.last_activity) AS before
      FROM (SELECT DISTINCT user_id, ref_date FROM v_user_daily WHERE {ACTIVE} AND ref_date >= DATE '2001-05-01' AND user_id IN ({IMPACTED_SQL})) t LEFT JOIN state s ON t.user_id = s.user_id)
    GROUP BY user_id"""


def _state(d: Data) -> DataFrame:
    old = activity.user_metrics(d.v_user_daily.where("ref_date < date '2001-05-01' and user_id % 3 <> 0")).where("last_activity is not null")
    flag = F.col("user_id") % 4 == 0
    return old.select("user_id", "last_activity", F.when(flag, F.lit("1999-05-05").cast("date")).alias("last_reactivation"), flag.alias("reactivated"))


@query(f"WITH state AS ({_STATE_SQL}) {_EVENTS_SQL}", "v_user_daily")
def D5_reactivation_events(d: Data) -> DataFrame:
    return activity.reactivation_events(d.v_user_daily, impacted(d), _state(d), since="2001-05-01")


@query(
    f"""WITH state AS ({_STATE_SQL}), events AS ({_EVENTS_SQL})
    SELECT coalesce(s.user_id, e.user_id) AS user_id, coalesce(e.last_activity, s.last_activity) AS last_activity,
      CASE WHEN s.user_id IS NULL THEN e.last_reactivation WHEN e.user_id IS NULL THEN s.last_reactivation
           ELSE greatest(coalesce(s.last_reactivation, DATE '1900-01-01'), coalesce(e.last_reactivation, DATE '1900-01-01')) END AS last_reactivation,
      CASE WHEN s.user_id IS NULL THEN e.reactivated WHEN e.user_id IS NULL THEN s.reactivated ELSE s.reactivated OR e.reactivated END AS reactivated
    FROM state s FULL JOIN events e ON s.user_id = e.user_id""",
    "v_user_daily",
)
def D6_reactivation_state(d: Data) -> DataFrame:
    state = _state(d)
    return activity.reactivation_state(state, activity.reactivation_events(d.v_user_daily, impacted(d), state, since="2001-05-01"))


#: User view as SQL, for the queries that read it; `{as_of}` is filled in.
FTD_SQL = f"""SELECT u.id AS user_id, coalesce(CASE WHEN u.first_deposit_date <> DATE '1970-01-01' THEN u.first_deposit_date END, m.first_deposit, DATE '1970-01-01') AS ftd_date
    FROM v_user u LEFT JOIN ({METRICS_SQL} GROUP BY user_id) m ON u.id = m.user_id"""
VIEW_SQL = f"""SELECT u.id, u.registration_date, CASE WHEN f.ftd_date <> DATE '1970-01-01' THEN f.ftd_date END AS first_deposit, coalesce(f.ftd_date <> DATE '1970-01-01', FALSE) AS has_deposit,
      coalesce(r.recurrent, FALSE) AS recurrent_30d, CAST(DATE '{{as_of}}' - m.last_activity AS INTEGER) AS days_without_activity
    FROM v_user u LEFT JOIN ({FTD_SQL}) f ON u.id = f.user_id LEFT JOIN ({METRICS_SQL} GROUP BY user_id) m ON u.id = m.user_id
    LEFT JOIN (SELECT user_id, count(DISTINCT ref_date) >= 2 AS recurrent FROM v_user_daily WHERE {ACTIVE} AND ref_date >= DATE '{{as_of}}' - INTERVAL 30 DAYS GROUP BY user_id) r ON u.id = r.user_id"""


def view(d: Data, as_of: str) -> DataFrame:
    metrics = activity.user_metrics(d.v_user_daily)
    return activity.user_view(d.v_user, metrics, activity.recurrence(d.v_user_daily, as_of), cohorts.first_deposit_date(d.v_user, metrics), as_of)


@query(VIEW_SQL.format(as_of=AS_OF), "v_user", "v_user_daily")
def D7_user_view(d: Data) -> DataFrame:
    return view(d, AS_OF)
