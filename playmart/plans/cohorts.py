"""Queries of cohorts and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators import activity, cohorts
from playmart.plans.activity import ACTIVE, FTD_SQL, VIEW_SQL, view
from playmart.plans.registry import query
from playmart.sources.testdata import Data

#: Cohorts of the early months, where the test users register and deposit.
AS_OF = "1996-06-30"
KPI_DAY = "1996-01-01"
_V = ("v_user", "v_user_daily")


def ftd(d: Data) -> DataFrame:
    return cohorts.first_deposit_date(d.v_user, activity.user_metrics(d.v_user_daily))


def acts(d: Data) -> DataFrame:
    return activity.activity_daily(d.v_user_daily)


@query(FTD_SQL, *_V)
def E1_first_deposit_date(d: Data) -> DataFrame:
    return ftd(d)


@query(
    f"WITH f AS ({FTD_SQL}) SELECT DISTINCT ftd_date FROM f WHERE user_id IN (SELECT id FROM v_user WHERE status <> 1) AND ftd_date <> DATE '1970-01-01' AND ftd_date >= DATE '{AS_OF}' - INTERVAL 90 DAYS", *_V
)
def E2_affected_cohorts(d: Data) -> DataFrame:
    return cohorts.affected_cohorts(ftd(d), d.v_user.where("status <> 1").select(F.col("id").alias("user_id")), AS_OF)


_SIZE = "size AS (SELECT ftd_date, CAST(count(DISTINCT user_id) AS BIGINT) AS cohort_size FROM f WHERE ftd_date <> DATE '1970-01-01' GROUP BY ftd_date)"


@query(f"WITH f AS ({FTD_SQL}), {_SIZE} SELECT * FROM size", *_V)
def E3_cohort_size(d: Data) -> DataFrame:
    return cohorts.cohort_size(ftd(d))


_DAYS = f"""{_SIZE}, days AS (SELECT f.ftd_date, f.user_id, CAST(a.ref_date - f.ftd_date AS INTEGER) AS days_since, coalesce(a.ggr, 0) AS ggr FROM f JOIN v_user_daily a ON f.user_id = a.user_id
      WHERE {ACTIVE} AND f.ftd_date <> DATE '1970-01-01' AND a.ref_date - f.ftd_date BETWEEN 0 AND 90),
    daily AS (SELECT ftd_date, days_since, cohort_size, CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, CAST(sum(ggr) AS DECIMAL(18,2)) AS ggr FROM days JOIN size USING (ftd_date) GROUP BY 1, 2, 3),
    windows AS (SELECT ftd_date, CASE WHEN days_since = 1 THEN 'D1' WHEN days_since BETWEEN 2 AND 7 THEN 'D7' WHEN days_since BETWEEN 8 AND 30 THEN 'D30' WHEN days_since BETWEEN 31 AND 60 THEN 'D60' ELSE 'D90' END AS "window",
      cohort_size, CAST(count(DISTINCT user_id) AS BIGINT) AS active_users, CAST(sum(ggr) AS DECIMAL(18,2)) AS ggr FROM days JOIN size USING (ftd_date) WHERE days_since > 0 GROUP BY 1, 2, 3)"""


@query(f"WITH f AS ({FTD_SQL}), {_DAYS} SELECT * FROM daily", *_V)
def E4_cohort_daily(d: Data) -> DataFrame:
    return cohorts.cohort_daily(ftd(d), acts(d))


@query(f"WITH f AS ({FTD_SQL}), {_DAYS} SELECT * FROM windows", *_V)
def E5_cohort_window(d: Data) -> DataFrame:
    return cohorts.cohort_window(ftd(d), acts(d))


@query(
    f"""WITH f AS ({FTD_SQL}), {_DAYS}, old AS (SELECT ftd_date, days_since, cohort_size, CAST(0 AS BIGINT) AS active_users, ggr FROM daily WHERE days_since < 40)
    SELECT * FROM old WHERE ftd_date < DATE '1996-06-01' UNION ALL SELECT * FROM daily WHERE ftd_date >= DATE '1996-06-01'""",
    *_V,
)
def E6_cohort_replace(d: Data) -> DataFrame:
    daily = cohorts.cohort_daily(ftd(d), acts(d))
    # a cohort that is loaded again loses its old days
    old = daily.where("days_since < 40").withColumn("active_users", F.lit(0).cast("long"))
    return cohorts.cohort_replace(old, daily.where("ftd_date >= date '1996-06-01'"))


_ROLLUP = """SELECT {cohort} AS cohort, {by}, CAST(sum(cohort_size) AS BIGINT) AS cohort_size, CAST(sum(active_users) AS BIGINT) AS active_users, CAST(sum(ggr) AS DECIMAL(18,2)) AS ggr,
    CAST(round(CAST(sum(active_users) AS DOUBLE) * 100 / sum(cohort_size), 2) AS DECIMAL(9,2)) AS retention_rate FROM {table} GROUP BY 1, 2"""


@query(f"WITH f AS ({FTD_SQL}), {_DAYS} {_ROLLUP.format(cohort="CAST(date_trunc('month', ftd_date) AS DATE)", by='days_since', table='daily')}", *_V)
def E7_month_day(d: Data) -> DataFrame:
    return cohorts.month_rollup(cohorts.cohort_daily(ftd(d), acts(d)), "days_since")


@query(f"""WITH f AS ({FTD_SQL}), {_DAYS} {_ROLLUP.format(cohort="CAST(date_trunc('month', ftd_date) AS DATE)", by='"window"', table='windows')}""", *_V)
def E7_month_window(d: Data) -> DataFrame:
    return cohorts.month_rollup(cohorts.cohort_window(ftd(d), acts(d)), "window")


@query(f"""WITH f AS ({FTD_SQL}), {_DAYS} {_ROLLUP.format(cohort='ftd_date', by='"window"', table='windows')}""", *_V)
def E7_day_window(d: Data) -> DataFrame:
    return cohorts.month_rollup(cohorts.cohort_window(ftd(d), acts(d)), "window", month=False)


_VIEW = VIEW_SQL.format(as_of=KPI_DAY)
_PCT = "CAST(round(CAST({part} AS DOUBLE) * 100 / nullif({whole}, 0), 2) AS DECIMAL(12,2))"
_CHANGE = "CAST(round((CAST({a} AS DOUBLE) / nullif({b}, 0) - 1) * 100, 2) AS DECIMAL(12,2))"


def _change_sql(column: str, name: str) -> str:
    a, b = (f"count(*) FILTER ({column} = DATE '{KPI_DAY}' - {k})" for k in (1, 2))
    return f"SELECT {a} AS {name}, {_CHANGE.format(a=a, b=b)} AS {name}_change FROM v"


KPI_SQL = {
    "E8": _change_sql("registration_date", "registrations"),
    "E9": _change_sql("first_deposit", "first_deposits"),
    "E10": f"SELECT {_PCT.format(part='count(*) FILTER (has_deposit)', whole='count(*)')} AS conversion_d7 FROM v WHERE registration_date = DATE '{KPI_DAY}' - 7",
    "E11": f"""SELECT {_PCT.format(part='count(b.user_id)', whole='count(*)')} AS activation FROM v LEFT JOIN (SELECT DISTINCT user_id FROM v_user_daily WHERE ref_date = DATE '{KPI_DAY}' - 1
      AND (coalesce(bet_amount, 0) > 0 OR bet_qty > 0)) b ON v.id = b.user_id WHERE first_deposit = DATE '{KPI_DAY}' - 1""",
    "E13": f"SELECT {_PCT.format(part='count(*) FILTER (has_deposit AND recurrent_30d)', whole='count(*) FILTER (has_deposit)')} AS engaged FROM v",
    "E14": f"SELECT {_PCT.format(part='count(*) FILTER (has_deposit AND days_without_activity BETWEEN 30 AND 59)', whole='count(*) FILTER (has_deposit)')} AS churn_30_59 FROM v",
}


def _retention_sql(as_of: str) -> str:
    out = []
    for name, lag in (("D1", 1), ("D7", 7)):
        n, rate = name.lower(), "round(CAST(active_users AS DOUBLE) * 100 / cohort_size, 2)"
        now = f"""max({rate}) FILTER ("window" = '{name}' AND ftd_date = DATE '{as_of}' - {lag})"""
        mean = f"""avg({rate}) FILTER ("window" = '{name}' AND ftd_date BETWEEN DATE '{as_of}' - 30 AND DATE '{as_of}' - {lag})"""
        for value, label in ((now, ""), (mean, "_mean"), (f"{now} - {mean}", "_points")):
            out.append(f"CAST(round({value}, 2) AS DECIMAL(12,2)) AS retention_{n}{label}")
    return f"SELECT {', '.join(out)} FROM windows"


@query(f"WITH v AS ({_VIEW}) {KPI_SQL['E8']}", *_V)
def E8_kpi_registrations(d: Data) -> DataFrame:
    return cohorts.kpi_registrations(view(d, KPI_DAY), KPI_DAY)


@query(f"WITH v AS ({_VIEW}) {KPI_SQL['E9']}", *_V)
def E9_kpi_first_deposits(d: Data) -> DataFrame:
    return cohorts.kpi_first_deposits(view(d, KPI_DAY), KPI_DAY)


@query(f"WITH v AS ({_VIEW}) {KPI_SQL['E10']}", *_V)
def E10_kpi_conversion_d7(d: Data) -> DataFrame:
    return cohorts.kpi_conversion(view(d, KPI_DAY), KPI_DAY)


@query(f"WITH v AS ({_VIEW}) {KPI_SQL['E11']}", *_V)
def E11_kpi_activation(d: Data) -> DataFrame:
    return cohorts.kpi_activation(view(d, KPI_DAY), acts(d), KPI_DAY)


@query(f"WITH f AS ({FTD_SQL}), {_DAYS} {_retention_sql(KPI_DAY)}", *_V)
def E12_kpi_retention(d: Data) -> DataFrame:
    return cohorts.kpi_retention(cohorts.cohort_window(ftd(d), acts(d)), KPI_DAY)


@query(f"WITH v AS ({_VIEW}) {KPI_SQL['E13']}", *_V)
def E13_kpi_engaged(d: Data) -> DataFrame:
    return cohorts.kpi_engaged(view(d, KPI_DAY))


@query(f"WITH v AS ({_VIEW}) {KPI_SQL['E14']}", *_V)
def E14_kpi_churn_30_59(d: Data) -> DataFrame:
    return cohorts.kpi_churn(view(d, KPI_DAY))


def snapshot(d: Data, as_of: str, history: DataFrame | None = None) -> DataFrame:
    users = view(d, as_of)
    frames = [cohorts.kpi_users(users, as_of), cohorts.kpi_activation(users, acts(d), as_of), cohorts.kpi_retention(cohorts.cohort_window(ftd(d), acts(d)), as_of)]
    return cohorts.kpi_snapshot(frames, history, as_of)


@query(
    f"""WITH v AS ({_VIEW}), f AS ({FTD_SQL}), {_DAYS} SELECT DATE '{KPI_DAY}' AS run_date, * FROM ({KPI_SQL['E8']}), ({KPI_SQL['E9']}), ({KPI_SQL['E10']}), ({KPI_SQL['E11']}), ({_retention_sql(KPI_DAY)}),
      ({KPI_SQL['E13']}), ({KPI_SQL['E14']})
    UNION ALL SELECT DATE '{KPI_DAY}' - 1, 7, 1.5, 7, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5""",
    *_V,
)
def E15_kpi_snapshot(d: Data) -> DataFrame:
    fresh = snapshot(d, KPI_DAY)
    made_up = [F.lit(7 if kind == "bigint" else 1.5).cast(kind).alias(c) for c, kind in fresh.dtypes[1:]]
    history = d.spark.range(1).select(F.explode(F.array(F.date_sub(F.lit(KPI_DAY).cast("date"), 1), F.lit(KPI_DAY).cast("date"))).alias("run_date"), *made_up)
    return snapshot(d, KPI_DAY, history)


@query(
    f"""WITH f0 AS ({FTD_SQL}), f AS (SELECT * FROM f0 WHERE date_trunc('month', ftd_date) NOT IN (DATE '1996-02-01', DATE '1996-03-01')), {_DAYS}
    SELECT ftd_date, CAST(days_since AS VARCHAR) AS part, cohort_size, active_users, ggr FROM daily UNION ALL SELECT ftd_date, "window", cohort_size, active_users, ggr FROM windows""",
    *_V,
)
def E16_cohort_backfill(d: Data) -> DataFrame:
    loaded = ftd(d).where("ftd_date between date '1996-02-01' and date '1996-03-31'").select(F.trunc("ftd_date", "MM").alias("month")).distinct()
    daily, windows = cohorts.cohort_backfill(ftd(d), acts(d), loaded)
    return daily.withColumn("days_since", F.col("days_since").cast("string")).withColumnRenamed("days_since", "part").union(windows)
