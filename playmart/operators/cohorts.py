"""Cohorts by first deposit: size, retention, value, rollups; daily indicators."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import EPOCH, day
from playmart.operators.tables import replace_by_keys

MONEY = "decimal(18,2)"
HORIZON = 90
#: Windows of days since the first deposit; they do not overlap.
WINDOWS: Mapping[str, tuple[int, int]] = {"D1": (1, 1), "D7": (2, 7), "D30": (8, 30), "D60": (31, 60), "D90": (61, 90)}


def first_deposit_date(users: DataFrame, metrics: DataFrame) -> DataFrame:
    """The source's date unless it says never, then the one the facts show; never stays 1970-01-01."""
    m = metrics.select(F.col("user_id").alias("id"), "first_deposit")
    never = day(EPOCH)
    return users.join(m, "id", "left").select(
        F.col("id").alias("user_id"), F.coalesce(F.when(F.col("first_deposit_date") != never, F.col("first_deposit_date")), F.col("first_deposit"), never).alias("ftd_date")
    )


def affected_cohorts(ftd: DataFrame, impacted: DataFrame, as_of: date | str, horizon: int = HORIZON) -> DataFrame:
    mine = ftd.join(impacted, "user_id", "left_semi")
    return mine.where((F.col("ftd_date") != day(EPOCH)) & (F.col("ftd_date") >= F.date_sub(day(as_of), horizon))).select("ftd_date").distinct()


def _deposited(ftd: DataFrame) -> DataFrame:
    return ftd.where(F.col("ftd_date") != day(EPOCH))


def cohort_size(ftd: DataFrame) -> DataFrame:
    """Users per cohort, those without activity too."""
    return _deposited(ftd).groupBy("ftd_date").agg(F.count_distinct("user_id").alias("cohort_size"))


def _days(ftd: DataFrame, activity: DataFrame, last: int) -> DataFrame:
    since = F.datediff("ref_date", "ftd_date")
    return _deposited(ftd).join(activity, "user_id").where(since.between(0, last)).withColumn("days_since", since)


def cohort_daily(ftd: DataFrame, activity: DataFrame, max_day: int = HORIZON) -> DataFrame:
    """Active users and value per cohort and day since; days without activity make no row."""
    # one row per user and day is what activity holds, so users are counted, not told apart
    per_user = _days(ftd, activity, max_day).groupBy("ftd_date", "days_since", "user_id").agg(F.sum("ggr").alias("ggr"))
    rows = per_user.groupBy("ftd_date", "days_since").agg(F.count("*").alias("active_users"), F.sum("ggr").cast(MONEY).alias("ggr"))
    return rows.join(cohort_size(ftd), "ftd_date").select("ftd_date", "days_since", "cohort_size", "active_users", "ggr")


def window_label(days_since: Column, windows: Mapping[str, tuple[int, int]] = WINDOWS) -> Column:
    out = F.lit(None).cast("string")
    for name, (low, high) in windows.items():
        out = F.when(days_since.between(low, high), name).otherwise(out)
    return out


def cohort_window(ftd: DataFrame, activity: DataFrame, windows: Mapping[str, tuple[int, int]] = WINDOWS) -> DataFrame:
    """Users active in each window, once each, and its value."""
    days = _days(ftd, activity, max(high for _, high in windows.values()))
    per_user = days.withColumn("window", window_label(F.col("days_since"), windows)).where("window is not null").groupBy("ftd_date", "window", "user_id").agg(F.sum("ggr").alias("ggr"))
    rows = per_user.groupBy("ftd_date", "window").agg(F.count("*").alias("active_users"), F.sum("ggr").cast(MONEY).alias("ggr"))
    return rows.join(cohort_size(ftd), "ftd_date").select("ftd_date", "window", "cohort_size", "active_users", "ggr")


def cohort_replace(target: DataFrame, stage: DataFrame) -> DataFrame:
    return replace_by_keys(target, stage, ["ftd_date"])


def month_rollup(cohorts: DataFrame, by: str, month: bool = True) -> DataFrame:
    """Sums over the month (or day) of the cohorts per `by` (days_since or window), rate in percent."""
    start = (F.trunc("ftd_date", "MM") if month else F.col("ftd_date")).alias("cohort")
    rate = F.round(F.sum("active_users").cast("decimal(18,0)") * 100 / F.sum("cohort_size"), 2).cast("decimal(9,2)")
    return cohorts.groupBy(start, by).agg(
        F.sum("cohort_size").cast("long").alias("cohort_size"), F.sum("active_users").cast("long").alias("active_users"), F.sum("ggr").cast(MONEY).alias("ggr"), rate.alias("retention_rate")
    )


def cohort_backfill(ftd: DataFrame, activity: DataFrame, loaded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """cohort_daily and cohort_window of all months in one pass; months in `loaded` (month) are skipped."""
    wanted = ftd
    if loaded is not None:
        wanted = ftd.withColumn("month", F.trunc("ftd_date", "MM")).join(loaded, "month", "left_anti").drop("month")
    return cohort_daily(wanted, activity), cohort_window(wanted, activity)


def _percent(part: Column, whole: Column) -> Column:
    return F.round(part.cast("decimal(18,0)") * 100 / F.nullif(whole, F.lit(0)), 2).cast("decimal(12,2)")


def _day_and_before(column: str, as_of: date | str, name: str) -> list[Column]:
    now = F.count(F.when(F.col(column) == F.date_sub(day(as_of), 1), 1))
    before = F.count(F.when(F.col(column) == F.date_sub(day(as_of), 2), 1))
    return [now.alias(name), F.round((now.cast("decimal(18,0)") / F.nullif(before, F.lit(0)) - 1) * 100, 2).cast("decimal(12,2)").alias(f"{name}_change")]


def _conversion(as_of: date | str, lag: int) -> Column:
    mine = F.col("registration_date") == F.date_sub(day(as_of), lag)
    return _percent(F.count(F.when(mine & F.col("has_deposit"), 1)), F.count(F.when(mine, 1))).alias("conversion_d7")


def _of_depositors(part: Column, name: str) -> Column:
    return _percent(F.count(F.when(F.col("has_deposit") & part, 1)), F.count(F.when(F.col("has_deposit"), 1))).alias(name)


def _engaged() -> Column:
    return _of_depositors(F.col("recurrent_30d"), "engaged")


def _churn(low: int, high: int) -> Column:
    return _of_depositors(F.col("days_without_activity").between(low, high), "churn_30_59")


def kpi_registrations(view: DataFrame, as_of: date | str) -> DataFrame:
    return view.agg(*_day_and_before("registration_date", as_of, "registrations"))


def kpi_first_deposits(view: DataFrame, as_of: date | str) -> DataFrame:
    return view.agg(*_day_and_before("first_deposit", as_of, "first_deposits"))


def kpi_conversion(view: DataFrame, as_of: date | str, lag: int = 7) -> DataFrame:
    """Percent of the users registered `lag` days ago who have deposited."""
    return view.agg(_conversion(as_of, lag))


def kpi_users(view: DataFrame, as_of: date | str, lag: int = 7, low: int = 30, high: int = 59) -> DataFrame:
    """The indicators that need nothing but the user view, in one pass over it."""
    return view.agg(*_day_and_before("registration_date", as_of, "registrations"), *_day_and_before("first_deposit", as_of, "first_deposits"), _conversion(as_of, lag), _engaged(), _churn(low, high))


def kpi_activation(view: DataFrame, activity: DataFrame, as_of: date | str) -> DataFrame:
    """Percent of yesterday's first depositors who bet yesterday."""
    yesterday = F.date_sub(day(as_of), 1)
    bets = activity.where((F.col("ref_date") == yesterday) & F.col("has_bet")).select(F.col("user_id").alias("id"), F.lit(True).alias("bet")).distinct()
    mine = view.where(F.col("first_deposit") == yesterday).select("id").distinct().join(bets, "id", "left")
    return mine.agg(_percent(F.count("bet"), F.count("id")).alias("activation"))


def kpi_retention(windows: DataFrame, as_of: date | str) -> DataFrame:
    """Rates of one cohort, their means over cohorts of the last 30 days, and the difference in points.

    D1 looks at the cohort of yesterday, whose first day is not over; kept as the source does.
    """
    rate = F.col("active_users").cast("decimal(18,0)") * 100 / F.col("cohort_size")
    out = []
    for name, lag in (("D1", 1), ("D7", 7)):
        at = F.date_sub(day(as_of), lag)
        now = F.max(F.when((F.col("window") == name) & (F.col("ftd_date") == at), F.round(rate, 2)))
        mean = F.avg(F.when((F.col("window") == name) & F.col("ftd_date").between(F.date_sub(day(as_of), 30), at), F.round(rate, 2)))
        n = name.lower()
        out += [
            now.cast("decimal(12,2)").alias(f"retention_{n}"), F.round(mean, 2).cast("decimal(12,2)").alias(f"retention_{n}_mean"),
            F.round(now - mean, 2).cast("decimal(12,2)").alias(f"retention_{n}_points"),
        ]
    return windows.agg(*out)


def kpi_engaged(view: DataFrame) -> DataFrame:
    return view.agg(_engaged())


def kpi_churn(view: DataFrame, low: int = 30, high: int = 59) -> DataFrame:
    return view.agg(_churn(low, high))


def kpi_snapshot(frames: list[DataFrame], history: DataFrame | None, as_of: date | str) -> DataFrame:
    """One row of all indicators for the run date, in the place of an earlier one of that date."""
    row = frames[0]
    for f in frames[1:]:
        row = row.crossJoin(f)  # one row each
    row = row.select(day(as_of).alias("run_date"), "*")
    return row if history is None else replace_by_keys(history, row, ["run_date"])
