"""Windows for backfills, and the backfills as one job each."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import Window, day, hours, local_day, ts
from playmart.operators import activity, cdc, quality, source_marts
from playmart.operators.tables import upsert


def daily_profile(rows: DataFrame, column: str, window: Window | None = None, extra: Column | None = None) -> DataFrame:
    """Rows per day, before versions are resolved."""
    kept = rows if window is None else rows.where(window.holds(column))
    kept = kept if extra is None else kept.where(extra)
    return kept.where(F.col(column).isNotNull()).groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias("n"))


def window_plan(rows: DataFrame, column: str, limit: int = 900_000) -> DataFrame:
    """Day and window of every day with rows: consecutive days fill a window up to the limit; a larger day stands alone.

    The fold runs over one entry per day.
    """
    days = daily_profile(rows, column).agg(F.array_sort(F.collect_list(F.struct("day", "n"))).alias("days"))
    start = F.struct(F.lit(0).alias("id"), F.lit(0).cast("long").alias("held"), F.array().cast("array<struct<day:date,window_id:int>>").alias("out"))

    def step(acc: Column, d: Column) -> Column:
        fits = (acc["held"] == 0) | (acc["held"] + d["n"] <= limit)
        number = F.when(fits, acc["id"]).otherwise(acc["id"] + 1)
        return F.struct(
            number.alias("id"), F.when(fits, acc["held"] + d["n"]).otherwise(d["n"]).alias("held"),
            F.concat(acc["out"], F.array(F.struct(d["day"].alias("day"), number.alias("window_id")))).alias("out"),
        )

    return days.select(F.explode(F.aggregate("days", start, step)["out"]).alias("w")).select("w.day", "w.window_id")


def volume_windows(rows: DataFrame, column: str, limit: int = 900_000) -> DataFrame:
    """Rows with the `window_id` of their day."""
    plan = window_plan(rows, column, limit)
    return rows.withColumn("day", F.to_date(column)).join(F.broadcast(plan), "day").drop("day")


def filter_days(rows: DataFrame, column: str, start: datetime | str, end: datetime | str, offset_hours: int = -3) -> DataFrame:
    """Rows of the local days that [start, end) touches; an end at local midnight leaves its day out."""
    first = F.to_date(ts(start) + hours(offset_hours))
    edge = ts(end) + hours(offset_hours)
    last = F.greatest(first, F.when(edge == F.date_trunc("day", edge), F.date_sub(F.to_date(edge), 1)).otherwise(F.to_date(edge)))
    # as bounds on the column itself, so that the scan can skip what lies outside
    edges = (d.cast("timestamp_ntz") - hours(offset_hours) for d in (first, F.date_add(last, 1)))
    return rows.where((F.col(column) >= next(edges)) & (F.col(column) < next(edges)))


def fixed_windows(rows: DataFrame, column: str, start: date | str, end: date | str, days: int) -> DataFrame:
    """Rows of [start, end] with the number of their block of days."""
    d = F.to_date(column)
    return rows.where(d.between(day(start), day(end))).withColumn("window_id", F.floor(F.datediff(d, day(start)) / days).cast("int"))


def month_windows(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).withColumn("month", F.trunc(column, "MM"))


def backfill(grants: DataFrame, start: datetime | str, cut: datetime | str, limit: int = 900_000) -> tuple[DataFrame, DataFrame]:
    """(newest living grants awarded in [start, cut) with their window, count check per window)."""
    inside = grants.where(Window(start, cut).holds("awarding_time"))
    planned = volume_windows(inside, "awarding_time", limit)
    loaded = cdc.drop_deleted(planned, ["id"])
    n = lambda df, name: df.groupBy("window_id").agg(F.count_distinct("id").alias(name))
    # an id that was awarded again in another window is loaded with its newest row only
    newest = planned.where("is_deleted = 0").groupBy("id").agg(F.max_by("window_id", F.struct("version", "synced_at")).alias("window_id"))
    check = n(newest, "source_n").join(n(loaded, "target_n"), "window_id", "full_outer").na.fill(0)
    return loaded, check.withColumn("equal", F.col("source_n") == F.col("target_n"))


def backfill_null_time(grants: DataFrame, start: datetime | str, cut: datetime | str, windows: Sequence[tuple[date | str, date | str]]) -> tuple[DataFrame, DataFrame]:
    """(newest living grants created in [start, cut) without an awarding time, check per window)."""
    loaded = source_marts.user_bonus(grants, Window(start, cut), "creation_time", F.col("awarding_time").isNull())
    return loaded, quality.window_count_check_null_time(grants, loaded, windows)


def backfill_users(users: DataFrame, user_daily: DataFrame, as_of: date | str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(metrics, recurrence, reactivation, coverage) for all users at once."""
    everyone = users.select(F.col("id").alias("user_id"))
    metrics = activity.user_metrics(user_daily, everyone)
    nothing = metrics.limit(0).select("user_id", "last_activity", F.lit(None).cast("date").alias("last_reactivation"), F.lit(False).alias("reactivated"))
    back = activity.reactivation_state(nothing, activity.reactivation_events(user_daily, everyone, nothing))
    return metrics, activity.recurrence(user_daily, as_of), back, quality.coverage_check(users, metrics, back)


def user_backfill(target: DataFrame, users: DataFrame, cash: DataFrame, bets: DataFrame, ids: DataFrame) -> DataFrame:
    """Users of the ids put together again and merged."""
    parts = [f.join(ids, "id", "left_semi") for f in (users, cash, bets)]
    return upsert(target, source_marts.user_assemble(*parts), ["id"])


def balance_load(balances: DataFrame, target: DataFrame, mode: str, as_of: date | str, start: datetime | str | None = None, overlap_hours: int = 4) -> DataFrame:
    """Daily balances merged behind the freshness gate: by change time from the target's newest less the overlap, or by business time from `start`.

    Days that a change touches are computed over all their rows. A closed gate leaves the target as it is.
    """
    gate = source_marts.freshness_gate(balances, "created_at", as_of).select(F.col("gate").alias("_gate"))
    if mode == "changed":
        low = target.agg((F.max("updated_at") - hours(overlap_hours)).alias("_low"))
        touched = balances.crossJoin(F.broadcast(low)).where(F.col("_low").isNull() | (F.col("synced_at") > F.col("_low")))
        days = touched.select("client_id", local_day("created_at").alias("_day")).distinct()
        rows = balances.withColumn("_day", local_day("created_at")).join(days, ["client_id", "_day"], "left_semi").drop("_day")
    else:
        rows = balances.where(Window(start).holds("created_at"))
    fresh = source_marts.balance_daily(rows).crossJoin(F.broadcast(gate)).where("_gate = 'ok'").drop("_gate")
    return upsert(target, fresh, ["client_id", "ref_date"])


def suggest_start(grants: DataFrame, partner: int) -> DataFrame:
    return grants.where(F.col("partner_id") == partner).agg(F.min("creation_time").alias("first_creation"), F.count("*").alias("grants"))
