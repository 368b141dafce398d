"""Daily activity, lifetime metrics, recurrence and reactivation of users."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playmart.functions.time import FLOOR, day
from playmart.operators.tables import replace_by_keys, update_then_insert

MONEY = "decimal(18,2)"
KINDS = ("bet", "deposit", "withdraw", "bonus")


def _does(kind: str) -> Column:
    return (F.coalesce(F.col(f"{kind}_amount"), F.lit(0)) > 0) | (F.coalesce(F.col(f"{kind}_qty"), F.lit(0)) > 0)


def _active() -> Column:
    """A bonus alone is no activity."""
    return _does("bet") | _does("deposit") | _does("withdraw")


def activity_daily(user_daily: DataFrame, impacted: DataFrame | None = None) -> DataFrame:
    """One row per active user and day, with flags and nulls as zero."""
    rows = user_daily if impacted is None else user_daily.join(impacted, "user_id", "left_semi")
    amounts = [F.coalesce(c, F.lit(0).cast(MONEY)).alias(c) for k in KINDS for c in (f"{k}_amount",)]
    counts = [F.coalesce(f"{k}_qty", F.lit(0)).cast("long").alias(f"{k}_qty") for k in KINDS]
    flags = [_does(k).alias(f"has_{k}") for k in KINDS]
    return rows.where(F.col("ref_date").isNotNull() & _active()).select("user_id", "ref_date", *amounts, *counts, *flags, F.coalesce("ggr", F.lit(0).cast(MONEY)).alias("ggr"))


def activity_daily_replace(activity: DataFrame, stage: DataFrame) -> DataFrame:
    return replace_by_keys(activity, stage, ["user_id", "ref_date"])


def user_metrics(user_daily: DataFrame, impacted: DataFrame | None = None) -> DataFrame:
    """Lifetime dates and totals over the full history of the impacted users."""
    rows = user_daily if impacted is None else user_daily.join(impacted, "user_id", "left_semi")
    at = lambda test: F.when(test, F.col("ref_date"))
    totals = [
        F.sum(F.coalesce(f"{k}_{c}", F.lit(0))).cast(kind).alias(f"total_{k}_{c}") for k in ("bet", "deposit", "withdraw") for c, kind in (("amount", MONEY), ("qty", "long"))
    ]
    return rows.groupBy("user_id").agg(
        F.min(at(_does("bet"))).alias("first_bet"), F.min(at(_does("deposit"))).alias("first_deposit"), F.coalesce(F.max(_does("bet")), F.lit(False)).alias("ever_bet"),
        F.max(at(_does("bet"))).alias("last_bet"), F.max(at(_does("deposit"))).alias("last_deposit"), F.max(at(_does("withdraw"))).alias("last_withdraw"),
        F.max(at(_active())).alias("last_activity"), F.sum(F.coalesce("ggr", F.lit(0))).cast(MONEY).alias("lifetime_ggr"), *totals,
    )


def user_metrics_replace(metrics: DataFrame, stage: DataFrame) -> DataFrame:
    return replace_by_keys(metrics, stage, ["user_id"])


def recurrence(user_daily: DataFrame, as_of: date | str, days: int = 30, min_days: int = 2) -> DataFrame:
    """Distinct active days since `as_of` less `days`; recurrent from `min_days`."""
    recent = user_daily.where(_active() & (F.col("ref_date") >= F.date_sub(day(as_of), days)))
    active = F.count_distinct("ref_date")
    return recent.groupBy("user_id").agg(active.alias("active_days"), (active >= min_days).alias("recurrent"))


def reactivation_events(user_daily: DataFrame, impacted: DataFrame, state: DataFrame, gap: int = 30, since: date | str | None = None) -> DataFrame:
    """Per impacted user the last active day and the last day after a gap of `gap` days or more.

    The day before a user's first one (since `since`, if given) is the state's last activity.
    """
    rows = user_daily.where(_active()).join(impacted, "user_id", "left_semi")
    if since is not None:
        rows = rows.where(F.col("ref_date") >= day(since))
    before = F.lag("ref_date").over(W.partitionBy("user_id").orderBy("ref_date"))
    days = rows.select("user_id", "ref_date").distinct().withColumn("before", before)
    days = days.join(state.select("user_id", F.col("last_activity").alias("saved")), "user_id", "left").withColumn("before", F.coalesce("before", "saved"))
    back = F.max(F.when(F.datediff("ref_date", "before") >= gap, F.col("ref_date")))
    return days.groupBy("user_id").agg(F.max("ref_date").alias("last_activity"), back.alias("last_reactivation"), back.isNotNull().alias("reactivated"))


def reactivation_state(state: DataFrame, events: DataFrame, null_floor: bool = False) -> DataFrame:
    """The next state: known users keep the later reactivation, new ones come as they are.

    A known user without any reactivation gets the floor date; with `null_floor` it stays null.
    """
    floor = day(FLOOR)
    later = F.greatest(F.coalesce("old_last_reactivation", floor), F.coalesce("new_last_reactivation", floor))
    if null_floor:
        later = F.when(later != floor, later)
    update = {"last_activity": F.col("new_last_activity"), "last_reactivation": later, "reactivated": F.col("old_reactivated") | F.col("new_reactivated")}
    return update_then_insert(state, events, ["user_id"], update)


def user_view(users: DataFrame, metrics: DataFrame, recurrent: DataFrame, ftd: DataFrame, as_of: date | str) -> DataFrame:
    """One row per user for indicators (definition inferred from its uses)."""
    m = metrics.select(F.col("user_id").alias("id"), "last_activity")
    r = recurrent.select(F.col("user_id").alias("id"), "recurrent")
    joined = users.select("id", "registration_date").join(ftd.select(F.col("user_id").alias("id"), "ftd_date"), "id", "left").join(m, "id", "left").join(r, "id", "left")
    has = F.coalesce(F.col("ftd_date") != day("1970-01-01"), F.lit(False))
    return joined.select(
        "id", "registration_date", F.when(has, F.col("ftd_date")).alias("first_deposit"), has.alias("has_deposit"), F.coalesce("recurrent", F.lit(False)).alias("recurrent_30d"),
        F.datediff(day(as_of), "last_activity").alias("days_without_activity"),
    )
