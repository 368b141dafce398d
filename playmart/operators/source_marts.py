"""Aggregates over versioned sources: bets, games, balances, payment keys, bonus grants, users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import Window, day, local_day, local_time
from playmart.operators import cdc

MONEY = "decimal(18,2)"
EXCLUDED_STATES, EXCLUDED_PRODUCT = (1, 4), 6
PAID_STATUSES, PAYMENT_TYPE = (7, 8, 12), 1
#: Balance types and the column each goes to.
BALANCE_TYPES = {1: "in_use", 2: "available", 3: "booking", 12: "bonus"}


def _countable_bets(bets: DataFrame, partner: int) -> DataFrame:
    return bets.where((F.col("is_deleted") == 0) & ~F.col("state").isin(*EXCLUDED_STATES) & (F.col("product_id") != EXCLUDED_PRODUCT) & (F.col("partner_id") == partner))


def edge_bet(bets: DataFrame, start: datetime | str, partner: int, first: bool, tz: str = "America/Sao_Paulo") -> DataFrame:
    """Per client that changed since `start`: day and amount of the first (or last) bet of the whole history."""
    mine = _countable_bets(bets, partner)
    touched = cdc.impacted_keys(mine, "client_id", "updated_at", Window(start, closed="neither"))
    pick, by = (F.min, F.min_by) if first else (F.max, F.max_by)
    order = F.struct("bet_time", "id")
    return (
        mine.join(touched, "client_id", "left_semi")
        .groupBy("client_id")
        .agg(F.to_date(local_time(pick("bet_time"), tz)).alias("bet_day"), by("bet_amount", order).alias("bet_amount"), F.max("updated_at").alias("updated_at"))
    )


def first_bet(bets: DataFrame, start: datetime | str, partner: int, **kw) -> DataFrame:
    return edge_bet(bets, start, partner, True, **kw)


def last_bet(bets: DataFrame, start: datetime | str, partner: int, **kw) -> DataFrame:
    return edge_bet(bets, start, partner, False, **kw)


def _totals(bets: DataFrame, clients: DataFrame) -> DataFrame:
    newest = cdc.latest_by_column(bets, ["id"], ["client_id", "bet_amount", "win_amount", "bonus_amount", "updated_at"])
    none = F.lit(0).cast(MONEY)
    positive = lambda c: F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).cast("long")
    total = lambda c: F.sum(F.coalesce(F.col(c), none)).cast(MONEY)
    return (
        newest.join(clients.select("client_id", "created_at"), "client_id")
        .groupBy("client_id")
        .agg(
            positive("bet_amount").alias("bet_qty"), total("bet_amount").alias("bet_total"), positive("win_amount").alias("win_qty"), total("win_amount").alias("win_total"),
            F.sum(F.coalesce("bet_amount", none) - F.coalesce("win_amount", none)).cast(MONEY).alias("ggr"),
            F.max("updated_at").alias("updated_at"), F.to_date(F.min("created_at")).alias("created_day"),
        )
    )


def bet_totals(bets: DataFrame, clients: DataFrame, start: datetime | str) -> DataFrame:
    """Lifetime bets of the clients whose newest row changed since `start`; clients: client_id, session, updated_at, created_at."""
    newest = cdc.distinct_on(clients, ["client_id"], ["session", "updated_at"]).where(Window(start, closed="neither").holds("updated_at"))
    return _totals(bets.join(newest, "client_id", "left_semi"), newest)


def bet_totals_for_ids(bets: DataFrame, clients: DataFrame, ids: DataFrame) -> DataFrame:
    """The same for given client ids."""
    newest = cdc.distinct_on(clients.join(ids, "client_id", "left_semi"), ["client_id"], ["session", "updated_at"])
    return _totals(bets.join(ids, "client_id", "left_semi"), newest)


def game_hourly(bets: DataFrame, products: DataFrame, start: datetime | str, partner: int, tz: str = "America/Sao_Paulo") -> DataFrame:
    """Per game and local hour. Filters on state, product and partner look at the newest values."""
    columns = ["product_id", "partner_id", "state", "bet_time", "bet_amount", "win_amount", "bonus_amount", "updated_at"]
    changed = cdc.impacted_keys(bets.where("is_deleted = 0"), "id", "updated_at", Window(start, closed="neither"))
    newest = cdc.latest_by_column(bets.where("is_deleted = 0").join(changed, "id", "left_semi"), ["id"], columns).withColumn("is_deleted", F.lit(0))
    return hourly(_countable_bets(newest, partner).join(products.select("product_id"), "product_id"), F.date_trunc("hour", local_time("bet_time", tz)).cast("timestamp_ntz"))


def hourly(bets: DataFrame, hour: Column) -> DataFrame:
    none = F.lit(0).cast(MONEY)
    positive = lambda c: F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).cast("long")
    return bets.groupBy("product_id", hour.alias("local_hour")).agg(
        positive("bonus_amount").alias("with_bonus"), positive("bet_amount").alias("bet_qty"), positive("win_amount").alias("win_qty"),
        F.sum("bet_amount").cast(MONEY).alias("bet_total"), F.sum("win_amount").cast(MONEY).alias("win_total"),
        F.sum(F.coalesce("bet_amount", none) - F.coalesce("win_amount", none)).cast(MONEY).alias("ggr"),
    )


def balance_daily(balances: DataFrame, types: Mapping[int, str] = BALANCE_TYPES, offset_hours: int = -3) -> DataFrame:
    """Newest balance per client, type and local day, one column per type and the total over all types."""
    newest = cdc.latest_per_bucket(balances, ["client_id", "type_id"], "created_at", ["synced_at", "event_id"], offset_hours)
    none = F.lit(0).cast(MONEY)
    columns = [F.sum(F.when(F.col("type_id") == k, F.col("balance")).otherwise(none)).cast(MONEY).alias(name) for k, name in types.items()]
    return newest.groupBy("client_id", F.col("local_day").alias("ref_date")).agg(*columns, F.sum("balance").cast(MONEY).alias("total"), F.max("synced_at").alias("updated_at"))


def balance_window(balances: DataFrame, window: Window, mode: str, offset_hours: int = -3) -> DataFrame:
    """balance_daily over `changed` rows (by synced_at) or `business` days (by created_at)."""
    if mode not in ("changed", "business"):
        raise ValueError(mode)
    return balance_daily(balances.where(window.holds("synced_at" if mode == "changed" else "created_at")), offset_hours=offset_hours)


def pix_usage_full(payments: DataFrame, partner: int, statuses: Sequence[int] = PAID_STATUSES) -> DataFrame:
    """Paid uses per client, key and key type; the status is that of the newest version."""
    newest = cdc.drop_deleted(payments.where(F.col("partner_id") == partner), ["id"])
    paid = newest.where(F.col("status").isin(*statuses) & F.col("pix_key").isNotNull())
    return paid.groupBy("client_id", "pix_key", "pix_type").agg(F.count("*").alias("uses"))


def pix_usage_incremental(payments: DataFrame, partner: int, window: Window, statuses: Sequence[int] = PAID_STATUSES) -> DataFrame:
    """The same for the clients that changed in the window, over all their payments."""
    touched = cdc.impacted_keys(payments.where(F.col("partner_id") == partner), "client_id", "synced_at", window)
    return pix_usage_full(payments.join(touched, "client_id", "left_semi"), partner, statuses)


def user_bonus(grants: DataFrame, window: Window, time: str = "synced_at", extra: Column | None = None) -> DataFrame:
    """Newest living grant within the half-open window; `extra` looks at the newest row."""
    newest = cdc.drop_deleted(grants.where(window.holds(time)), ["id"])
    return newest if extra is None else newest.where(extra)


def bonus_dim(bonuses: DataFrame, partner: int | None = None) -> DataFrame:
    """Newest living configuration of every bonus."""
    return cdc.drop_deleted(bonuses if partner is None else bonuses.where(F.col("partner_id") == partner), ["bonus_id"])


def bonus_product_bridge(bridge: DataFrame, bonuses: DataFrame, partner: int) -> DataFrame:
    """Newest bridge rows of the partner's living bonuses; several versions of a bonus do not multiply them."""
    mine = bonuses.where((F.col("partner_id") == partner) & (F.col("is_deleted") == 0)).select("bonus_id").distinct()
    return cdc.drop_deleted(bridge.join(mine, "bonus_id", "left_semi"), ["id"])


def trigger_ref_patch(grants: DataFrame, windows: Sequence[Window], columns: Sequence[str], time: str = "synced_at") -> DataFrame:
    """Newest values of a few columns within any of the windows, for an update of loaded grants."""
    inside = F.lit(False)
    for w in windows:
        inside |= w.holds(time)
    return cdc.drop_deleted(grants.where(inside), ["id"]).select("id", *columns)


def freshness_gate(df: DataFrame, time: str, as_of: date | str, offset_hours: int = -3) -> DataFrame:
    """One row: the newest local day, and `ok` if it is yesterday or later, `skip` a day late, `fail` beyond or without rows."""
    late = F.datediff(F.date_sub(day(as_of), 1), F.col("newest_day"))
    newest = df.agg(F.max(local_day(time, offset_hours)).alias("newest_day"))
    return newest.select("newest_day", late.cast("int").alias("days_late"), F.when(late <= 0, "ok").when(late == 1, "skip").otherwise("fail").alias("gate"))


def user_assemble(users: DataFrame, cash: DataFrame, bets: DataFrame, key: str = "id") -> DataFrame:
    return users.join(cash, key, "full_outer").join(bets, key, "full_outer")
