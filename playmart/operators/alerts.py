"""Alert detection, identity matching, and gates that decide what fires."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.time import EPOCH, day, hours, minutes, ts
from playmart.operators.tables import upsert

#: Criteria of identity, in order; all columns of one must be known and equal.
IDENTITY = (("tax_number",), ("phone",), ("first_name", "last_name", "birth_date"))


def detect_reuse(user_bonus: DataFrame, as_of: datetime | str, partner: int, window_hours: int = 24, least: int = 5) -> DataFrame:
    """(client, bonus) pairs with `least` grants or more in the last hours."""
    recent = user_bonus.where((F.col("partner_id") == partner) & (F.col("awarding_time") >= ts(as_of) - hours(window_hours)))
    return recent.groupBy("client_id", "bonus_id").agg(F.count("*").alias("value")).where(F.col("value") >= least)


def detect_rollover(user_bonus: DataFrame, first_day: date | str, partner: int, last_day: date | str | None = None, statuses: Sequence[int] = (6, 8)) -> DataFrame:
    """Grants in the statuses, updated on the day (or days), with turnover left."""
    on = F.to_date("synced_at").between(day(first_day), day(last_day or first_day))
    rows = user_bonus.where((F.col("partner_id") == partner) & F.col("status").isin(*statuses) & on & (F.col("turnover_left") > 0) & F.col("bonus_id").isNotNull())
    return rows.select("client_id", "bonus_id", "status", F.col("turnover_left").alias("value"), "synced_at")


def detect_burst(increment: DataFrame, as_of: datetime | str, window_minutes: int = 50, least: int = 5, time: str = "awarding_time", bonus: str = "bonus_id", prize: str = "bonus_prize") -> DataFrame:
    """Clients with `least` different bonuses or more in the last minutes, all without a prize (null counts as none)."""
    recent = increment.where((F.col(time) >= ts(as_of) - minutes(window_minutes)) & F.col("client_id").isNotNull())
    found = recent.groupBy("client_id").agg(
        F.count_distinct(bonus).alias("distinct_bonuses"), F.count(bonus).alias("value"), F.sum(F.coalesce(F.col(prize), F.lit(0))).alias("_prize")
    )
    return found.where((F.col("distinct_bonuses") >= least) & (F.col("_prize") == 0)).drop("_prize")


def detect_fresh_signup(increment: DataFrame, users: DataFrame, window_minutes: int = 50) -> DataFrame:
    """Clients whose first grant came within minutes of registration, without a deposit before it and without a withdrawal."""
    first = increment.groupBy("client_id").agg(F.min("awarding_time").alias("first_grant"))
    u = users.select(F.col("id").alias("client_id"), F.col("registration_date").cast("timestamp_ntz").alias("registered"), "first_deposit_date", "first_withdraw_date", *{c for cs in IDENTITY for c in cs})
    never = lambda c: F.col(c).isNull() | (F.col(c) == day(EPOCH))
    waited = F.col("first_grant") - F.col("registered")
    none_before = never("first_deposit_date") | (F.col("first_deposit_date").cast("timestamp_ntz") > F.col("first_grant"))
    mine = first.join(u, "client_id").where((waited >= minutes(0)) & (waited <= minutes(window_minutes)) & none_before & never("first_withdraw_date"))
    seconds = F.unix_micros(F.col("first_grant").cast("timestamp")) - F.unix_micros(F.col("registered").cast("timestamp"))
    value = F.round(seconds.cast("decimal(24,0)") / 60_000_000, 1).cast("decimal(12,1)")
    return mine.withColumn("value", value).drop("registered", "first_deposit_date", "first_withdraw_date")


def detect_new_account_shared_key(usage: DataFrame, users: DataFrame, as_of: datetime | str, window_hours: int = 24) -> DataFrame:
    """Pairs of a newly registered account and another account on the same active key that is not blank; each has a `value` of 1.

    Only keys that a new account holds take part, so a key that many share is paired with its new accounts only.
    """
    active = usage.where(F.col("is_active") & (F.trim("pix_key") != "")).select("client_id", "pix_key", "pix_type", "uses")
    u = users.select(F.col("id").alias("client_id"), "registration_date", F.col("status"))
    new = active.join(u.where(F.col("registration_date").cast("timestamp_ntz") >= ts(as_of) - hours(window_hours)), "client_id")
    other = active.join(u, "client_id", "left").select(
        "pix_key", F.col("client_id").alias("previous_client_id"), F.col("uses").alias("previous_uses"), F.col("registration_date").alias("previous_registration"), F.col("status").alias("previous_status"),
    )
    return new.join(other, "pix_key").where(F.col("previous_client_id") != F.col("client_id")).withColumn("value", F.lit(1))


def identity_match(candidates: DataFrame, alerted: DataFrame, criteria: Sequence[Sequence[str]] = IDENTITY, key: str = "client_id") -> DataFrame:
    """Candidates with `same_person`: the smallest earlier client that agrees on the first criterion to hit.

    Unknown values never match, and candidates are no earlier clients.
    """
    earlier = alerted.join(candidates.select(key), key, "left_anti")
    out, hits = candidates, []
    for k, columns in enumerate(criteria):
        known = F.lit(True)
        for c in columns:
            known &= F.col(c).isNotNull()
        ids = earlier.where(known).groupBy(*columns).agg(F.min(key).alias(f"_same{k}"))
        out = out.join(ids, list(columns), "left")
        hits.append(f"_same{k}")
    return out.withColumn("same_person", F.coalesce(*hits)).drop(*hits)


def alert_key(columns: Sequence[str]) -> Column:
    return F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def _with_log(cases: DataFrame, log: DataFrame, report: str, key: Column) -> DataFrame:
    mine = log.where(F.col("report") == report).select("key", F.lit(True).alias("_logged"), "ref_value", "last_fired", "times")
    return cases.withColumn("key", key).join(mine, "key", "left")


def _log_rows(fired: DataFrame, report: str, as_of: datetime | str) -> DataFrame:
    return fired.select(
        F.lit(report).alias("report"), "key", F.col("value").cast("decimal(18,2)").alias("ref_value"), ts(as_of).alias("last_fired"), (F.coalesce("times", F.lit(0)) + 1).cast("int").alias("times")
    )


def alert_gate(cases: DataFrame, log: DataFrame, report: str, key_columns: Sequence[str], escalate: bool, as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
    """(queue, log rows): a key fires once a day, with `escalate` again when its value has grown."""
    known = _with_log(cases, log, report, alert_key(key_columns))
    today = F.coalesce(F.to_date("last_fired") == F.to_date(ts(as_of)), F.lit(False))
    grown = F.coalesce(F.col("value") > F.col("ref_value"), F.lit(False)) if escalate else F.lit(False)
    fired = known.where(~today | grown)
    queue = fired.select(F.lit(report).alias("report"), *cases.columns)
    return queue, _log_rows(fired, report, as_of)


def signup_gate(cases: DataFrame, log: DataFrame, report: str, as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
    """(queue, log rows) with `kind`: repeat_client (fired on an earlier day), repeat_identity, or new; a key fires once a day."""
    known = _with_log(cases, log, report, alert_key(["client_id"]))
    today = F.coalesce(F.to_date("last_fired") == F.to_date(ts(as_of)), F.lit(False))
    kind = F.when(F.col("_logged"), "repeat_client").when(F.col("same_person").isNotNull(), "repeat_identity").otherwise("new")
    fired = known.where(~today)
    queue = fired.select(F.lit(report).alias("report"), *cases.columns, kind.alias("kind"), F.col("last_fired").alias("fired_before"), F.col("times").alias("times_before"))
    return queue, _log_rows(fired, report, as_of)


def alert_log_upsert(log: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(log, rows, ["report", "key"])
