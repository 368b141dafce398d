"""Reconciliation of sources with targets, and coverage checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playmart.functions.time import Window, day
from playmart.operators import cdc
from playmart.operators.tables import replace_by_keys

MONEY = "decimal(18,2)"
#: Totals that source and target are compared on.
COMPARED = ("deposits", "withdrawals", "bets", "registrations")


def _cash_by_day(cash: DataFrame) -> DataFrame:
    """cash: day, kind (deposit or withdraw), amount."""
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("amount"))).cast(MONEY)
    return cash.groupBy("day").agg(of("deposit").alias("deposits"), of("withdraw").alias("withdrawals"))


def _registrations(users: DataFrame) -> DataFrame:
    return users.groupBy(F.col("registration_date").alias("day")).agg(F.count("*").alias("registrations"))


def _by_day(parts: Sequence[DataFrame]) -> DataFrame:
    """Parts with a row for each of their days side by side: one aggregate over their union, of one row per day and part."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy("day").agg(*(F.max(c).alias(c) for c in rows.columns if c != "day"))


def target_daily_totals(cash: DataFrame, user_daily: DataFrame, games: DataFrame, users: DataFrame, period: tuple[date | str, date | str] | None = None) -> DataFrame:
    """Cash, user sums, game sums and registrations per day, whichever of them has the day."""
    per_user = user_daily.groupBy(F.col("ref_date").alias("day")).agg(F.sum("bet_amount").cast(MONEY).alias("user_bets"), F.sum("ggr").cast(MONEY).alias("ggr"))
    per_game = games.groupBy(F.to_date("local_hour").alias("day")).agg(F.sum("bet_total").cast(MONEY).alias("bets"))
    out = _by_day([_cash_by_day(cash), per_user, per_game, _registrations(users)])
    return out if period is None else out.where(F.col("day").between(day(period[0]), day(period[1])))


def source_daily_totals(bets: DataFrame, cash: DataFrame, users: DataFrame, how: str = "left") -> DataFrame:
    """Source totals per day: `left` keeps the days with bets only, `full_outer` all."""
    per_day = bets.groupBy(F.to_date("bet_time").alias("day")).agg(F.sum("bet_amount").cast(MONEY).alias("bets"), F.lit(True).alias("_bets"))
    out = _by_day([per_day, _cash_by_day(cash), _registrations(users)])
    return (out.where("_bets") if how == "left" else out).select("day", *COMPARED)


def recon_flags(joined: DataFrame, columns: Sequence[str] = COMPARED) -> DataFrame:
    """source_x against target_x: `wrong` on any difference and on a null of either side, else `right`."""
    flags = [F.when(F.coalesce(F.col(f"source_{c}") != F.col(f"target_{c}"), F.lit(True)), "wrong").otherwise("right").alias(f"{c}_check") for c in columns]
    return joined.select("*", *flags)


def reconcile(source: DataFrame, target: DataFrame, columns: Sequence[str] = COMPARED) -> DataFrame:
    s = source.select("day", *(F.col(c).alias(f"source_{c}") for c in columns))
    t = target.select("day", *(F.col(c).alias(f"target_{c}") for c in columns))
    return recon_flags(_by_day([s, t]), columns)


def recon_period(table: DataFrame, source: DataFrame, target: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """`table` with the days of the period compared again."""
    inside = F.col("day").between(day(start), day(end))
    return table.where(~inside).unionByName(reconcile(source.where(inside), target.where(inside)))


def _by_parts(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], parts: int) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    """Both sides' rows of the parts in which they differ, and both sides' other rows."""
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    def digests(df: DataFrame, side: str) -> DataFrame:
        row = F.xxhash64(*(F.coalesce(F.hash(c), F.lit(0)) for c in columns), *columns)
        found = df.select(part.alias("part"), row.alias("row")).groupBy("part")
        return found.agg(F.struct(F.count("*").alias("n"), F.sum(F.col("row").cast("decimal(20,0)")).alias("sum"), F.bit_xor("row").alias("xor")).alias(side))

    both = digests(left, "l").join(digests(right, "r"), "part", "full_outer")
    apart = F.broadcast(both.where(~F.col("l").eqNullSafe(F.col("r"))).select("part"))  # at most `parts` numbers
    of = lambda how: tuple(df.withColumn("part", part).join(apart, "part", how).drop("part") for df in (left, right))
    return of("left_semi"), of("left_anti")


def differing_parts(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], parts: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Both sides' rows of those parts of the keys in which they differ.

    Rows fall into `parts` by a hash of the key. A part's digest is the count, sum and exclusive or of its rows' hashes, in any
    order; so equal tables exchange one digest for each part and task, and rows move only where digests differ.
    """
    return _by_parts(left, right, key, columns, parts)[0]


def compare_results(left: DataFrame, right: DataFrame, key: str, on_date: str, on_value: str, updated: str, parts: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(differences, summary per kind) of two results, whose rows are joined only in parts that differ.

    Kinds: only_left, only_right, date, value. A difference of date or value is explained when the right row is newer.
    The summary also counts repeated keys of each side: those of the joined rows on the way, of the other parts by key alone.
    """

    def one(df: DataFrame, side: str) -> DataFrame:
        rows = cdc.latest_row(df.withColumn("_n", F.count("*").over(W.partitionBy(key))), [key], [updated, on_value])
        return rows.select(key, *(F.col(c).alias(f"{side}_{c}") for c in (on_date, on_value, updated)), F.lit(True).alias(f"_{side}"), F.col("_n").alias(f"_n_{side}"))

    apart, alike = _by_parts(left, right, key, [key, on_date, on_value, updated], parts)
    both = one(apart[0], "left").join(one(apart[1], "right"), key, "full_outer")
    newer = F.coalesce(F.col(f"right_{updated}") > F.col(f"left_{updated}"), F.lit(False))
    value = lambda side: F.round(F.col(f"{side}_{on_value}").cast("decimal(20,4)"), 2)
    kinds = [
        F.when(F.col("_right").isNull(), "only_left"), F.when(F.col("_left").isNull(), "only_right"),
        F.when(F.col("_left") & F.col("_right") & ~F.col(f"left_{on_date}").eqNullSafe(F.col(f"right_{on_date}")), "date"),
        F.when(F.col("_left") & F.col("_right") & ~value("left").eqNullSafe(value("right")), "value"),
    ]
    repeated = [F.when(F.col("_n_left") > 1, "repeated_left"), F.when(F.col("_n_right") > 1, "repeated_right")]
    diffs = both.select(key, F.explode(F.array_compact(F.array(*kinds))).alias("kind"), newer.alias("explained"))
    found = both.select(F.explode(F.array_compact(F.array(*kinds, *repeated))).alias("kind"), newer.alias("explained")).groupBy("kind")
    summary = found.agg(F.count("*").alias("n"), F.count_if(F.col("explained") & ~F.col("kind").startswith("repeated")).alias("explained"))
    for df, name in zip(alike, ("repeated_left", "repeated_right"), strict=True):  # one row each, also for none
        twice = df.groupBy(key).count().where("count > 1").agg(F.count("*").alias("n"))
        summary = summary.union(twice.select(F.lit(name), "n", F.lit(0).cast("long")))
    return diffs, summary.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("explained").alias("explained"))


def _labelled(df: DataFrame, column: str, windows: Sequence[tuple[date | str, date | str]]) -> DataFrame:
    """Rows within windows of whole days, both ends included, with the number of the first window that holds them."""
    listed = df.sparkSession.createDataFrame([(k, str(a)[:10], str(b)[:10]) for k, (a, b) in enumerate(windows)], "window_id int, a string, b string")
    days = listed.where(F.col("a") <= F.col("b")).select("window_id", F.explode(F.sequence(F.to_date("a"), F.to_date("b"))).alias("_day"))
    days = days.groupBy("_day").agg(F.min("window_id").alias("window_id"))
    return df.withColumn("_day", F.to_date(column)).join(F.broadcast(days), "_day").drop("_day")  # one row for each day


def _count_check(source: DataFrame, target: DataFrame, windows: int, spark_df: DataFrame, strict: bool) -> DataFrame:
    every = spark_df.sparkSession.range(windows).select(F.col("id").cast("int").alias("window_id"))
    n = lambda df, name: df.groupBy("window_id").agg(F.count_distinct("id").alias(name))
    out = every.join(n(source, "source_n"), "window_id", "left").join(n(target, "target_n"), "window_id", "left").na.fill(0, ["source_n", "target_n"])
    equal = F.col("source_n") == F.col("target_n")
    return out.withColumn("equal", F.when(~equal, F.raise_error(F.lit("source and target differ"))).otherwise(True) if strict else equal)


def window_count_check(grants: DataFrame, target: DataFrame, windows: Sequence[tuple[date | str, date | str]], column: str = "awarding_time", strict: bool = False) -> DataFrame:
    """Living ids per window against loaded ids; the last day counts to its end."""
    living = grants.where("is_deleted = 0")
    return _count_check(_labelled(living, column, windows), _labelled(target, column, windows), len(windows), grants, strict)


def window_count_check_null_time(grants: DataFrame, target: DataFrame, windows: Sequence[tuple[date | str, date | str]], strict: bool = False) -> DataFrame:
    """The same by creation time for ids that never had an awarding time."""
    living = cdc.latest_by_column(grants.where("is_deleted = 0"), ["id"], ["awarding_time", "creation_time"]).where("awarding_time is null")
    return _count_check(_labelled(living, "creation_time", windows), _labelled(target.where("awarding_time is null"), "creation_time", windows), len(windows), grants, strict)


def history_total(grants: DataFrame, target: DataFrame, window: Window, column: str = "awarding_time") -> DataFrame:
    n = lambda df, name: df.where(window.holds(column)).agg(F.count_distinct("id").alias(name))
    both = n(grants.where("is_deleted = 0"), "source_n").crossJoin(n(target, "target_n"))
    return both.withColumn("difference", F.col("source_n") - F.col("target_n"))


def history_by_day(source: DataFrame, target: DataFrame, column: str, amount: str, tolerance: str = "0.01") -> DataFrame:
    """Counts and sums per day of both sides, null as zero; divergent if counts differ or sums by more than the tolerance."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias(f"{name}_n"), F.sum(amount).cast(MONEY).alias(f"{name}_sum"))

    both = side(source, "source").join(side(target, "target"), "day", "full_outer")
    none = F.lit(0).cast(MONEY)
    both = both.select("day", *(F.coalesce(f"{s}_n", F.lit(0)).cast("long").alias(f"{s}_n") for s in ("source", "target")), *(F.coalesce(f"{s}_sum", none).alias(f"{s}_sum") for s in ("source", "target")))
    apart = F.abs(F.col("source_sum") - F.col("target_sum")) > F.lit(tolerance).cast(MONEY)
    return both.withColumn("diverges", (F.col("source_n") != F.col("target_n")) | apart)


def coverage_check(users: DataFrame, metrics: DataFrame, reactivation: DataFrame) -> DataFrame:
    """One row: sizes of three tables and users missing from two of them."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    ids = users.select(F.col("id").alias("user_id"))
    parts = [
        n(users, "users"), n(metrics, "metrics"), n(reactivation, "reactivation"), n(ids.join(metrics, "user_id", "left_anti"), "without_metrics"),
        n(ids.join(reactivation, "user_id", "left_anti"), "without_reactivation"),
    ]
    return reduce(DataFrame.crossJoin, parts)  # one row each


def missing_ids(source: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    return source.select(key).distinct().join(target.select(key), key, "left_anti")


def incomplete_ids(users: DataFrame, columns: Sequence[str], limit: int = 50_000, key: str = "id") -> DataFrame:
    """Ids with a null in any of the columns, and whether they are so many that a backfill should be used."""
    holes = users.where(reduce(Column.__or__, (F.col(c).isNull() for c in columns))).select(key)
    return holes.crossJoin(F.broadcast(holes.agg((F.count("*") > limit).alias("use_backfill"))))


def recon_replace(table: DataFrame, fresh: DataFrame) -> DataFrame:
    return replace_by_keys(table, fresh, ["day"])
