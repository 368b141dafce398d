"""Bonus grants per client: aggregates, cut-offs, risk score and a persistent watchlist."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.scratch import written
from playmart.functions.time import day
from playmart.operators.tables import update_then_insert, upsert

MONEY = "decimal(18,2)"
PAIR = ["client_id", "bonus_id"]
#: Signals and the metric each cuts.
SIGNALS = {"grants": "grants", "cost": "cost", "reuse": "max_reuse", "turnover": "turnover_left"}


def impacted_pairs(increment: DataFrame) -> DataFrame:
    return increment.select(*PAIR).dropna().distinct()


def bonus_agg(user_bonus: DataFrame, pairs: DataFrame | None = None, changed: Column | None = None) -> DataFrame:
    """Per (client, bonus) over the full history of the impacted pairs; a sum of nulls only stays null.

    Impacted are `pairs`, or the pairs with a row that `changed` holds for: the same aggregate finds them, so the history is read once.
    """
    rows = user_bonus.dropna(subset=PAIR) if pairs is None else user_bonus.join(pairs, PAIR, "left_semi")
    out = _bonus_agg(rows, F.lit(True) if changed is None else F.coalesce(changed, F.lit(False)))
    return (out if changed is None else out.where("_changed")).drop("_changed")


def _bonus_agg(rows: DataFrame, changed: Column) -> DataFrame:
    return rows.groupBy(*PAIR).agg(
        F.bool_or(changed).alias("_changed"),
        F.max("partner_id").alias("partner_id"), F.count("*").alias("grants"), F.sum("bonus_prize").cast(MONEY).alias("prize"), F.sum("cost").cast(MONEY).alias("cost"),
        F.max("reuse_number").alias("max_reuse"), F.sum("turnover_left").cast(MONEY).alias("turnover_left"), F.min("awarding_time").alias("first_award"),
        F.max("awarding_time").alias("last_award"), F.max("synced_at").alias("source_updated_at"),
    )


def bonus_agg_upsert(agg: DataFrame, stage: DataFrame) -> DataFrame:
    return upsert(agg, stage, PAIR)


def stale_pairs(user_bonus: DataFrame, agg: DataFrame, as_of: date | str, days: int = 2) -> DataFrame:
    """Pairs with an update of the last days that the aggregate lacks or holds an older state of."""
    newest = user_bonus.dropna(subset=PAIR).groupBy(*PAIR).agg(F.max("synced_at").alias("newest"))
    recent = newest.where(F.col("newest") >= F.date_sub(day(as_of), days).cast("timestamp_ntz"))
    held = agg.select(*PAIR, "source_updated_at")
    return recent.join(held, PAIR, "left").where(F.col("source_updated_at").isNull() | (F.col("source_updated_at") < F.col("newest"))).select(*PAIR)


def client_bonus_metrics(agg: DataFrame) -> DataFrame:
    none = F.lit(0).cast(MONEY)
    return agg.groupBy("client_id", "partner_id").agg(
        F.sum("grants").cast("long").alias("grants"), F.coalesce(F.sum("cost"), none).cast(MONEY).alias("cost"), F.max("max_reuse").alias("max_reuse"),
        F.coalesce(F.sum("turnover_left"), none).cast(MONEY).alias("turnover_left"),
    )


#: Values that the last step of a selection ranks, and the accuracy of the sketches before.
RANKED, ACCURACY = 10_000, 10_000


def exact_percentiles(df: DataFrame, columns: Sequence[str], q: float, ranked: int = RANKED, accuracy: int = ACCURACY) -> dict[str, float | None]:
    """Interpolated percentiles of columns as `percentile` gives them, by narrowing a bracket around the ranks.

    A sketch of the values in the bracket gives two of them that surely enclose the rank, within a few of its `accuracy`-th parts;
    they are the next bracket, until its values are few enough to be ranked, or are nearly all equal. So no task holds a counter
    for every value. Nulls do not count; no values: None.
    """
    rows = written(df.select(*(F.col(c).cast("double").alias(c) for c in columns)), "selection")
    seen = rows.agg(*(f(c).alias(f"{n}{k}") for k, c in enumerate(columns) for n, f in (("n", F.count), ("low", F.min), ("high", F.max)))).first()
    share, done = {}, set()
    # of each column: the bracket's ends, the number of its values, the rank of the lower value among them
    held: dict[str, tuple[float, float, int, int]] = {}
    for k, c in enumerate(columns):
        if n := seen[f"n{k}"]:
            share[c] = (n - 1) * q - math.floor((n - 1) * q)
            held[c] = seen[f"low{k}"], seen[f"high{k}"], n, math.floor((n - 1) * q)

    def inside(c: str, low: float, high: float) -> Column:
        return F.when(F.col(c).between(low, high), F.col(c))

    while wide := [c for c, (low, high, n, _) in held.items() if c not in done and n > ranked and low < high]:
        ends = {}
        for c in wide:
            low, high, n, rank = held[c]
            around = F.array(F.lit(max(0.0, rank / n - 2 / accuracy)), F.lit(min(1.0, (rank + 2) / n + 2 / accuracy)))
            ends[c] = F.percentile_approx(inside(c, low, high), around, accuracy)
        found = rows.agg(*(e.alias(f"e{k}") for k, e in enumerate(ends.values()))).first()
        new = {c: found[k] for k, c in enumerate(wide)}
        counts = rows.agg(*(x for c in wide for x in (F.count_if((F.col(c) >= held[c][0]) & (F.col(c) < new[c][0])), F.count(inside(c, *new[c]))))).first()
        for k, c in enumerate(wide):
            low, high, n, rank = held[c]
            below, within = counts[2 * k], counts[2 * k + 1]
            sure = below <= rank and min(rank + 1, n - 1) < below + within
            if not sure or within > n // 2:
                done.add(c)  # most values are equal to an end: few are different
            if sure:
                held[c] = *new[c], within, rank - below
    out: dict[str, float | None] = dict.fromkeys(columns)
    if held:
        each = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), inside(c, low, high).alias("v")) for c, (low, high, _, _) in held.items())))
        values: dict[str, list] = {}
        for r in rows.select(each.alias("x")).select("x.*").where("v is not null").groupBy("c", "v").count().collect():
            values.setdefault(r["c"], []).append((r["v"], r["count"]))
        for c, (_, _, n, rank) in held.items():
            pair, before = [], 0
            for v, count in sorted(values[c]):
                pair += [v for k in (rank, min(rank + 1, n - 1)) if before <= k < before + count]
                before += count
            out[c] = pair[0] if not share[c] else (1 - share[c]) * pair[0] + share[c] * pair[1]
    return out


def p99_cutoffs(metrics: DataFrame, q: float = 0.99, exact: bool = True) -> DataFrame:
    """(signal, cutoff): exact interpolated percentiles of the four metrics over all clients; `exact=False` takes a sketch's."""
    if exact:
        found = exact_percentiles(metrics, list(SIGNALS.values()), q)
        rows = metrics.sparkSession.createDataFrame([(s, found[m]) for s, m in SIGNALS.items()], "signal string, cutoff double")
    else:
        sketches = metrics.agg(*(F.percentile_approx(F.col(m).cast("double"), q, 100_000).cast("double").alias(s) for s, m in SIGNALS.items()))
        rows = sketches.unpivot([], list(SIGNALS), "signal", "cutoff")
    return rows.select("signal", F.round("cutoff", 6).alias("cutoff"))


def daily_cutoff_cache(cache: DataFrame, metrics: DataFrame, as_of: date | str) -> DataFrame:
    """The cache with today's cut-offs: those it has, if it has all four, else new ones."""
    today = F.col("day") == day(as_of)
    complete = cache.where(today).agg((F.count("*") >= len(SIGNALS)).alias("complete"))
    fresh = p99_cutoffs(metrics).select(day(as_of).alias("day"), "signal", "cutoff").crossJoin(F.broadcast(complete)).where(~F.col("complete")).drop("complete")
    kept = cache.crossJoin(F.broadcast(complete)).where(F.col("complete") | ~today).drop("complete")
    return kept.unionByName(fresh)


def risk_score(metrics: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """One point for every metric strictly above its cut-off; a null metric gives none."""
    row = cutoffs.groupBy().pivot("signal", list(SIGNALS)).agg(F.first("cutoff"))
    row = row.select(*(F.col(s).alias(f"_cut_{s}") for s in SIGNALS))
    points: Column = F.lit(0)
    for s, m in SIGNALS.items():
        points = points + F.when(F.col(m).cast("double") > F.col(f"_cut_{s}"), 1).otherwise(0)
    return metrics.crossJoin(F.broadcast(row)).select(*metrics.columns, points.cast("int").alias("score"))


KEYS = ["client_id", "partner_id"]


def watchlist_update(watchlist: DataFrame, scored: DataFrame, as_of: date | str, min_score: int = 2) -> DataFrame:
    """The next watchlist: known clients move on, new ones come in.

    score, previous_score, crossed, days_flagged, first_alert, last_alert. A second run on a day counts no day twice.
    """
    today, high = day(as_of), F.col("new_score") >= min_score
    first_today = high & (F.col("old_last_alert").isNull() | (F.col("old_last_alert") != today))
    update = {
        "score": F.col("new_score"),
        "previous_score": F.col("old_score"),
        "crossed": high & (F.col("old_score") < min_score),
        "days_flagged": F.col("old_days_flagged") + F.when(first_today, 1).otherwise(0),
        "first_alert": F.coalesce("old_first_alert", F.when(high, today)),
        "last_alert": F.when(high, today).otherwise(F.col("old_last_alert")),
    }
    insert = {
        "previous_score": F.lit(None).cast("int"), "crossed": high, "days_flagged": F.when(high, 1).otherwise(0), "first_alert": F.when(high, today), "last_alert": F.when(high, today),
    }
    return update_then_insert(watchlist, scored.select(*KEYS, "score"), KEYS, update, insert)


def watchlist_insert(watchlist: DataFrame, scored: DataFrame, as_of: date | str, min_score: int = 2) -> DataFrame:
    """The rows that new clients bring to the watchlist."""
    return watchlist_update(watchlist.limit(0), scored.join(watchlist, KEYS, "left_anti"), as_of, min_score)
