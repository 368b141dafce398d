"""The hourly jobs as streams: merge, burst, reuse, alert gate, game hours, late rows."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from playmart.functions.scratch import shared_path
from playmart.functions.time import hours
from playmart.operators import alerts, cdc, source_marts
from playmart.operators.tables import upsert


class KeyedTable:
    """A table in a folder, dealt into buckets by a hash of its keys: the rows that each batch changed, one per key, and whole
    buckets, of which those with changes are put in order once every EPOCH batches.

    Who names a batch reads the buckets of its keys alone. Batches count from 0 without a gap, as a query's do. A batch that
    runs again takes the place of its first run. Places are used in turn, so the folder holds each bucket twice and the changes
    of two epochs, and a reader has an epoch to finish. A change of a key replaces its row; null keys are equal.
    `by`: the keys that the hash takes, so that rows equal in them share a bucket; else all.
    """

    EPOCH = 16

    def __init__(self, spark: SparkSession, path: str, schema, keys: Sequence[str], buckets: int = 16, by: Sequence[str] | None = None) -> None:
        self.spark, self.path, self.keys, self.buckets, self.by = spark, path, list(keys), buckets, list(by or keys)
        empty = spark.createDataFrame([], schema)
        self.schema = empty.schema
        for part in ("changes", "whole"):
            self._put(empty, part, -1, F.lit(0))  # makes the folder, leaves what it holds

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """At most all buckets."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    def _put(self, df: DataFrame, part: str, batch: int, place: Column) -> None:
        rows = df.select(*self.schema.names, F.lit(batch).cast("long").alias("_batch"), self._bucket().alias("_bucket")).withColumn("_place", place)
        dealt = rows.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        dealt.partitionBy("_place", "_bucket").parquet(f"{self.path}/{part}")

    def _get(self, part: str) -> DataFrame:
        own = [T.StructField("_batch", T.LongType()), T.StructField("_place", T.IntegerType()), T.StructField("_bucket", T.IntegerType())]
        return self.spark.read.schema(T.StructType([*self.schema.fields, *own])).parquet(f"{self.path}/{part}")

    def _places(self, start: int, buckets: list[int]) -> dict[int, int]:
        """Where each bucket's newest whole state from before batch `start` is."""
        held = self._get("whole").where(F.col("_bucket").isin(buckets) & (F.col("_batch") < start))
        return dict(map(tuple, held.groupBy("_bucket").agg(F.max_by("_place", "_batch")).collect()))

    def _rows(self, epoch: int, end: int, buckets: list[int]) -> DataFrame:
        """Buckets at the start of an epoch with the changes of its batches below `end`."""
        start = epoch * self.EPOCH
        found = self._places(start, buckets)
        there = [F.lit(False)] + [(F.col("_place") == p) & F.col("_bucket").isin([b for b, at in found.items() if at == p]) for p in (0, 1) if p in found.values()]
        whole = self._get("whole").where(reduce(Column.__or__, there)).select(self.schema.names)
        places = [b % (2 * self.EPOCH) for b in range(start, end)]
        new = self._get("changes").where(F.col("_place").isin(places) & F.col("_bucket").isin(buckets) & F.col("_batch").between(start, end - 1))
        newest = new.groupBy(*self.keys).agg(F.max_by(F.struct(*self.schema.names), "_batch").alias("row")).select("row.*")
        return _of_keys(whole, newest, self.keys, "left_anti").unionByName(newest)

    def before(self, batch: int, touched: DataFrame | None = None) -> DataFrame:
        """The table that a batch starts from, or those of its buckets that hold keys of `touched`."""
        buckets = list(range(self.buckets)) if touched is None else self.buckets_of(touched)
        return self._rows(batch // self.EPOCH, batch, buckets)

    def write(self, changed: DataFrame, batch: int) -> None:
        """The rows of all keys that a batch has changed."""
        self._put(changed, "changes", batch, F.lit(batch % (2 * self.EPOCH)))
        if (batch + 1) % self.EPOCH == 0:
            epoch = batch // self.EPOCH
            start = epoch * self.EPOCH
            places = [b % (2 * self.EPOCH) for b in range(start, batch + 1)]
            new = self._get("changes").where(F.col("_place").isin(places) & F.col("_batch").between(start, batch))
            buckets = sorted(r[0] for r in new.select("_bucket").distinct().collect())
            if buckets:
                found = self._places(start, buckets)
                second = F.col("_bucket").isin([b for b, p in found.items() if p == 0])
                self._put(self._rows(epoch, batch + 1, buckets), "whole", batch, F.when(second, 1).otherwise(0))

    def read(self) -> DataFrame:
        last = self._get("changes").select("_batch").union(self._get("whole").select("_batch")).agg(F.max("_batch")).first()[0]
        return self.before(0 if last is None else last + 1)


def _of_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """The rows of `df` with, or without, a key of `other`; null keys are equal."""
    same = reduce(Column.__and__, (F.col(f"d.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys))
    return df.alias("d").join(other.select(*keys).alias("o"), same, how)


def run_available(stream: DataFrame, table: KeyedTable, merge: Callable[[DataFrame, DataFrame], DataFrame], mode: str = "append") -> DataFrame:
    """Run the stream over all that is there; the table then. `merge`: (the buckets of the batch's keys, batch) to the rows of the keys that change."""

    def each(batch: DataFrame, number: int) -> None:
        table.write(merge(table.before(number, batch), batch), number)

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", shared_path(table.spark, "stream")).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    return table.read()


def stream_upsert(stream: DataFrame, table: KeyedTable, order: Sequence[str] = ("version", "synced_at")) -> DataFrame:
    """Newest row per key of every batch, merged unless the table has a newer one."""
    keys = table.keys

    def merge(held: DataFrame, batch: DataFrame) -> DataFrame:
        new = cdc.latest_row(batch, keys, order).alias("n")
        old = held.select(*keys, F.struct(*order).alias("_held"))
        newer = new.join(old, keys, "left").where(F.col("_held").isNull() | (F.struct(*order) >= F.col("_held"))).drop("_held")
        return upsert(_of_keys(held, newer, keys), newer, keys)

    return run_available(stream, table, merge)


def stream_burst(stream: DataFrame, time: str, bonus: str, prize: Column, minutes: int = 50, slide: int = 10, late: str = "4 hours", least: int = 5) -> DataFrame:
    """Clients and sliding windows with `holds`: `least` different bonuses or more, all without a prize.

    In update mode a window comes again whenever it changes, also when it holds no more: `retracting` then takes it back.
    """
    window = F.window(time, f"{minutes} minutes", f"{slide} minutes")
    found = _event_time(stream.where("client_id is not null").withColumn("_p", F.coalesce(prize, F.lit(0))), time, late).groupBy(window.alias("w"), "client_id")
    counted = found.agg(F.size(F.collect_set(bonus)).alias("distinct_bonuses"), F.count(bonus).alias("value"), F.sum("_p").alias("_prize"))
    holds = (F.col("distinct_bonuses") >= least) & (F.col("_prize") == 0)
    return counted.select("client_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "distinct_bonuses", "value", holds.alias("holds"))


def retracting(keys: Sequence[str], flag: str = "holds") -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge that writes rows for which `flag` holds, and of the others those that the table has as holding: they are taken back."""

    def merge(held: DataFrame, batch: DataFrame) -> DataFrame:
        return batch.where(flag).unionByName(_of_keys(batch.where(~F.col(flag)), held.where(flag), keys))

    return merge


def run_windows(
    stream: DataFrame, path: str, time: str, bonus: str, minutes: int, slide: int, least: int, group: Sequence[str], prize: Column | None = None, buckets: int = 64
) -> DataFrame:
    """Run sliding windows over all that is there: per `group` and window the different bonuses, grants and prizes of windows with `least` grants or more.

    Grants are counted once, in panes that make up the windows, and not once for every window that holds them. A table of panes is
    kept; a batch sums up the windows that hold a pane which it changed. Rows count however late they come.
    With `prize`, only windows of `least` different bonuses and no prize hold; one that holds no more is taken back.
    """
    spark, pane, group = stream.sparkSession, f"{gcd(minutes, slide)} minutes", list(group)
    own = list(dict.fromkeys([*group, bonus]))

    def paned(batch: DataFrame, number: int) -> DataFrame:
        rows = batch.where(F.col(time).isNotNull()).groupBy(*own, F.window(time, pane)["start"].alias("pane"))
        counted = F.count("*" if prize is None else bonus)
        return rows.agg(counted.alias("n"), F.sum(F.lit(0) if prize is None else F.coalesce(prize, F.lit(0))).alias("prize"), F.lit(number).cast("long").alias("batch"))

    def windows(panes: DataFrame, number: int) -> DataFrame:
        # windows that hold a pane reach less than a window's length to both sides of it
        over = f"over (partition by {', '.join(f'`{g}`' for g in group)} order by pane range between interval {minutes} minutes preceding and interval {minutes} minutes following)"
        near = panes.withColumns({"_near": F.expr(f"sum(n) {over}"), "_last": F.expr(f"max(batch) {over}")}).where((F.col("_near") >= least) & (F.col("_last") >= number))
        each = near.groupBy(*own, F.window("pane", f"{minutes} minutes", f"{slide} minutes").alias("w"))
        each = each.agg(F.sum("n").alias("n"), F.sum("prize").alias("prize"), F.max("batch").alias("batch"))
        found = each.groupBy(*group, "w").agg(
            F.count(F.when(F.col("n") > 0, F.col(bonus))).cast("int").alias("distinct_bonuses"), F.sum("n").alias("value"), F.sum("prize").alias("prize"), F.max("batch").alias("batch")
        )
        holds = (F.col("value") if prize is None else F.col("distinct_bonuses")) >= least
        holds = holds if prize is None else holds & (F.col("prize") == 0)
        return found.where(F.col("batch") >= number).select(*group, F.col("w.start").alias("window_start"), "distinct_bonuses", "value", holds.alias("holds"))

    none = paned(spark.createDataFrame([], stream.schema), 0)
    panes = KeyedTable(spark, f"{path}/panes", none.schema, [*own, "pane"], buckets, group)
    table = KeyedTable(spark, f"{path}/windows", windows(none, 0).schema, [*group, "window_start"], buckets, group)
    merge = retracting(table.keys)

    def each(batch: DataFrame, number: int) -> None:
        new = paned(batch, number)
        old = _of_keys(panes.before(number, batch), new, panes.keys)
        both = new.unionByName(old).groupBy(*own, "pane")
        panes.write(both.agg(F.sum("n").alias("n"), F.sum("prize").cast(none.schema["prize"].dataType).alias("prize"), F.lit(number).cast("long").alias("batch")), number)
        found = windows(panes.before(number + 1, batch), number)
        table.write(merge(table.before(number, batch), found), number)

    query = stream.writeStream.option("checkpointLocation", f"{path}/stream").trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    return table.read().where("holds").drop("holds")


def stream_game_hourly(stream: DataFrame, late: str = "4 hours") -> DataFrame:
    """source_marts.hourly by tumbling hour."""
    out = source_marts.hourly(_event_time(stream, "bet_time", late), F.window("bet_time", "1 hour"))
    return out.withColumn("local_hour", F.col("local_hour.start").cast("timestamp_ntz"))


def _midnight(day: datetime.date) -> int:
    """The end of a day, in milliseconds."""
    return int(datetime.datetime.combine(day + datetime.timedelta(1), datetime.time(), datetime.UTC).timestamp() * 1000)


class _Gate(StatefulProcessor):
    """Per key what fired last: value, time and number of times; a timer at the end of its day forgets the value."""

    def __init__(self, report: str, escalate: bool) -> None:
        self.report, self.escalate = report, escalate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.fired = handle.getValueState("fired", "ref_value decimal(18,2), day date, times int, open boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        row = initialState.iloc[0]
        self.fired.update((row["ref_value"], pd.Timestamp(row["last_fired"]).date(), int(row["times"]), True))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        best: dict[datetime.date, tuple] = {}  # of each day
        for pdf in rows:
            for value, time in zip(pdf["value"], pdf["time"], strict=True):
                value, time = (None if pd.isna(x) else x for x in (value, time))
                had = best.get(time.date())
                if had is None:
                    best[time.date()] = value, time
                else:
                    best[time.date()] = max((x for x in (had[0], value) if x is not None), default=None), max(had[1], time)
        out = []
        ref, last, times, is_open = self.fired.get() if self.fired.exists() else (None, None, 0, False)
        watermark = timerValues.getCurrentWatermarkInMs()
        for day, (value, time) in sorted(best.items()):
            if _midnight(day) <= watermark or last is not None and (day < last or day == last and not (is_open and self.escalate and value is not None and ref is not None and value > ref)):
                continue
            ref, last, times, is_open = value, day, times + 1, True
            out.append((self.report, key[0], value, time, times))
        if out:
            self.fired.update((ref, last, times, True))
            self.handle.registerTimer(_midnight(last))
            yield pd.DataFrame(out, columns=["report", "key", "ref_value", "last_fired", "times"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        _, last, times, _ = self.fired.get()
        if _midnight(last) <= expiredTimerInfo.getExpiryTimeInMs():
            self.fired.update((None, last, times, False))
        return iter(())

    def close(self) -> None:
        pass


def stream_alert_gate(stream: DataFrame, report: str, key_columns: Sequence[str], time: str, escalate: bool = True, late: str = "1 day", log: DataFrame | None = None) -> DataFrame:
    """alert_gate as a stream: the log rows of what fires, by state per key and day of `time`.

    Of a batch the largest value of a key and day counts, as in the batch job. Cases of days before the key's last alert never
    fire, nor do those of a day that is over by more than `late`. `log`: what has fired before the stream's first run.
    """
    cases = _event_time(stream.where(F.col(time).isNotNull()), time, late)
    cases = cases.select(alerts.alert_key(key_columns).alias("key"), F.col("value").cast("decimal(18,2)").alias("value"), F.col(time).alias("time"))
    before = None if log is None else log.where(F.col("report") == report).select("key", "ref_value", "last_fired", "times").groupBy("key")
    schema = "report string, key string, ref_value decimal(18,2), last_fired timestamp_ntz, times int"
    return cases.groupBy("key").transformWithStateInPandas(_Gate(report, escalate), schema, "Append", "EventTime", initialState=before)


def append_available(found: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream with keyed state over all that is there, appending to a folder; the folder then. Goes on from its checkpoint."""
    spark = found.sparkSession
    setting, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, provider)
    try:
        query = found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    query.awaitTermination()
    return spark.read.schema(found.schema).parquet(path)


def _event_time(stream: DataFrame, time: str, late: str) -> DataFrame:
    """With a watermark; Spark wants it on a timestamp with zone, so the session's zone stands in and is taken off again later."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def late_report(df: DataFrame, event_time: str, synced: str, overlap_hours: int = 4) -> DataFrame:
    """Rows that came later than the overlap covers, of a batch or a stream."""
    return df.where(F.col(synced) - F.col(event_time) > hours(overlap_hours))
