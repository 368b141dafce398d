"""Streams over several batches."""

import datetime as dt
import random
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from playmart.operators import alerts, source_marts
from playmart.streaming import jobs

GRANTS = "id int, version long, synced_at timestamp_ntz, x string"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def files(spark, folder, batches, schema):
    """A stream that takes one batch after the other."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_an_older_version_that_comes_late_does_not_win(spark, tmp_path):
    table = jobs.KeyedTable(spark, str(tmp_path / "table"), GRANTS, ["id"])
    stream = files(spark, str(tmp_path / "in"), [[(1, 5, at(3), "new"), (2, 1, at(1), "a")], [(1, 2, at(4), "old"), (2, 2, at(2), "b"), (2, 3, at(2), "c"), (3, 1, at(1), None)]], GRANTS)
    got = sorted((r["id"], r["x"]) for r in jobs.stream_upsert(stream, table).collect())
    assert got == [(1, "new"), (2, "c"), (3, None)]


def test_a_batch_that_runs_again_starts_from_the_one_before(spark, tmp_path):
    table = jobs.KeyedTable(spark, str(tmp_path / "table"), "id int, n long", ["id"])
    for batch in (0, 1, 1):
        held = table.before(batch)
        table.write(held.select("id", (F.col("n") + 1).alias("n")) if batch else spark.createDataFrame([(1, 1), (None, 1)], "id int, n long"), batch)
    assert sorted(map(tuple, table.read().collect()), key=str) == [(1, 2), (None, 2)]


@pytest.mark.parametrize("last", [3, 4, 7, 8, 17, 20])
def test_a_table_over_many_epochs(spark, tmp_path, last):
    """Changes, whole tables and places used again; some batches change nothing, one runs again after it was put in order."""

    class Short(jobs.KeyedTable):
        EPOCH = 4

    table, plain = Short(spark, str(tmp_path / "table"), "id int, n int", ["id"]), {}
    for batch in range(last):
        rows = [] if batch in (5, 12, 13, 14, 15, 16) else [(batch % 3, batch), (None, -batch), (100 + batch, 0)]
        for _ in range(2 if batch in (3, 4) else 1):
            assert {r["id"]: r["n"] for r in table.before(batch).collect()} == plain
            table.write(spark.createDataFrame(rows, "id int, n int"), batch)
        plain.update(rows)
    got = [tuple(r) for r in Short(spark, str(tmp_path / "table"), "id int, n int", ["id"]).read().collect()]
    assert len(got) == len(plain) and dict(got) == plain
    assert len(list((tmp_path / "table" / "whole").glob("_place=*"))) <= 2 and len(list((tmp_path / "table" / "changes").glob("_place=*"))) <= 8


def test_a_batch_reads_the_buckets_of_its_keys(spark, tmp_path):
    table = jobs.KeyedTable(spark, str(tmp_path / "table"), GRANTS, ["id"], buckets=32)
    table.EPOCH = 2
    for batch in range(5):  # buckets put in order at different times, and changes
        rows = [(batch * 40 + k, 1, at(1), f"{batch}") for k in range(40)] if batch != 3 else [(7, 2, at(2), "new")]
        table.write(spark.createDataFrame(rows, GRANTS), batch)
    new = spark.createDataFrame([(7, 1, at(1), "x"), (81, 1, at(1), "y")], GRANTS)
    touched = table.buckets_of(new)
    assert len(touched) <= 2 and table.read().count() == 160
    for other in (tmp_path / "table").glob("*/_place=*/_bucket=*"):  # nothing else is read
        if int(other.name.split("=")[1]) not in touched:
            shutil.rmtree(other)
    held = table.before(5, new)
    got = {r["id"]: r["x"] for r in held.collect()}
    assert got[7] == "new" and got[81] == "2" and len(got) < 40


GATE = "client_id int, value decimal(18,2), time timestamp_ntz"
LOG = "report string, key string, ref_value decimal(18,2), last_fired timestamp_ntz, times int"
CASES = [
    [(1, Decimal(5), at(1)), (2, Decimal(1), at(2)), (3, None, at(3))],
    [(1, Decimal(5), at(4)), (2, Decimal(3), at(5)), (2, Decimal(4), at(4)), (3, Decimal(1), at(6)), (4, Decimal(9), at(7))],
    [(1, Decimal(2), at(1) + dt.timedelta(1)), (2, Decimal(9), at(2) + dt.timedelta(1)), (4, Decimal(9), at(3) + dt.timedelta(1))],
]


def plain_gate(spark, batches, escalate, log):
    """alert_gate batch by batch, each on its day."""
    fired = []
    for rows in batches:
        cases = spark.createDataFrame(rows, GATE).groupBy("client_id").agg(F.max("value").alias("value"))
        _, new = alerts.alert_gate(cases, spark.createDataFrame(log, LOG), "r", ["client_id"], escalate, rows[0][2])
        new = [tuple(r) for r in new.collect()]
        fired += new
        log = [r for r in log if (r[0], r[1]) not in {(n[0], n[1]) for n in new}] + new
    return sorted((r[1], r[2], r[3].date(), r[4]) for r in fired)


@pytest.mark.parametrize("escalate", [True, False])
def test_gate_fires_as_the_batch_job_does(spark, tmp_path, escalate):
    """Three batches over two days, with a log from before, and a restart between them."""
    before = [("r", "4", Decimal("9.00"), at(0), 6), ("r", "2", Decimal("7.00"), at(0) - dt.timedelta(1), 2), ("other", "1", Decimal("9.00"), at(0), 1)]
    folder = str(tmp_path / "in")
    for upto in (2, 3):
        stream = files(spark, folder, CASES[:2] if upto == 2 else CASES[2:], GATE)
        fired = jobs.stream_alert_gate(stream, "r", ["client_id"], "time", escalate, log=spark.createDataFrame(before, LOG))
        out = jobs.append_available(fired, str(tmp_path / "log"), str(tmp_path / "checkpoint"))
        got = sorted((r["key"], r["ref_value"], r["last_fired"].date(), r["times"]) for r in out.collect())
        assert sorted(got, key=str) == sorted(plain_gate(spark, CASES[:upto], escalate, before), key=str)


def test_gate_forgets_a_day_that_is_over(spark, tmp_path):
    """Cases of earlier days never fire, whether the timer has closed the day or not."""
    day = dt.timedelta(1)
    batches = [[(1, Decimal(5), at(1))], [(2, Decimal(5), at(1) + 9 * day)], [(1, Decimal(9), at(2))], [(1, Decimal(3), at(2) + 9 * day), (2, Decimal(8), at(1) + 8 * day)]]
    fired = jobs.stream_alert_gate(files(spark, str(tmp_path / "in"), batches, GATE), "r", ["client_id"], "time")
    out = jobs.append_available(fired, str(tmp_path / "log"), str(tmp_path / "checkpoint"))
    assert sorted((r["key"], r["ref_value"], r["times"]) for r in out.collect()) == [("1", Decimal(3), 2), ("1", Decimal(5), 1), ("2", Decimal(5), 1)]


BURSTS = "client_id int, bonus_id int, time timestamp_ntz, prize decimal(18,2)"


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 0, 2]])
def test_a_burst_that_has_a_prize_later_is_taken_back(spark, tmp_path, order):
    batches = [
        [(c, b, at(1, 5 * b), None) for c in (1, 2) for b in range(5)],
        [(1, 9, at(1, 2), Decimal(100)), (3, 1, at(1), Decimal(1))],
        [(3, b, at(1, b), Decimal(0)) for b in range(5)] + [(2, 5, at(2), None), (None, 1, at(1), None)],
    ]
    keys = ["client_id", "window_start"]
    found = jobs.stream_burst(files(spark, str(tmp_path / "in"), [batches[k] for k in order], BURSTS), "time", "bonus_id", F.col("prize"))
    table = jobs.KeyedTable(spark, str(tmp_path / "table"), found.schema, keys)
    got = jobs.run_available(found, table, jobs.retracting(keys), "update").where("holds").drop("holds")
    rows = [r for batch in batches for r in batch if r[0] is not None]
    want = set()
    for start in (at(0) + dt.timedelta(minutes=10 * k) for k in range(30)):  # as the batch job finds, window by window
        for client in (1, 2, 3):
            own = [r for r in rows if r[0] == client and start <= r[2] < start + dt.timedelta(minutes=50)]
            if len({r[1] for r in own}) >= 5 and sum(r[3] or 0 for r in own) == 0:
                want.add((client, start, len({r[1] for r in own}), len(own)))
    assert {tuple(r) for r in got.collect()} == want and {w[0] for w in want} == {2}


def test_hours_equal_the_batch_job(spark, tmp_path):
    schema = "product_id int, bet_time timestamp_ntz, bet_amount decimal(18,2), win_amount decimal(18,2), bonus_amount decimal(18,2)"
    rows = [[(k % 3, at(k % 5, k % 60), Decimal(k), None, None) for k in range(40)], [(1, at(4, 5), Decimal(7), Decimal(1), Decimal(2))]]
    table = jobs.KeyedTable(spark, str(tmp_path / "t"), jobs.stream_game_hourly(files(spark, str(tmp_path / "in"), rows, schema)).schema, ["product_id", "local_hour"])
    stream = jobs.stream_game_hourly(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "10 hours")
    got = jobs.run_available(stream, table, lambda held, batch: jobs.upsert(held, batch, ["product_id", "local_hour"]), "update")
    batch = source_marts.hourly(spark.createDataFrame(sum(rows, []), schema), F.date_trunc("hour", "bet_time").cast("timestamp_ntz"))
    assert sorted(map(tuple, got.select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_late_rows(spark):
    df = spark.createDataFrame([(1, at(1), at(5)), (2, at(1), at(5, 1))], "id int, event timestamp_ntz, synced timestamp_ntz")
    assert [r["id"] for r in jobs.late_report(df, "event", "synced").collect()] == [2]


def test_windows_over_several_batches(spark, tmp_path):
    """Windows of 50 minutes every 20 (panes of 10) over batches, late ones and one that takes bursts back, against plain loops; a pane is kept once."""
    r = random.Random(5)
    batches = [[(r.choice((1, 2, 3, None)), r.randrange(4), at(1) + dt.timedelta(minutes=r.randrange(900)), None) for _ in range(150)] for _ in range(2)]
    batches.append([(1, 9, at(3), Decimal(5)), (3, 1, at(4), Decimal(1)), (2, 1, None, None)])
    rows = [row for batch in batches for row in batch if row[2] is not None]
    starts = [at(0) + dt.timedelta(minutes=20 * k) for k in range(60)]
    inside = lambda s, row: s <= row[2] < s + dt.timedelta(minutes=50)
    reuse, bursts = set(), set()
    for s in starts:
        for client in (1, 2, 3, None):
            own = [row for row in rows if row[0] == client and inside(s, row)]
            if len({row[1] for row in own}) >= 3 and sum(row[3] or 0 for row in own) == 0:
                bursts.add((client, s, len({row[1] for row in own}), len(own)))
            for bonus in {row[1] for row in own}:
                if (n := sum(row[1] == bonus for row in own)) >= 3:
                    reuse.add((client, bonus, s, n))
    stream = files(spark, str(tmp_path / "in"), [batches[k] for k in (1, 2, 0)], BURSTS)
    got = jobs.run_windows(stream, str(tmp_path / "reuse"), "time", "bonus_id", 50, 20, 3, ["client_id", "bonus_id"], buckets=4)
    assert {tuple(x) for x in got.select("client_id", "bonus_id", "window_start", "value").collect()} == reuse and len(reuse) > 20
    got = jobs.run_windows(stream, str(tmp_path / "bursts"), "time", "bonus_id", 50, 20, 3, ["client_id"], F.col("prize"), buckets=4)
    assert {tuple(x) for x in got.collect()} == bursts and len(bursts) > 20
    panes = spark.read.parquet(str(tmp_path / "reuse" / "panes" / "changes"))
    assert panes.agg(F.sum("n")).first()[0] <= 3 * len(rows)  # one row for a grant's pane and batch, not one for each of its windows
