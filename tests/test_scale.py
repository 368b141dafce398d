"""What reaches the scan, what is read and written, and steps that hold little: plans and small brackets."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from playmart.operators import backfill, bonus, quality, source_marts, tables
from playmart.sources import backfills, files


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def times(spark, tmp_path):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k)) for k in range(240)]
    spark.createDataFrame(rows, "id int, at timestamp_ntz").write.parquet(str(tmp_path / "times"))
    return spark.read.parquet(str(tmp_path / "times"))


def test_days_reach_the_scan(times):
    found = backfill.filter_days(times, "at", "2024-01-03 03:00:00", "2024-01-05 03:00:00")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(found))[1]
    assert "GreaterThanOrEqual(at,2024-01-03T03:00)" in pushed and "LessThan(at,2024-01-05T03:00)" in pushed
    assert sorted(r["id"] for r in found.collect()) == list(range(51, 99))
    found = files.read_by_event_days(times, "at", ["2024-01-08", "2024-01-02", "2024-01-03"])
    pushed = re.search(r"PushedFilters: \[(.*)\], ReadSchema", plan(found))[1]
    assert "Or(" in pushed and "GreaterThanOrEqual(at,2024-01-02T00:00)" in pushed and "LessThan(at,2024-01-04T00:00)" in pushed
    assert sorted(r["id"] for r in found.collect()) == [*range(24, 72), *range(168, 192)]
    assert files.read_by_event_days(times, "at", []).count() == 0
    assert files.read_by_event_days(times, "at", ["2024-01-02"], -3).agg(F.min("id"), F.max("id")).first() == (27, 50)


@pytest.mark.parametrize("merge", [tables.upsert, tables.replace_by_keys])
def test_a_merge_leaves_other_partitions_alone(spark, tmp_path, merge):
    path = str(tmp_path / "t")
    spark.createDataFrame([(k, k % 5, k) for k in range(40)] + [(99, None, 1)], "id int, part int, n int").repartition(1).write.partitionBy("part").parquet(path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("part=*/*.parquet")}
    new = spark.createDataFrame([(0, 0, -1), (41, 0, -2), (3, 3, -3), (50, 7, -4)], "id int, part int, n int")
    files.merge_partitions(path, new, ["id", "part"], "part", merge)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("part=*/*.parquet")}
    kept = {f for f in before if f.parent.name not in ("part=0", "part=3")}
    assert len(kept) == 4 and all(after.get(f) == before[f] for f in kept)
    want = {k: (k % 5, k) for k in range(40)} | {99: (None, 1), 0: (0, -1), 41: (0, -2), 3: (3, -3), 50: (7, -4)}
    assert {r["id"]: (r["part"], r["n"]) for r in spark.read.parquet(path).collect()} == want
    with pytest.raises(ValueError):
        files.merge_partitions(path, new, ["id"], "part", merge)


@pytest.mark.parametrize("ranked, accuracy, q", [(10_000, 10_000, 0.99), (20, 50, 0.99), (0, 20, 0.5), (5, 100, 0.0), (5, 100, 1.0)])
def test_selection_equals_percentile(spark, ranked, accuracy, q):
    rng = random.Random(7)
    rows = [(rng.gauss(0, 1e6), rng.choice([1, 1, 1, 2]), None if k % 3 else Decimal(k) / 100, None, 10.0**rng.uniform(-300, 300)) for k in range(501)]
    df = spark.createDataFrame(rows, "a double, b int, c decimal(18,2), d int, e double").coalesce(2)
    names = list("abcde")
    got = bonus.exact_percentiles(df, names, q, ranked, accuracy)
    want = df.agg(*(F.percentile(F.col(c).cast("double"), q).alias(c) for c in names)).first().asDict()
    assert got == want
    assert bonus.exact_percentiles(df.limit(0), names, q) == dict.fromkeys(names)


def _rows(n):
    return [(k, dt.date(2024, 1, 1 + k % 9), Decimal(k) / 4 if k % 7 else None, dt.datetime(2024, 1, 1)) for k in range(n)]


RESULT = "id int, d date, v decimal(18,2), u timestamp_ntz"


def test_equal_parts_of_two_results_are_not_joined(spark):
    left = spark.createDataFrame(_rows(3000), RESULT).repartition(4)
    right = spark.createDataFrame(_rows(3000)[::-1], RESULT).repartition(3)
    columns = ["id", "d", "v", "u"]
    assert [df.count() for df in quality.differing_parts(left, right, "id", columns)] == [0, 0]
    later = dt.datetime(2024, 1, 2)
    changed = _rows(3000)
    changed[5] = (5, changed[5][1], None, later)
    changed[6] = (6, None, changed[6][2], dt.datetime(2023, 1, 1))
    changed += [(7, *changed[7][1:3], dt.datetime(2022, 1, 1)), (5000, None, None, None), (None, None, None, None)]
    del changed[100]
    other = spark.createDataFrame(changed, RESULT)
    apart = quality.differing_parts(left, other, "id", columns)
    assert 0 < apart[0].count() <= 40
    for parts in (1, 16, 4096):
        diffs, summary = quality.compare_results(left, other, "id", "d", "v", "u", parts)
        assert sorted(map(tuple, diffs.collect()), key=str) == sorted([(5, "value", True), (6, "date", False), (100, "only_left", False), (5000, "only_right", False), (None, "only_right", False)], key=str)
        assert {r["kind"]: r["n"] for r in summary.collect()} == {"value": 1, "date": 1, "only_left": 1, "only_right": 2, "repeated_left": 0, "repeated_right": 1}


def test_count_windows_take_the_first_that_holds_a_day(spark):
    days = spark.createDataFrame([(k, dt.datetime(2024, 1, k, 12), 0) for k in range(1, 20)], "id int, awarding_time timestamp_ntz, is_deleted int")
    windows = [("2024-01-02", "2024-01-04"), ("2024-01-04", "2024-01-09"), ("2024-01-12", "2024-01-11"), ("2024-01-19", "2024-03-01")]
    got = quality.window_count_check(days, days.where("id <> 5"), windows).orderBy("window_id").collect()
    assert [(r["source_n"], r["target_n"], r["equal"]) for r in got] == [(3, 3, True), (5, 4, False), (0, 0, True), (1, 1, True)]


def test_sales_from_a_database(spark):
    """Columns and the bound on time are left to the database; ranges are read on several connections."""
    url, driver = "jdbc:derby:memory:sales;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    try:
        spark._jvm.java.lang.Class.forName(driver)
    except Exception:
        pytest.skip("no embedded database beside Spark")
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), Decimal(k), "unused") for k in range(480)]
    spark.createDataFrame(rows, "tx_id int, created_at timestamp_ntz, amount decimal(18,2), other string").write.jdbc(url, "sales", "overwrite", {"driver": driver})
    columns = ["tx_id", "created_at", "amount"]
    found = files.read_sales_jdbc(spark, url, "sales", columns, "incremental", "2024-01-20 00:00:00", split=("tx_id", 0, 480, 4), driver=driver)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(CREATED_AT", plan(found), re.I) and not re.search("ReadSchema: .*other", plan(found), re.I)
    assert found.rdd.getNumPartitions() == 4
    assert sorted(r[0] for r in found.collect()) == list(range(288, 480))
    assert files.read_sales_jdbc(spark, url, "sales", columns, "history", driver=driver).count() == 480


@pytest.fixture
def grants(spark, tmp_path):
    """Days of 1 to 3 rows; a tombstone alone on a day; id 1 in two windows, newest in the first; a row without a time."""
    day = lambda n: dt.datetime(2024, 1, n, 12)
    rows = [(k, 1, day(1), 0, day(1 + k // 3)) for k in range(12)] + [(1, 0, day(1), 0, day(3)), (50, 1, day(1), 1, day(9)), (60, 1, day(1), 0, None), (2, 5, day(2), 0, day(1)), (70, 1, day(1), 0, day(20))]
    spark.createDataFrame(rows, "id int, version int, synced_at timestamp_ntz, is_deleted int, awarding_time timestamp_ntz").write.parquet(str(tmp_path / "grants"))
    return spark.read.parquet(str(tmp_path / "grants"))


@pytest.mark.parametrize("at_once", [1, 2, 200])
def test_a_backfill_goes_on_where_it_broke_off(spark, tmp_path, grants, at_once):
    path = str(tmp_path / "filled")
    span = ("2024-01-01 00:00:00", "2024-01-15 00:00:00", 4)
    log = backfills.run_backfill(grants, path, *span, windows_at_once=at_once, at_most=2)
    assert sorted(r["window_id"] for r in log.collect()) == [0, 1]
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "filled" / "rows").glob("window_id=*/*.parquet")}
    log = backfills.run_backfill(grants, path, *span, windows_at_once=at_once)
    assert sorted((r["window_id"], r["first_day"].day, r["last_day"].day, r["source_n"], r["target_n"], r["equal"]) for r in log.collect()) == [
        (0, 1, 1, 3, 3, True), (1, 2, 2, 3, 3, True), (2, 3, 3, 4, 4, True), (3, 4, 9, 3, 3, True),
    ]
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())
    loaded = backfill.backfill(grants, *span)[0]
    assert sorted((r["id"], r["version"], r["window_id"]) for r in backfills.read_backfill(spark, path).collect()) == sorted((r["id"], r["version"], r["window_id"]) for r in loaded.collect())
    files_now = {f: f.stat().st_mtime_ns for f in (tmp_path / "filled").glob("**/*.parquet")}
    backfills.run_backfill(grants, path, *span)
    assert files_now == {f: f.stat().st_mtime_ns for f in (tmp_path / "filled").glob("**/*.parquet")}


def test_a_window_whose_files_are_lost_is_loaded_again(spark, tmp_path, grants):
    path = str(tmp_path / "filled")
    span = ("2024-01-01 00:00:00", "2024-01-15 00:00:00", 4)
    backfills.run_backfill(grants, path, *span)
    whole = sorted(map(tuple, backfills.read_backfill(spark, path).select("id", "version").collect()))
    # as a run leaves it whose count did not match
    bad = backfills.backfill_log(spark, path).where("window_id = 1").withColumns({"target_n": F.lit(1).cast("long"), "equal": F.lit(False), "run": F.current_timestamp()})
    bad.write.mode("append").parquet(f"{path}/log")
    lost = next((tmp_path / "filled" / "rows" / "window_id=1").glob("*.parquet"))
    lost.unlink()
    assert sorted(r["equal"] for r in backfills.run_backfill(grants, path, *span).collect()) == [True] * 4
    assert sorted(map(tuple, backfills.read_backfill(spark, path).select("id", "version").collect())) == whole


def test_a_backfill_of_nothing(spark, tmp_path, grants):
    assert backfills.run_backfill(grants, str(tmp_path / "none"), "2025-01-01 00:00:00", "2025-02-01 00:00:00").count() == 0


def test_a_backfill_job_reads_its_days_only(spark, tmp_path, grants, monkeypatch):
    scans = []
    real = backfills.cdc.latest_row
    monkeypatch.setattr(backfills.cdc, "latest_row", lambda df, keys: scans.append(plan(df)) or real(df, keys))
    backfills.run_backfill(grants, str(tmp_path / "filled"), "2024-01-01 00:00:00", "2024-01-15 00:00:00", 4, windows_at_once=2)
    pushed = [re.search(r"PushedFilters: \[(.*?)\], ReadSchema", s)[1] for s in scans]
    assert len(pushed) == 2 and "LessThan(awarding_time,2024-01-03T00:00)" in pushed[0] and "GreaterThanOrEqual(awarding_time,2024-01-03T00:00)" in pushed[1]


def test_newest_times_come_from_footers(spark, tmp_path, times):
    path = str(tmp_path / "times")
    assert "PushedAggregation: [MAX(at)]" in plan(files.pushed_maximum(spark, path, "at"))
    assert files.newest_time(spark, path, "at") == dt.datetime(2024, 1, 10, 23)
    schema = "id int, at timestamp_ntz"
    for name, rows in {"empty": [], "nulls": [(1, None)], "some": [(1, None), (2, dt.datetime(1969, 5, 1, 0, 0, 0, 7))]}.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
    # a file whose columns are in another order, so that the footer's place is another column
    times.where("id < 200").select("id", "at").write.parquet(str(tmp_path / "mixed"))
    times.where("id >= 200").select("at", "id").write.mode("append").parquet(str(tmp_path / "mixed"))
    newest = {name: files.newest_time(spark, str(tmp_path / name), "at") for name in ("empty", "nulls", "some", "mixed")}
    assert newest == {"empty": None, "nulls": None, "some": dt.datetime(1969, 5, 1, 0, 0, 0, 7), "mixed": dt.datetime(2024, 1, 10, 23)}
    assert files.low_cursor_of_tables(spark, [(path, "at"), (str(tmp_path / "empty"), "at")]) == dt.datetime(2024, 1, 10, 19)
    with pytest.raises(ValueError):
        files.low_cursor_of_tables(spark, [(str(tmp_path / "empty"), "at")])


def test_freshness_comes_from_footers(spark, tmp_path, times):
    """Newest time 2024-01-10 23:00; the same row as over the table itself, also without rows."""
    path, empty = str(tmp_path / "times"), str(tmp_path / "empty")
    times.limit(0).write.parquet(empty)
    gates = {}
    for as_of in ("2024-01-10", "2024-01-11", "2024-01-12", "2024-01-13"):
        for offset in (-3, 0, 3):
            row = files.freshness_of_table(spark, path, "at", as_of, offset).first()
            assert row == source_marts.freshness_gate(times, "at", as_of, offset).first()
            gates[as_of, offset] = row["gate"]
    assert [gates[f"2024-01-1{k}", -3] for k in range(4)] == ["ok", "ok", "skip", "fail"] and gates["2024-01-13", 3] == "skip"
    assert files.freshness_of_table(spark, empty, "at", "2024-01-10").first() == (None, None, "fail")


@pytest.mark.parametrize("unit", ["ms", "us"])
def test_newest_times_of_files_in_other_units(spark, tmp_path, unit):
    pa = pytest.importorskip("pyarrow")
    import pyarrow.parquet as pq

    (tmp_path / "t").mkdir()
    pq.write_table(pa.table({"id": [1, 2], "at": pa.array([dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)], pa.timestamp(unit))}), tmp_path / "t" / "a.parquet")
    assert files.newest_time(spark, str(tmp_path / "t"), "at") == dt.datetime(2024, 1, 2)


def test_versions_of_a_bonus_do_not_multiply_bridge_rows_on_the_way(spark):
    bridge = spark.createDataFrame([(k, 1, None, 0, k % 3) for k in range(10)], "id int, version int, synced_at timestamp_ntz, is_deleted int, bonus_id int")
    bonuses = spark.createDataFrame([(1, 180, 0)] * 50 + [(2, 180, 1), (0, 181, 0)], "bonus_id int, partner_id int, is_deleted int")
    found = source_marts.bonus_product_bridge(bridge, bonuses, 180)
    assert "LeftSemi" in plan(found) and "Inner" not in plan(found)
    assert sorted(r["id"] for r in found.collect()) == [1, 4, 7]


def test_grants_are_read_once(spark, tiny):
    """Cut-offs, score and watchlist read a table of metrics; the aggregate finds its impacted pairs itself."""
    from playmart.plans.registry import QUERIES

    for name, scans in {"F2_bonus_agg": 1, "F8_risk_score": 0, "F9_watchlist_update": 0, "F10_watchlist_insert": 0}.items():
        assert plan(QUERIES[name](spark, tiny)).split("Initial Plan")[0].count("lineitem.parquet") == scans, name


def test_changed_rows_name_the_impacted_pairs(spark):
    rows = [(1, 1, 5), (1, 1, 9), (1, 2, 5), (None, 1, 9), (2, None, 9), (2, 3, None), (2, 3, 9)]
    grants = spark.createDataFrame([(c, b, 180, None, None, 1, None, None, s) for c, b, s in rows], "client_id int, bonus_id int, partner_id int, bonus_prize decimal(18,2), cost decimal(18,2), reuse_number int, turnover_left decimal(18,2), awarding_time int, synced_at int")
    found = bonus.bonus_agg(grants, changed=F.col("synced_at") > 5)
    same = bonus.bonus_agg(grants, bonus.impacted_pairs(grants.where("synced_at > 5")))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, same.collect())) and found.columns == same.columns and found.count() == 2


def test_repeated_keys_are_counted_in_equal_parts_too(spark, tiny):
    from playmart.plans.registry import QUERIES

    schema = "id long, d date, v decimal(18,2), u int"
    left = spark.createDataFrame([(1, None, None, 1)] * 2 + [(2, None, None, 1)] * 3 + [(k, None, None, 1) for k in range(3, 90)], schema)
    right = left.union(spark.createDataFrame([(5, None, None, 1), (100, None, None, 1)], schema))
    got = {r["kind"]: (r["n"], r["explained"]) for r in quality.compare_results(left, right, "id", "d", "v", "u")[1].collect()}
    assert got == {"only_right": (1, 0), "repeated_left": (2, 0), "repeated_right": (3, 0)}
    assert "lineitem.parquet" not in plan(QUERIES["J5_compare_summary"](spark, tiny))  # the grants are read once, before


def test_error_texts_are_packed_before_they_are_sorted(spark):
    at = dt.datetime(2024, 1, 1)
    events = spark.range(600).select(
        F.lit("a").alias("tenant"), (F.col("id") % 300).cast("string").alias("operation"), F.lit(at).cast("timestamp_ntz").alias("start_time"), F.col("id").alias("event_order"), F.lit("FAILED").alias("status"),
        F.lit(at).cast("timestamp_ntz").alias("ended_at"), F.when(F.col("id") % 3 > 0, F.concat(F.repeat(F.lit("é"), 20), F.col("id").cast("string"))).alias("error"),
    )
    found = tables.run_history(events, "2024-01-01 00:00:00", error_length=22)
    below = plan(found).split("Initial Plan")[0]
    assert below.count("MapInArrow") == 2 and below.rindex("MapInArrow") > below.index("Aggregate")
    assert {(r["operation"], r["error"]) for r in found.collect()} == {(str(k - 300), "é" * 20 + str(k)[:2] if k % 3 else None) for k in range(300, 600)}


def test_messages_read_grants_and_keys_once(spark, tiny):
    from playmart.plans.registry import QUERIES

    assert "lineitem.parquet" not in plan(QUERIES["G25_case_messages"](spark, tiny)).split("Initial Plan")[0]
