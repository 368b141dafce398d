"""Traps and properties of the operators on small frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from playmart.functions.text import truncate_utf8_bytes
from playmart.functions.time import Window, local_day
from playmart.operators import activity, alerts, backfill, bonus, cdc, cohorts, protect, quality, sales, shared_keys, source_marts, tables
from playmart.sources import files
from playmart.sources.testdata import Data


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def t(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)


def test_upsert_leaves_other_columns_and_is_idempotent(spark):
    target = frame(spark, [(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, x string, y int")
    source = frame(spark, [(2, None), (3, "c"), (None, "m")], "k int, x string")
    once = tables.upsert(target, source, ["k"])
    assert rows(once) == sorted([(1, "a", 10), (2, None, 20), (3, "c", None), (None, "n", 0), (None, "m", None)], key=repr)
    plain = frame(spark, [(1, "a"), (2, "b")], "k int, x string")
    s = frame(spark, [(2, "z"), (3, "c")], "k int, x string")
    assert rows(tables.upsert(tables.upsert(plain, s, ["k"]), s, ["k"])) == rows(tables.upsert(plain, s, ["k"]))


def test_upsert_refuses_repeated_keys(spark):
    target = frame(spark, [(1, "a")], "k int, x string")
    twice = frame(spark, [(1, "b"), (1, "c")], "k int, x string")
    with pytest.raises(Exception, match="several source rows"):
        tables.upsert(target, twice, ["k"]).collect()
    assert rows(tables.duplicate_keys(twice, ["k"])) == [(1, "b"), (1, "c")]


def test_update_only_writes_nulls_and_inserts_nothing(spark):
    target = frame(spark, [(1, "a"), (2, "b")], "k int, x string")
    source = frame(spark, [(1, None), (1, None), (9, "z")], "k int, x string")
    assert rows(tables.update_only(target, source, ["k"], ["x"])) == [(1, None), (2, "b")]


def test_replace_drops_absent_rows_of_present_keys(spark):
    target = frame(spark, [(1, "a"), (1, "b"), (2, "c")], "k int, x string")
    assert rows(tables.replace_by_keys(target, frame(spark, [(1, "z")], "k int, x string"), ["k"])) == [(1, "z"), (2, "c")]


def test_delete_keeps_rows_of_unknown_predicate(spark):
    df = frame(spark, [(1,), (None,), (9,)], "x int")
    assert rows(tables.delete_where(df, F.col("x") > 5)) == [(1,), (None,)]
    assert tables.delete_where(df).count() == 0


def test_run_history(spark):
    at = t("2024-01-01 10:00:00")
    events = frame(
        spark,
        [("a", "x", at, 1, "RUNNING", None, None), ("a", "x", at, 2, "FAILED", at + dt.timedelta(seconds=90.5), "e" * 70000), ("a", "y", at, 1, "RUNNING", None, None), ("a", "z", at, 2, "SUCCESS", at, None)],
        "tenant string, operation string, start_time timestamp_ntz, event_order int, status string, ended_at timestamp_ntz, error string",
    )
    got = {r["operation"]: r for r in tables.run_history(events, "2024-01-01 10:31:00").collect()}
    assert (got["x"]["status"], got["x"]["duration_seconds"], len(got["x"]["error"]), got["x"]["is_stale"]) == ("FAILED", Decimal("90.50"), 60000, False)
    assert got["y"]["is_stale"] and got["z"]["duration_seconds"] == 0


def test_cursor_fails_on_empty_tables_only(spark):
    full = frame(spark, [(t("2024-01-02 00:00:00"),), (t("2024-01-05 00:00:00"),)], "updated_at timestamp_ntz")
    assert rows(tables.low_cursor({"a": full, "b": full.limit(0)})) == [(t("2024-01-04 20:00:00"),)]
    with pytest.raises(Exception, match="empty"):
        tables.low_cursor({"b": full.limit(0)}).collect()


def test_window_ends(spark):
    df = frame(spark, [(t(f"2024-01-0{k} 00:00:00"),) for k in (1, 2, 3)], "at timestamp_ntz")
    n = lambda **kw: df.where(Window("2024-01-01 00:00:00", "2024-01-03 00:00:00", **kw).holds("at")).count()
    assert [n(closed=c) for c in ("both", "left", "right", "neither")] == [3, 2, 2, 1]
    assert files.read_changes(df, "at", "2024-01-01 00:00:00").count() == 2
    assert files.read_changes(df, "at", "2024-01-01 00:00:00", "2024-01-03 00:00:00").count() == 3


VERSIONS = "id int, version long, synced_at timestamp_ntz, is_deleted int, x string"


def test_three_rules_of_latest(spark):
    at = t("2024-01-01 00:00:00")
    df = frame(spark, [(1, 1, at, 0, "old"), (1, 2, at, 0, None), (2, 1, at, 0, "alive"), (2, 2, at, 1, "dead")], VERSIONS)
    assert [r["x"] for r in cdc.latest_row(df, ["id"]).orderBy("id").collect()] == [None, "dead"]
    assert rows(cdc.latest_by_column(df, ["id"], ["x"])) == [(1, "old"), (2, "dead")]
    assert [r["x"] for r in cdc.drop_deleted(df, ["id"], "before").orderBy("id").collect()] == [None, "alive"]
    assert [r["x"] for r in cdc.drop_deleted(df, ["id"], "after").collect()] == [None]
    shuffled = df.orderBy(F.desc("version"))
    assert rows(cdc.latest_row(shuffled, ["id"])) == rows(cdc.latest_row(df, ["id"]))


def test_balance_of_late_versions(spark):
    """Twelve ordinary clients, and one whose two types were synced at both ends of the window."""
    begin = t("2026-07-14 10:00:00")
    data = [(c, 2, Decimal("10.00"), t("2026-07-14 15:00:00"), begin + dt.timedelta(minutes=3), c) for c in range(1, 13)]
    data += [(13, 1, Decimal("1.02"), t("2026-07-14 08:00:00"), begin + dt.timedelta(minutes=2), 13), (13, 2, Decimal("0.24"), t("2026-07-14 08:00:00"), begin + dt.timedelta(hours=9, minutes=58), 14)]
    df = frame(spark, data, "client_id long, type_id int, balance decimal(18,2), created_at timestamp_ntz, synced_at timestamp_ntz, event_id long")
    out = source_marts.balance_daily(df).collect()
    assert len(out) == 13 == len({(r["client_id"], r["ref_date"]) for r in out})
    assert [r["total"] for r in out if r["client_id"] == 13] == [Decimal("1.26")]


def test_balance_may_be_split_by_client_only(spark, tiny):
    balances = Data(spark, tiny).v_balance
    whole = rows(source_marts.balance_daily(balances))
    parts = [source_marts.balance_daily(balances.where(F.pmod(F.xxhash64("client_id"), F.lit(3)) == k)) for k in range(3)]
    assert rows(parts[0].union(parts[1]).union(parts[2])) == whole


def test_local_day(spark):
    df = frame(spark, [(t("2024-01-02 02:59:59"),), (t("2024-01-02 03:00:00"),)], "at timestamp_ntz").select(local_day("at"))
    assert rows(df) == [(d("2024-01-01"),), (d("2024-01-02"),)]


def test_scoped_recompute_is_the_full_one(spark, tiny):
    data = Data(spark, tiny)
    some = data.v_user_daily.where("user_id % 3 = 1").select("user_id").distinct()
    full = activity.user_metrics(data.v_user_daily).where("user_id % 3 = 1")
    assert rows(activity.user_metrics(data.v_user_daily, some)) == rows(full)
    live = cdc.drop_deleted(data.v_grants, ["id"])
    pairs = bonus.impacted_pairs(live.where("status = 3"))
    assert rows(bonus.bonus_agg(live, pairs)) == rows(bonus.bonus_agg(live).join(pairs, bonus.PAIR, "left_semi"))


DAYS = "user_id int, ref_date date, bet_amount decimal(18,2), bet_qty int, deposit_amount decimal(18,2), deposit_qty int, withdraw_amount decimal(18,2), withdraw_qty int, bonus_amount decimal(18,2), bonus_qty int, ggr decimal(18,2)"


def user_day(user, day, bet=0, bonus_qty=0):
    return (user, d(day) if day else None, Decimal(bet), int(bet > 0), None, 0, None, 0, None, bonus_qty, Decimal(bet))


def test_bonus_alone_is_no_activity(spark):
    df = frame(spark, [user_day(1, "2024-01-01", bonus_qty=2), user_day(1, "2024-01-02", bet=5), user_day(1, None, bet=5)], DAYS)
    got = activity.activity_daily(df).collect()
    assert [(r["ref_date"], r["has_bet"], r["has_bonus"], r["deposit_amount"]) for r in got] == [(d("2024-01-02"), True, False, 0)]


def test_reactivation_state(spark):
    df = frame(spark, [user_day(1, "2024-03-01", bet=1), user_day(1, "2024-03-02", bet=1), user_day(2, "2024-01-01", bet=1), user_day(2, "2024-02-05", bet=1), user_day(3, "2024-01-01", bet=1)], DAYS)
    state = frame(spark, [(1, d("2024-01-15"), None, False), (9, d("2023-01-01"), None, False)], "user_id int, last_activity date, last_reactivation date, reactivated boolean")
    everyone = df.select("user_id").distinct()
    events = activity.reactivation_events(df, everyone, state)
    assert rows(events) == [(1, d("2024-03-02"), d("2024-03-01"), True), (2, d("2024-02-05"), d("2024-02-05"), True), (3, d("2024-01-01"), None, False)]
    calm = events.withColumn("last_reactivation", F.lit(None).cast("date")).withColumn("reactivated", F.lit(False)).where("user_id <> 2")
    out = {r["user_id"]: r["last_reactivation"] for r in activity.reactivation_state(state, calm).collect()}
    assert out == {1: d("1900-01-01"), 3: None, 9: None}
    assert activity.reactivation_state(state, calm, null_floor=True).where("user_id = 1").first()["last_reactivation"] is None


def test_cohort_windows_do_not_overlap(spark):
    labels = spark.range(0, 93).select(F.col("id").cast("int").alias("n")).select("n", cohorts.window_label(F.col("n")).alias("w")).collect()
    assert [r["w"] for r in labels if r["n"] in (0, 1, 2, 7, 8, 30, 31, 60, 61, 90, 91)] == [None, "D1", "D7", "D7", "D30", "D30", "D60", "D60", "D90", "D90", None]


def test_sum_of_nulls_stays_null(spark):
    grants = frame(
        spark, [(1, 1, 1, 180, None, None, 3, None, None, t("2024-01-01 00:00:00"))],
        "id int, client_id int, bonus_id int, partner_id int, bonus_prize decimal(18,2), cost decimal(18,2), reuse_number int, turnover_left decimal(18,2), awarding_time timestamp_ntz, synced_at timestamp_ntz",
    )
    agg = bonus.bonus_agg(grants)
    assert agg.first()["prize"] is None
    assert bonus.client_bonus_metrics(agg).first()["cost"] == 0


def test_watchlist_counts_a_day_once(spark):
    scored = frame(spark, [(1, 180, 3), (2, 180, 0)], "client_id int, partner_id int, score int")
    schema = "client_id int, partner_id int, score int, previous_score int, crossed boolean, days_flagged int, first_alert date, last_alert date"
    first = bonus.watchlist_update(frame(spark, [], schema), scored, "2024-01-01")
    again = bonus.watchlist_update(first, scored, "2024-01-01")
    later = bonus.watchlist_update(again, scored, "2024-01-02")
    flagged = lambda df: [(r["days_flagged"], r["crossed"], r["first_alert"], r["last_alert"]) for r in df.where("client_id = 1").collect()]
    assert flagged(first) == [(1, True, d("2024-01-01"), d("2024-01-01"))]
    assert flagged(again) == [(1, False, d("2024-01-01"), d("2024-01-01"))]
    assert flagged(later) == [(2, False, d("2024-01-01"), d("2024-01-02"))]


def test_score_is_strict_and_null_gives_none(spark):
    metrics = frame(spark, [(1, 180, 5, Decimal(2), None, Decimal(9)), (2, 180, 6, Decimal(1), 1, Decimal(9))], "client_id int, partner_id int, grants long, cost decimal(18,2), max_reuse int, turnover_left decimal(18,2)")
    cut = frame(spark, [("grants", 5.0), ("cost", 1.0), ("reuse", 0.0), ("turnover", 9.0)], "signal string, cutoff double")
    assert sorted((r["client_id"], r["score"]) for r in bonus.risk_score(metrics, cut).collect()) == [(1, 1), (2, 2)]


LOG = "report string, key string, ref_value decimal(18,2), last_fired timestamp_ntz, times int"


def test_gate_fires_once_a_day_unless_it_grows(spark):
    cases = frame(spark, [(1, 5)], "client_id int, value int")
    log = frame(spark, [], LOG)
    fire = lambda cases, log, escalate, at: alerts.alert_gate(cases, log, "r", ["client_id"], escalate, at)
    queue, new = fire(cases, log, True, "2024-01-01 10:00:00")
    assert queue.count() == 1
    log = alerts.alert_log_upsert(log, new)
    assert fire(cases, log, True, "2024-01-01 11:00:00")[0].count() == 0
    grown = frame(spark, [(1, 6)], "client_id int, value int")
    assert fire(grown, log, True, "2024-01-01 11:00:00")[0].count() == 1
    assert fire(grown, log, False, "2024-01-01 11:00:00")[0].count() == 0
    again = fire(cases, log, True, "2024-01-02 00:00:00")[1].collect()
    assert [(r["times"], r["ref_value"]) for r in again] == [(2, Decimal("5.00"))]


def test_identity_priority_and_nulls(spark):
    schema = "client_id int, tax_number string, phone string, first_name string, last_name string, birth_date date"
    cand = frame(spark, [(1, "t", "p", None, None, None), (2, None, "p", None, None, None), (3, None, None, "a", "b", d("2000-01-01")), (4, None, None, "a", "b", None)], schema)
    old = frame(spark, [(1, None, "p", "a", "b", None), (50, "t", None, None, None, None), (60, None, "p", None, None, None), (70, None, None, "a", "b", d("2000-01-01")), (71, None, None, None, None, None)], schema)
    got = {r["client_id"]: r["same_person"] for r in alerts.identity_match(cand, old).collect()}
    assert got == {1: 50, 2: 60, 3: 70, 4: None}


def test_reconciliation_counts_nulls_as_wrong(spark):
    df = frame(spark, [(1, 1), (1, 2), (None, None), (1, None)], "source_x int, target_x int")
    assert [r["x_check"] for r in quality.recon_flags(df, ["x"]).collect()] == ["right", "wrong", "wrong", "wrong"]


def test_cut_inside_a_character(spark):
    df = frame(spark, [("ab🟡",), ("é",), ("abc",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(truncate_utf8_bytes("s", 5)).collect()] == ["ab", "é", "abc", None, ""]
    assert [r[0] for r in df.select(truncate_utf8_bytes("s", 1)).collect()] == ["a", "", "a", None, ""]


def test_day_filter_ends_before_midnight(spark):
    df = frame(spark, [(t(f"2024-01-0{k} 12:00:00"),) for k in (1, 2, 3)], "at timestamp_ntz")
    assert backfill.filter_days(df, "at", "2024-01-01 05:00:00", "2024-01-03 03:00:00").count() == 2
    assert backfill.filter_days(df, "at", "2024-01-01 05:00:00", "2024-01-03 03:00:01").count() == 3
    assert backfill.filter_days(df, "at", "2024-01-02 03:00:00", "2024-01-02 03:00:00").count() == 1


def test_larger_day_stands_alone(spark):
    data = [(day, k) for day, n in (("2024-01-01", 2), ("2024-01-02", 2), ("2024-01-03", 9), ("2024-01-04", 1)) for k in range(n)]
    df = frame(spark, [(t(f"{day} 00:00:00"), k) for day, k in data], "at timestamp_ntz, k int")
    got = {r[0].isoformat(): r[1] for r in backfill.volume_windows(df, "at", 4).select(F.to_date("at"), "window_id").distinct().collect()}
    assert got == {"2024-01-01": 0, "2024-01-02": 0, "2024-01-03": 1, "2024-01-04": 2}


def test_decryption_keeps_what_it_cannot_read(spark):
    key, iv = b"k" * 32, b"i" * 16
    df = frame(spark, [(1, "secret"), (2, "")], "id int, x string")
    sealed = df.withColumn("x", F.base64(F.substring(F.aes_encrypt("x", F.lit(key), F.lit("CBC"), F.lit("PKCS"), F.lit(iv)), 17, 1000)))
    odd = frame(spark, [(3, None), (4, "not base64!"), (5, "AAAA")], "id int, x string")
    assert rows(protect.decrypt_columns(sealed.union(odd), ["x"], key, iv)) == [(1, "secret"), (2, ""), (3, None), (4, "not base64!"), (5, "AAAA")]


def test_sales_split(spark):
    df = frame(spark, [(1, "2024-01-01"), (2, "2024-01-01 10:00:00"), (3, "no"), (4, None)], "tx_id int, created_at string")
    valid, rejects = sales.split_valid(df, "2024-02-01 00:00:00")
    assert sorted(r["tx_id"] for r in valid.collect()) == [1, 2]
    assert sorted((r["tx_id"], r["reason"]) for r in rejects.collect()) == [(3, "INVALID_CREATED_AT"), (4, "MISSING_CREATED_AT")]


def test_status_is_compared_by_name(spark):
    rows = [(1, "k", 1, None), (1, "k", 2, 1), (1, "k", 4, None), (1, "k", 5, 2), (2, "k", 1, 8), (2, "k", 2, 8), (2, "k", 3, None), (2, "k", 4, 1), (2, "k", 5, 3), (1, "k", 6, 1), (2, "k", 6, None)]
    history = frame(spark, rows, "run_id int, pix_key string, client_id int, status int")
    history = history.withColumns({"status_name": shared_keys.code_name("status", shared_keys.STATUS_NAMES), "accounts": F.lit(5)})
    got = [(r["client_id"], r["accounts"], r["previous_status"], r["status"], r["change"]) for r in shared_keys.shared_key_diff(history, 2, 1).collect()]
    assert sorted(got, key=str) == [
        (1, 5, "Unknown", "Disabled", "status changed"), (2, 5, "Active", "Disabled", "status changed"), (3, 5, None, "Unknown", "new"), (4, 5, "Unknown", "Active", "status changed"), (6, 5, "Active", "Unknown", "status changed"),
    ]
    assert shared_keys.shared_key_diff(history, 1, None).count() == 5
    assert shared_keys.previous_run(history, 1).first()["previous_run"] is None


def test_soft_delete_scope(spark):
    now = t("2024-01-01 00:00:00")
    usage = frame(spark, [(1, "a", 1, 5, True, None, now), (2, "b", 1, 5, True, None, now)], "client_id int, pix_key string, pix_type int, uses long, is_active boolean, deleted_at timestamp_ntz, updated_at timestamp_ntz")
    recomputed = frame(spark, [(1, "c", 1, 2)], "client_id int, pix_key string, pix_type int, uses long")
    scope = frame(spark, [(1,)], "client_id int")
    state = lambda s: {(r["client_id"], r["pix_key"]): r["is_active"] for r in shared_keys.soft_delete_sync(usage, recomputed, s, "2024-02-01 00:00:00").collect()}
    assert state(scope) == {(1, "a"): False, (1, "c"): True, (2, "b"): True}
    assert state(None) == {(1, "a"): False, (1, "c"): True, (2, "b"): False}


def test_generic_report_gathers_what_can_be_shown(spark):
    from playmart.operators import reports

    data = [(k % 40, None if k % 9 == 0 else "" if k % 2 else f"é case {k}") for k in range(400)]
    for some in (data, data[:5], data[:1], []):
        for limit in (60, 200, 3500):
            lines = "\n".join("* " + m for _, m in sorted((c, m) for c, m in some if m is not None)).encode()
            head, note = f"T: {len(some)} cases\n".encode(), f"\n[cut, {len(some)} cases in all]".encode()
            whole = head + lines
            if len(whole) > limit:
                whole = head + lines[: limit - len(head) - len(note)].decode(errors="ignore").encode() + note
            report = reports.generic_report(frame(spark, some, "client_id long, message string"), "T", limit)
            assert [r["message"] for r in report.collect()] == [whole.decode()]
    assert "TakeOrderedAndProject" in report._jdf.queryExecution().toString()


def test_blank_keys_pair_nobody(spark):
    now = t("2024-01-01 00:00:00")
    usage = frame(spark, [(1, " ", 1, 3, True), (2, " ", 1, 3, True), (1, "k", 1, 3, True), (3, "k", 1, 3, True), (4, "k", 1, 3, False)], "client_id int, pix_key string, pix_type int, uses long, is_active boolean")
    users = frame(spark, [(1, now, 1), (2, now, 1), (3, t("2020-01-01 00:00:00"), 1)], "id int, registration_date timestamp_ntz, status int")
    got = alerts.detect_new_account_shared_key(usage, users, "2024-01-01 10:00:00").collect()
    assert [(r["client_id"], r["previous_client_id"], r["value"]) for r in got] == [(1, 3, 1)]


def test_grants_without_a_client_are_no_burst(spark):
    now = t("2024-01-01 00:00:00")
    grants = frame(spark, [(c, now, b, None) for c in (None, 7) for b in range(5)], "client_id int, awarding_time timestamp_ntz, bonus_id int, bonus_prize int")
    assert [r["client_id"] for r in alerts.detect_burst(grants, "2024-01-01 00:10:00").collect()] == [7]


def test_repeated_stage_rows_do_not_multiply_sales(spark):
    a, b = t("2024-01-01 00:00:00"), t("2024-02-01 00:00:00")
    held = frame(spark, [(1, a, 5, a), (3, a, 7, a)], "tx_id int, created_at timestamp_ntz, amount int, imported_at timestamp_ntz")
    stage = frame(spark, [(1, a, 9, b), (1, a, 8, b), (2, a, 1, b)], "tx_id int, created_at timestamp_ntz, amount int, imported_at timestamp_ntz")
    got = sorted((r["tx_id"], r["amount"], r["imported_at"]) for r in sales.sale_upsert(held, stage).collect())
    assert got == [(1, 8, b), (2, 1, b), (3, 7, a)]
    log = frame(spark, [(1, a, a, 4)], "tx_id int, first_seen timestamp_ntz, last_seen timestamp_ntz, times int")
    rejects = frame(spark, [(1, b), (1, b)], "tx_id int, rejected_at timestamp_ntz")
    assert [(r["times"], r["last_seen"]) for r in sales.reject_log(log, rejects).collect()] == [(5, b)]


def test_burst_message_lists_every_client(spark):
    from playmart.operators import reports

    cases = spark.range(1000, 3000).select(F.col("id").alias("client_id"), F.lit(2).cast("long").alias("distinct_bonuses"), F.lit(3).cast("long").alias("value"))
    row = reports.burst_report(cases, "2024-01-01 00:00:00").first()
    assert row["message"] == "Bursts\n2000 clients, at most 2 kinds\n" + ", ".join(map(str, range(1000, 3000)))


def test_signup_message_lists_every_client(spark):
    from playmart.operators import reports

    cases = spark.range(1000, 3000).selectExpr("id as client_id", "cast(2 as decimal(12,1)) as value", "cast(null as long) as same_person", "'new' as kind")
    row = reports.signup_report(cases, "2024-01-01 00:00:00").first()
    assert row["message"] == "Fresh signups\n2000 cases, mean 2.0 min\n" + ", ".join(map(str, range(1000, 3000)))
