"""Queries of bonus aggregates, score and watchlist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.scratch import written
from playmart.operators import bonus, cdc
from playmart.plans.registry import query
from playmart.sources.testdata import Data

AS_OF = "2000-06-30"
LIVE = "live AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC, synced_at DESC) AS rn FROM v_grants WHERE is_deleted = 0) WHERE rn = 1)"
_RECENT = "synced_at >= TIMESTAMP '2000-06-01 00:00:00' AND synced_at < TIMESTAMP '2000-07-01 00:00:00'"
_AGG = """SELECT client_id, bonus_id, max(partner_id) AS partner_id, CAST(count(*) AS BIGINT) AS grants, CAST(sum(bonus_prize) AS DECIMAL(18,2)) AS prize, CAST(sum(cost) AS DECIMAL(18,2)) AS cost,
      max(reuse_number) AS max_reuse, CAST(sum(turnover_left) AS DECIMAL(18,2)) AS turnover_left, min(awarding_time) AS first_award, max(awarding_time) AS last_award, max(synced_at) AS source_updated_at
    FROM live WHERE client_id IS NOT NULL AND bonus_id IS NOT NULL {where} GROUP BY 1, 2"""
_PAIRS = f"SELECT DISTINCT client_id, bonus_id FROM live WHERE {_RECENT} AND client_id IS NOT NULL AND bonus_id IS NOT NULL"


def live(d: Data) -> DataFrame:
    return cdc.drop_deleted(d.v_grants, ["id"])


def live_once(d: Data, *columns: str) -> DataFrame:
    """Columns of the living grants as a table, for what reads them several times."""
    return written(live(d).select(*columns), "live")


# text, as a Column can't be made before there is a session
_CHANGED = "synced_at >= timestamp_ntz '2000-06-01 00:00:00' and synced_at < timestamp_ntz '2000-07-01 00:00:00'"


def _recent(d: Data) -> DataFrame:
    return live(d).where(_CHANGED)


@query(f"WITH {LIVE} {_PAIRS}", "v_grants")
def F1_impacted_pairs(d: Data) -> DataFrame:
    return bonus.impacted_pairs(_recent(d))


@query(f"WITH {LIVE}, p AS ({_PAIRS}) {_AGG.format(where='AND (client_id, bonus_id) IN (SELECT (client_id, bonus_id) FROM p)')}", "v_grants")
def F2_bonus_agg(d: Data) -> DataFrame:
    return bonus.bonus_agg(live(d), changed=F.expr(_CHANGED))


@query(
    f"""WITH {LIVE}, new AS ({_AGG.format(where='')}), old AS ({_AGG.format(where="AND synced_at < TIMESTAMP '2000-06-01 00:00:00'")}), p AS ({_PAIRS})
    SELECT client_id, bonus_id, grants, cost FROM new WHERE (client_id, bonus_id) IN (SELECT (client_id, bonus_id) FROM p)
    UNION ALL SELECT client_id, bonus_id, grants, cost FROM old WHERE (client_id, bonus_id) NOT IN (SELECT (client_id, bonus_id) FROM p)""",
    "v_grants",
)
def F3_bonus_agg_upsert(d: Data) -> DataFrame:
    old = bonus.bonus_agg(live(d).where("synced_at < timestamp_ntz '2000-06-01 00:00:00'"))
    stage = bonus.bonus_agg(live(d), changed=F.expr(_CHANGED))
    return bonus.bonus_agg_upsert(old, stage).select("client_id", "bonus_id", "grants", "cost")


@query(
    f"""WITH {LIVE}, agg AS ({_AGG.format(where="AND synced_at < TIMESTAMP '2001-06-01 00:00:00'")}),
    newest AS (SELECT client_id, bonus_id, max(synced_at) AS newest FROM live WHERE client_id IS NOT NULL AND bonus_id IS NOT NULL GROUP BY 1, 2)
    SELECT n.client_id, n.bonus_id FROM newest n LEFT JOIN agg a ON n.client_id = a.client_id AND n.bonus_id = a.bonus_id
    WHERE newest >= TIMESTAMP '2001-05-02 00:00:00' AND (a.source_updated_at IS NULL OR a.source_updated_at < newest)""",
    "v_grants",
)
def F4_stale_pairs(d: Data) -> DataFrame:
    agg = bonus.bonus_agg(live(d).where("synced_at < timestamp_ntz '2001-06-01 00:00:00'"))
    return bonus.stale_pairs(live(d), agg, "2001-08-01", days=91)


_METRICS = """SELECT client_id, partner_id, CAST(sum(grants) AS BIGINT) AS grants, CAST(coalesce(sum(cost), 0) AS DECIMAL(18,2)) AS cost, max(max_reuse) AS max_reuse,
      CAST(coalesce(sum(turnover_left), 0) AS DECIMAL(18,2)) AS turnover_left FROM agg GROUP BY 1, 2"""
_UP_TO_METRICS = f"{LIVE}, agg AS ({_AGG.format(where='')}), metrics AS ({_METRICS})"
_CUT = {s: f"round(quantile_cont(CAST({m} AS DOUBLE), 0.99), 6)" for s, m in bonus.SIGNALS.items()}
_CUTS = " UNION ALL ".join(f"SELECT '{s}' AS signal, {c} AS cutoff FROM metrics" for s, c in _CUT.items())
_SCORE = f"""SELECT metrics.*, CAST({' + '.join(f'CASE WHEN CAST(metrics.{m} AS DOUBLE) > c.{s} THEN 1 ELSE 0 END' for s, m in bonus.SIGNALS.items())} AS INTEGER) AS score
    FROM metrics, (SELECT {', '.join(f'{c} AS {s}' for s, c in _CUT.items())} FROM metrics) c"""


def metrics(d: Data) -> DataFrame:
    return bonus.client_bonus_metrics(bonus.bonus_agg(live(d)))


def metrics_once(d: Data) -> DataFrame:
    """The metrics as a table: cut-offs take several passes over them, and score and watchlist read them again."""
    return written(metrics(d), "metrics")


def scored(d: Data) -> DataFrame:
    m = metrics_once(d)
    return bonus.risk_score(m, bonus.p99_cutoffs(m))


@query(f"WITH {_UP_TO_METRICS} SELECT * FROM metrics", "v_grants")
def F5_client_bonus_metrics(d: Data) -> DataFrame:
    return metrics(d)


@query(f"WITH {_UP_TO_METRICS} {_CUTS}", "v_grants")
def F6_p99_cutoffs(d: Data) -> DataFrame:
    return bonus.p99_cutoffs(metrics(d))


@query(
    f"""WITH {_UP_TO_METRICS}, cuts AS ({_CUTS}), days AS (SELECT unnest([DATE '2000-06-28', DATE '2000-06-29']) AS day)
    SELECT day, signal, CAST(1.0 AS DOUBLE) AS cutoff FROM days, cuts UNION ALL SELECT DATE '{AS_OF}', signal, cutoff FROM cuts""",
    "v_grants",
)
def F7_daily_cutoff_cache(d: Data) -> DataFrame:
    m = metrics_once(d)
    day = lambda s: F.lit(s).cast("date").alias("day")
    one = bonus.p99_cutoffs(m).withColumn("cutoff", F.lit(1.0))
    # today has three of four signals, so it is computed again; yesterday is complete and stays
    cache = one.select(day("2000-06-28"), "*").union(one.select(day("2000-06-29"), "*")).union(one.where("signal <> 'cost'").select(day(AS_OF), "*"))
    return bonus.daily_cutoff_cache(bonus.daily_cutoff_cache(cache, m, AS_OF), m, "2000-06-29")


@query(f"WITH {_UP_TO_METRICS} {_SCORE}", "v_grants")
def F8_risk_score(d: Data) -> DataFrame:
    return scored(d)


_OLD_LIST = f"""old AS (SELECT client_id, partner_id, score % 2 AS score, CAST(NULL AS INTEGER) AS previous_score, FALSE AS crossed, 3 AS days_flagged, CASE WHEN client_id % 2 = 0 THEN DATE '2000-01-01' END AS first_alert,
      CASE client_id % 3 WHEN 0 THEN DATE '{AS_OF}' WHEN 1 THEN DATE '2000-06-29' END AS last_alert FROM scored WHERE client_id % 4 <> 0)"""
_UPDATE = f"""SELECT o.client_id, o.partner_id, s.score, o.score AS previous_score, s.score >= 2 AND o.score < 2 AS crossed,
      CAST(o.days_flagged + CASE WHEN s.score >= 2 AND o.last_alert IS DISTINCT FROM DATE '{AS_OF}' THEN 1 ELSE 0 END AS INTEGER) AS days_flagged,
      coalesce(o.first_alert, CASE WHEN s.score >= 2 THEN DATE '{AS_OF}' END) AS first_alert, CASE WHEN s.score >= 2 THEN DATE '{AS_OF}' ELSE o.last_alert END AS last_alert
    FROM old o JOIN scored s ON o.client_id = s.client_id AND o.partner_id = s.partner_id"""
_INSERT = f"""SELECT client_id, partner_id, score, CAST(NULL AS INTEGER) AS previous_score, score >= 2 AS crossed, CASE WHEN score >= 2 THEN 1 ELSE 0 END AS days_flagged,
      CASE WHEN score >= 2 THEN DATE '{AS_OF}' END AS first_alert, CASE WHEN score >= 2 THEN DATE '{AS_OF}' END AS last_alert
    FROM scored s WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.client_id = s.client_id AND o.partner_id = s.partner_id)"""


def _watchlist(s: DataFrame) -> DataFrame:
    date = lambda v: F.lit(v).cast("date")
    c = F.col("client_id")
    return s.where(c % 4 != 0).select(
        "client_id", "partner_id", (F.col("score") % 2).alias("score"), F.lit(None).cast("int").alias("previous_score"), F.lit(False).alias("crossed"), F.lit(3).alias("days_flagged"),
        F.when(c % 2 == 0, date("2000-01-01")).alias("first_alert"), F.when(c % 3 == 0, date(AS_OF)).when(c % 3 == 1, date("2000-06-29")).alias("last_alert"),
    )


@query(f"WITH {_UP_TO_METRICS}, scored AS ({_SCORE}), {_OLD_LIST} {_UPDATE} UNION ALL {_INSERT}", "v_grants")
def F9_watchlist_update(d: Data) -> DataFrame:
    s = scored(d)
    return bonus.watchlist_update(_watchlist(s), s, AS_OF)


@query(f"WITH {_UP_TO_METRICS}, scored AS ({_SCORE}), {_OLD_LIST} {_INSERT}", "v_grants")
def F10_watchlist_insert(d: Data) -> DataFrame:
    s = scored(d)
    return bonus.watchlist_insert(_watchlist(s), s, AS_OF)
