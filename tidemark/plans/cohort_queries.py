"""Queries on the event stand-ins: pairs, cohort steps, windows, stays, measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.elapsed import shift
from ..functions.recode import level_of
from ..operators import cohort as C, features as X, temporal as T
from ..operators.describe import count_matrix, histogram, pair_timing_stats, stacked_stats
from ..operators.subanalyses import gap_for_excluded, pre_post_change
from .registry import query
from .standins import INDEX_SQL, STAYS_SQL, events, first_signup, of_type, stays, table

HOUR, DAY = 3600.0, 86400.0

_PAIRS_SQL = """a AS (SELECT user_id, ts, event_type AS c, value AS v FROM events
       WHERE event_type IN ('signup', 'click')),
b AS (SELECT user_id, ts, event_type AS c, value AS v FROM events
      WHERE event_type IN ('purchase', 'view')),
pairs AS (
  SELECT a.user_id, least(a.ts, b.ts) AS index_time,
         abs(date_sub('second', a.ts, b.ts)) / 60.0 AS gap_minutes,
         a.ts AS a_time, b.ts AS b_time, a.c AS a_category, b.c AS b_category,
         a.v AS a_value, b.v AS b_value
  FROM a JOIN b USING (user_id)),
wide AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY index_time, gap_minutes,
             a_time, b_time, a_category, b_category, a_value, b_value) AS rn
    FROM pairs WHERE gap_minutes <= 1440) WHERE rn = 1)"""


def _pairs(ev: DataFrame, select: str = "first_then_filter"):
    return C.index_events(ev, "user_id", "ts", "event_type", ["signup", "click"],
                          ["purchase", "view"], 1440, 240, ["value"], select)


@query("pair_first_within", f"""
WITH {_PAIRS_SQL}
SELECT user_id, index_time, round(gap_minutes, 6) AS gap_minutes, a_time, b_time, a_category,
       b_category, a_value, b_value,
       CAST(CASE WHEN gap_minutes <= 240 THEN 1 ELSE 0 END AS INTEGER) AS is_index
FROM wide""")
def pair_first_within(spark, sf):
    _, wide = _pairs(events(spark, sf))
    return wide.select(
        "user_id", "index_time", F.round("gap_minutes", 6).alias("gap_minutes"), "a_time",
        "b_time", "a_category", "b_category", "a_value", "b_value",
        (F.col("gap_minutes") <= 240).cast("int").alias("is_index"))


@query("pair_filter_then_first", f"""
WITH {_PAIRS_SQL},
near AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY index_time, gap_minutes, a_time,
         b_time, a_category, b_category, a_value, b_value) AS rn2
  FROM pairs WHERE gap_minutes <= 240)
SELECT user_id, index_time, a_time, b_time FROM near WHERE rn2 = 1""")
def pair_filter_then_first(spark, sf):
    index, _ = _pairs(events(spark, sf), "filter_then_first")
    return index.select("user_id", "index_time", "a_time", "b_time")


@query("pair_timing_stats", f"""
WITH {_PAIRS_SQL},
g AS (SELECT 'Overall' AS grp, gap_minutes AS x FROM wide
      UNION ALL SELECT a_category || ' + ' || b_category, gap_minutes FROM wide),
r AS (SELECT grp, x, row_number() OVER (PARTITION BY grp ORDER BY x) AS rn,
             count(*) OVER (PARTITION BY grp) AS n FROM g)
SELECT grp AS "group", count(*) AS count, round(median(x), 6) AS median,
       round(avg(x), 6) AS mean,
       round(max(CASE WHEN rn = floor((n - 1) * 0.25 + 0.5) + 1 THEN x END), 6) AS p25,
       round(max(CASE WHEN rn = floor((n - 1) * 0.75 + 0.5) + 1 THEN x END), 6) AS p75,
       round(min(x), 6) AS min, round(max(x), 6) AS max
FROM r GROUP BY grp""")
def pair_timing(spark, sf):
    _, wide = _pairs(events(spark, sf))
    stats = pair_timing_stats(wide, "gap_minutes", "a_category", "b_category")
    return stats.select("group", "count", *[
        F.round(c, 6).alias(c) for c in ("median", "mean", "p25", "p75", "min", "max")])


@query("pair_gap_histogram", f"""
WITH {_PAIRS_SQL}
SELECT CAST(least(floor(gap_minutes / 24.0), 59) AS BIGINT) AS bin, count(*) AS n,
       24.0 * least(floor(gap_minutes / 24.0), 59) AS bin_start
FROM wide GROUP BY 1, 3""")
def pair_gap_histogram(spark, sf):
    _, wide = _pairs(events(spark, sf))
    return histogram(wide, "gap_minutes", 24.0, (), 0.0, 1440.0)


@query("pair_matrix", f"""
WITH {_PAIRS_SQL}
SELECT w.a_category || ' + ' || w.b_category AS pair,
       count(*) FILTER (WHERE user_id % 3 = 0) AS east,
       count(*) FILTER (WHERE user_id % 3 = 1) AS north,
       count(*) FILTER (WHERE user_id % 3 = 2) AS west
FROM wide w GROUP BY 1""")
def pair_matrix(spark, sf):
    _, wide = _pairs(events(spark, sf))
    place = (F.when(F.col("user_id") % 3 == 0, "east").when(F.col("user_id") % 3 == 1, "north")
             .otherwise("west"))
    both = F.concat("a_category", F.lit(" + "), "b_category")
    return count_matrix(wide.withColumn("place", place), both, "place",
                        ["east", "north", "west"])


@query("cohort_flow", f"""
WITH {_PAIRS_SQL}, {INDEX_SQL},
users AS (SELECT user_id, count(*) AS n_events, min(ts) AS first_seen FROM events
          GROUP BY user_id),
err AS (SELECT DISTINCT user_id FROM wide JOIN events USING (user_id)
        WHERE event_type = 'error' AND gap_minutes <= 240
          AND date_sub('second', ts, index_time) > 0
          AND date_sub('second', ts, index_time) <= 7200),
f AS (
  SELECT u.user_id, n_events >= 40 AS s1,
         first_seen >= TIMESTAMP '2024-01-01' AND first_seen < TIMESTAMP '2024-01-02' AS s2,
         coalesce(w.gap_minutes <= 240, false) AS s3, w.user_id IS NULL AS no_pair,
         e.user_id IS NULL AS s4, coalesce(w.a_value BETWEEN 1 AND 100, false) AS s5
  FROM users u LEFT JOIN wide w USING (user_id) LEFT JOIN err e USING (user_id)),
c AS (
  SELECT count(*) AS n0, count(*) FILTER (WHERE s1) AS n1,
         count(*) FILTER (WHERE s1 AND s2) AS n2,
         count(*) FILTER (WHERE s1 AND s2 AND s3) AS n3,
         count(*) FILTER (WHERE s1 AND s2 AND no_pair) AS np,
         count(*) FILTER (WHERE s1 AND s2 AND NOT no_pair AND NOT s3) AS nl,
         count(*) FILTER (WHERE s1 AND s2 AND s3 AND s4) AS n4,
         count(*) FILTER (WHERE s1 AND s2 AND s3 AND s4 AND s5) AS n5 FROM f)
SELECT 0 AS step, 'Users' AS description, n0 AS n_remaining, CAST(0 AS BIGINT) AS n_excluded,
       NULL AS exclusion_reason, CAST(NULL AS BIGINT) AS n_late_pair,
       CAST(NULL AS BIGINT) AS n_no_pair FROM c
UNION ALL SELECT 1, 'At least 40 events', n1, n0 - n1, 'Fewer than 40 events', NULL, NULL FROM c
UNION ALL SELECT 2, 'First seen on day one', n2, n1 - n2, 'Seen later', NULL, NULL FROM c
UNION ALL SELECT 3, 'Pair within 4 h', n3, n2 - n3, 'No pair', nl, np FROM c
UNION ALL SELECT 4, 'No error in 2 h before', n4, n3 - n4, 'Error before', NULL, NULL FROM c
UNION ALL SELECT 5, 'Feasible value', n5, n4 - n5, 'Infeasible value', NULL, NULL FROM c""")
def cohort_flow(spark, sf):
    ev = events(spark, sf)
    index, wide = _pairs(ev)
    users = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                      F.min("ts").alias("first_seen"))
    before = C.ids_with_event_within(index, "user_id", [
        C.Source(of_type(ev, "error"), "ts", "index_time", -2 * HOUR, 0.0, "[)")])
    base = C.with_flag(users.join(wide.select("user_id", "gap_minutes", "a_value"), "user_id",
                                  "left"), before, "user_id", "had_error")
    gap = F.col("gap_minutes")
    first = F.col("first_seen")
    day_one = ((first >= F.lit("2024-01-01").cast("timestamp_ntz"))
               & (first < F.lit("2024-01-02").cast("timestamp_ntz")))
    _, flow = C.inclusion_exclusion(base, [
        C.Step("At least 40 events", F.col("n_events") >= 40, "Fewer than 40 events"),
        C.Step("First seen on day one", day_one, "Seen later"),
        C.Step("Pair within 4 h", gap <= 240, "No pair",
               {"n_no_pair": gap.isNull(), "n_late_pair": gap > 240}),
        C.Step("No error in 2 h before", F.col("had_error") == 0, "Error before"),
        C.Step("Feasible value", F.col("a_value").between(1, 100), "Infeasible value"),
    ], "Users")
    return flow


@query("location_at_index", f"""
WITH {INDEX_SQL}, {STAYS_SQL}
SELECT user_id, site, event_type, unit_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY started DESC, site, event_type,
            unit_type) AS rn
  FROM idx JOIN stays USING (user_id)
  WHERE index_time >= started AND index_time < ended
    AND event_type IN ('signup', 'view')) WHERE rn = 1""")
def location_at_index(spark, sf):
    ev = events(spark, sf)
    return C.location_at(first_signup(ev), stays(ev), "user_id", "index_time", "started",
                         "ended", ["site", "event_type", "unit_type"], "event_type",
                         ["signup", "view"])


@query("first_event_within", f"""
WITH {INDEX_SQL}
SELECT user_id, min(ts) AS first_view FROM idx JOIN events USING (user_id)
WHERE event_type = 'view' AND date_sub('second', index_time, ts) BETWEEN 0 AND 21600
GROUP BY user_id""")
def first_event_within(spark, sf):
    ev = events(spark, sf)
    return C.first_event_within(first_signup(ev), of_type(ev, "view"), "user_id", "index_time",
                                "ts", 0, 6 * HOUR, "first_view")


@query("exclude_if_event_within", f"""
WITH {INDEX_SQL},
bad AS (
  SELECT user_id FROM idx JOIN events USING (user_id)
  WHERE event_type = 'error' AND date_sub('second', ts, index_time) > 0
    AND date_sub('second', ts, index_time) <= 86400
  UNION
  SELECT user_id FROM (SELECT user_id, min(ts) AS began FROM events GROUP BY user_id)
  JOIN events USING (user_id)
  WHERE event_type = 'click' AND date_sub('second', began, ts) BETWEEN 0 AND 86400)
SELECT user_id, index_time FROM idx WHERE user_id NOT IN (SELECT user_id FROM bad)""")
def exclude_if_event_within(spark, sf):
    ev = events(spark, sf)
    began = ev.groupBy("user_id").agg(F.min("ts").alias("began"))
    index = first_signup(ev).join(began, "user_id")
    return C.exclude_if_event_within(index, "user_id", [
        C.Source(of_type(ev, "error"), "ts", "index_time", -DAY, 0.0, "[)"),
        C.Source(of_type(ev, "click"), "ts", "began", 0.0, DAY),
    ]).select("user_id", "index_time")


@query("exclude_if_multiple", """
SELECT o_custkey, count(*) AS n_orders FROM orders
WHERE o_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1)
GROUP BY o_custkey""")
def exclude_if_multiple(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    kept = C.exclude_if_multiple(orders, orders, "o_custkey", "o_orderpriority",
                                 ["1-URGENT", "2-HIGH"])
    return kept.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))


_ORDERS_SQL = """oidx AS (
  SELECT o_orderkey AS k, o_custkey AS owner, o_orderdate AS began,
         o_orderdate + INTERVAL 30 DAY AS index_time
  FROM orders WHERE o_orderpriority = '1-URGENT'),
m AS (SELECT l_orderkey AS k, l_shipdate AS t, l_quantity AS v FROM lineitem),
pre AS (SELECT k, max(t) AS t, max_by(v, (t, v)) AS v FROM oidx JOIN m USING (k)
        WHERE t <= index_time GROUP BY k),
post AS (SELECT k, min(t) AS t, min_by(v, (t, v)) AS v FROM oidx JOIN m USING (k)
         WHERE t > index_time GROUP BY k)"""


def _order_index(spark, sf):
    orders = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return orders.select(F.col("o_orderkey").alias("k"),
                         shift("o_orderdate", 30 * DAY).alias("index_time"))


def _order_entities(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("owner"),
        F.col("o_orderdate").alias("began"))


def _order_measures(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("t"),
        F.col("l_quantity").alias("v"))


@query("nearest_measurement", f"""
WITH {_ORDERS_SQL},
hist AS (
  SELECT i.k, max(m.t) AS t, max_by(m.v, (m.t, m.v)) AS v
  FROM oidx i JOIN orders o ON o.o_custkey = i.owner AND o.o_orderdate < i.began
  JOIN m ON m.k = o.o_orderkey AND m.t <= i.index_time GROUP BY i.k)
SELECT i.k, coalesce(pre.v, hist.v) AS value, coalesce(pre.t, hist.t) AS value_time,
       CASE WHEN pre.t IS NOT NULL THEN 'current' WHEN hist.t IS NOT NULL THEN 'earlier'
            ELSE 'none' END AS value_source,
       date_sub('second', coalesce(pre.t, hist.t), index_time) / 3600.0 AS value_gap_hours,
       post.v AS post_value, post.t AS post_time,
       date_sub('second', index_time, post.t) / 3600.0 AS post_gap_hours
FROM oidx i LEFT JOIN pre USING (k) LEFT JOIN hist USING (k) LEFT JOIN post USING (k)""")
def nearest_measurement(spark, sf):
    index, measures = _order_index(spark, sf), _order_measures(spark, sf)
    history = T.from_history(index, _order_entities(spark, sf), measures, "k", "owner", "began",
                             "index_time", "t", "v")
    return T.nearest_measurement(
        index, measures, "k", "index_time", "t", "v",
        {"current": "current", "history": "earlier", "none": "none"}, history
    ).drop("index_time")


@query("gap_for_excluded", f"""
WITH {_ORDERS_SQL},
ex AS (SELECT * FROM oidx WHERE k NOT IN (SELECT k FROM pre)),
allm AS (
  SELECT e.k, m.t, m.v FROM ex e JOIN m USING (k) WHERE m.t < e.index_time
  UNION ALL
  SELECT e.k, m.t, m.v FROM ex e
  JOIN orders o ON o.o_custkey = e.owner AND o.o_orderdate < e.began
   AND date_sub('second', o.o_orderdate, e.began) <= 365.25 * 86400
  JOIN m ON m.k = o.o_orderkey AND m.t < e.index_time),
p AS (SELECT k, max(t) AS t, max_by(v, (t, v)) AS v FROM allm GROUP BY k)
SELECT k, p.t AS pre_time, p.v AS pre_value, post.t AS post_time, post.v AS post_value,
       date_sub('second', p.t, post.t) / 86400.0 AS gap_days, post.v - p.v AS change
FROM p JOIN post USING (k)""")
def gap_excluded(spark, sf):
    index, measures = _order_index(spark, sf), _order_measures(spark, sf)
    near = T.around(index, measures, "k", "index_time", "t", "v")
    without = C.drop_ids(index, near.where(F.col("before_time").isNotNull()), "k")
    history = T.from_history(without, _order_entities(spark, sf), measures, "k", "owner",
                             "began", "index_time", "t", "v", 365.25, True)
    return gap_for_excluded(without, measures, "k", "index_time", "t", "v", history)


_WINDOWS = {"24h": DAY, "6h": 6 * HOUR, "1h": HOUR}
_LAST_INDEX_SQL = """lidx AS (
  SELECT user_id, max(ts) AS index_time FROM events WHERE event_type = 'purchase'
  GROUP BY user_id),
w AS (SELECT user_id, event_type, value, date_sub('second', ts, index_time) AS secs
      FROM lidx JOIN events USING (user_id)
      WHERE date_sub('second', ts, index_time) BETWEEN 0 AND 86400)"""


def _last_purchase(ev):
    return of_type(ev, "purchase").groupBy("user_id").agg(F.max("ts").alias("index_time"))


def _per_window(template: str, pad: str = ", ") -> str:
    return pad.join(template.format(s=s, n=int(n)) for s, n in _WINDOWS.items())


@query("window_features", f"""
WITH {_LAST_INDEX_SQL}
SELECT lidx.user_id, {_per_window('''
  max(CASE WHEN event_type = 'view' AND secs <= {n} THEN value END) AS highest_view_{s},
  min(CASE WHEN event_type = 'click' AND secs <= {n} THEN value END) AS lowest_click_{s},
  min(CASE WHEN event_type = 'error' AND secs <= {n} THEN value END) AS lowest_error_{s}''')}
FROM lidx LEFT JOIN w USING (user_id) GROUP BY lidx.user_id""")
def window_features(spark, sf):
    ev = events(spark, sf)
    kind = F.col("event_type")
    return X.lookback_features(
        _last_purchase(ev), ev.select("user_id", "ts", "event_type", "value"), "user_id",
        "index_time", "ts", _WINDOWS, [
            X.Feature("highest_view", "max", kind == "view", "value"),
            X.Feature("lowest_click", "min", kind == "click", "value"),
            X.Feature("lowest_error", "min", kind == "error", "value")])


@query("window_flags", f"""
WITH {_LAST_INDEX_SQL}
SELECT lidx.user_id, {_per_window('''
  max(CASE WHEN secs <= {n} THEN CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
      WHEN 'signup' THEN 2 WHEN 'error' THEN 3 END END) AS highest_level_{s},
  CAST(coalesce(max(CASE WHEN event_type = 'view' AND secs <= {n} THEN 1 END), 0) AS TINYINT)
    AS any_view_{s},
  CAST(coalesce(max(CASE WHEN event_type = 'error' AND secs <= {n} THEN 1 END), 0) AS TINYINT)
    AS any_error_{s}''')}
FROM lidx LEFT JOIN w USING (user_id) GROUP BY lidx.user_id""")
def window_flags(spark, sf):
    ev = events(spark, sf)
    kind = F.col("event_type")
    leveled = ev.select("user_id", "ts", "event_type", level_of(
        "event_type", {"view": 1, "click": 2, "signup": 2, "error": 3}).alias("level"))
    return X.lookback_features(
        _last_purchase(ev), leveled, "user_id", "index_time", "ts", _WINDOWS, [
            X.Feature("highest_level", "max", F.lit(True), "level"),
            X.Feature("any_view", "any", kind == "view"),
            X.Feature("any_error", "any", kind == "error")])


@query("window_flags_dose", f"""
WITH {_LAST_INDEX_SQL}, f AS (
SELECT lidx.user_id, {_per_window('''
  CAST(coalesce(max(CASE WHEN event_type = 'view' AND secs <= {n} THEN 1 END), 0) AS TINYINT)
    AS any_view_{s},
  max(CASE WHEN event_type = 'view' AND secs <= {n} THEN value END) AS view_dose_{s},
  CAST(coalesce(max(CASE WHEN event_type = 'error' AND secs <= {n} THEN 1 END), 0) AS TINYINT)
    AS any_error_{s},
  max(CASE WHEN event_type = 'error' AND secs <= {n} THEN value END) AS error_dose_{s}''')}
FROM lidx LEFT JOIN w USING (user_id) GROUP BY lidx.user_id)
SELECT *, {_per_window('greatest(any_view_{s}, any_error_{s}) AS any_drug_{s}')} FROM f""")
def window_flags_dose(spark, sf):
    ev = events(spark, sf)
    features = [f for c in ("view", "error") for f in (
        X.Feature(f"any_{c}", "any", F.col("event_type") == c),
        X.Feature(f"{c}_dose", "max", F.col("event_type") == c, "value"))]
    return X.lookback_features(
        _last_purchase(ev), ev.select("user_id", "ts", "event_type", "value"), "user_id",
        "index_time", "ts", _WINDOWS, features, {"any_drug": ["any_view", "any_error"]})


@query("push_dose_flags", f"""
WITH {_LAST_INDEX_SQL}
SELECT lidx.user_id,
       CAST(coalesce(max(CASE WHEN event_type = 'view' AND secs <= 7200 THEN 1 END), 0)
            AS TINYINT) AS push_view,
       CAST(coalesce(max(CASE WHEN event_type = 'signup' AND secs <= 7200 THEN 1 END), 0)
            AS TINYINT) AS push_signup
FROM lidx LEFT JOIN w USING (user_id) GROUP BY lidx.user_id""")
def push_dose_flags(spark, sf):
    ev = events(spark, sf)
    return X.category_flags_before(_last_purchase(ev), ev, "user_id", "index_time", "ts",
                                   "event_type", {"view": "push_view", "signup": "push_signup"},
                                   2 * HOUR)


@query("prior_exposure_flags", f"""
WITH {_LAST_INDEX_SQL}
SELECT lidx.user_id,
       CAST(coalesce(max(CASE WHEN event_type = 'error' THEN 1 END), 0) AS TINYINT)
         AS exposed_24h,
       CAST(coalesce(max(CASE WHEN event_type = 'error' AND secs <= 21600 THEN 1 END), 0)
            AS TINYINT) AS exposed_6h
FROM lidx LEFT JOIN w USING (user_id) GROUP BY lidx.user_id""")
def prior_exposure_flags(spark, sf):
    ev = events(spark, sf)
    return X.flags_before(_last_purchase(ev), ev, "user_id", "index_time", "ts",
                          {"exposed_24h": DAY, "exposed_6h": 6 * HOUR},
                          F.col("event_type") == "error")


@query("onset_within_days", f"""
WITH {_LAST_INDEX_SQL},
onset AS (SELECT user_id, min(ts) AS onset_time FROM events
          WHERE event_type = 'error' AND value > 100 GROUP BY user_id)
SELECT lidx.user_id,
       CAST(coalesce(max(CASE WHEN date_sub('second', onset_time, index_time)
                               BETWEEN 0 AND 604800 THEN 1 END), 0) AS TINYINT) AS onset_7d
FROM lidx LEFT JOIN onset USING (user_id) GROUP BY lidx.user_id""")
def onset_within_days(spark, sf):
    ev = events(spark, sf)
    onset = (of_type(ev, "error").where(F.col("value") > 100).groupBy("user_id")
             .agg(F.min("ts").alias("onset_time")))
    return X.flags_before(_last_purchase(ev), onset, "user_id", "index_time", "onset_time",
                          {"onset_7d": 7 * DAY})


_UNIT_SQL = f"""{INDEX_SQL}, {STAYS_SQL},
place AS (
  SELECT user_id, site, event_type AS location_at_index,
         CASE WHEN event_type = 'view' THEN unit_type END AS unit_type_at_index, site_type
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY started DESC, site,
               event_type, CASE WHEN event_type = 'view' THEN unit_type END, site_type) AS rn
        FROM idx JOIN stays USING (user_id)
        WHERE index_time >= started AND index_time < ended) WHERE rn = 1),
days AS (SELECT user_id, sum(date_sub('second', started, ended) / 86400.0) AS unit_days
         FROM stays WHERE event_type = 'view' GROUP BY user_id),
who AS (SELECT user_id, min_by(provider, (ts, provider)) AS provider
        FROM (SELECT user_id, ts, event_id % 11 AS provider FROM events
              WHERE event_type = 'purchase' AND value > 60) GROUP BY user_id),
unit AS (SELECT * FROM place FULL JOIN days USING (user_id) FULL JOIN who USING (user_id))"""


def _unit(ev):
    codes = ev.select("user_id", "ts", "event_type", "value",
                      (F.col("event_id") % 11).alias("provider"))
    wanted = (F.upper("event_type") == "PURCHASE") & (F.col("value") > 60)
    return X.unit_and_provider(first_signup(ev), stays(ev), codes, "user_id", "index_time",
                               "started", "ended", "event_type", "unit_type", "site",
                               "site_type", "view", wanted, "ts", "provider")


@query("unit_and_provider", f"""
WITH {_UNIT_SQL}
SELECT user_id, site, location_at_index, unit_type_at_index, site_type,
       round(unit_days, 6) AS unit_days, provider FROM unit""")
def unit_and_provider(spark, sf):
    return _unit(events(spark, sf)).withColumn("unit_days", F.round("unit_days", 6))


_OUTCOME_SQL = f"""adm AS (
  SELECT user_id, min(ts) AS began, max(ts) AS finished,
         max_by(CASE WHEN event_type = 'error' THEN 'Expired' ELSE 'Home' END, ts) AS status,
         min(CASE WHEN event_type = 'signup' THEN ts END) AS index_time
  FROM events GROUP BY user_id),
lasts AS (SELECT user_id, event_type AS last_location FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ended DESC NULLS LAST,
            started DESC, event_type DESC) AS rn FROM stays) WHERE rn = 1),
outc AS (
  SELECT user_id, date_sub('second', began, finished) / 86400.0 AS los_days,
         CAST(CASE WHEN status = 'Expired' THEN 1 ELSE 0 END AS TINYINT) AS died,
         CAST(CASE WHEN status = 'Expired' AND last_location = 'view' THEN 1 ELSE 0 END
              AS TINYINT) AS died_in_unit
  FROM adm LEFT JOIN lasts USING (user_id))"""


def _admissions(ev):
    status = F.when(F.col("event_type") == "error", "Expired").otherwise("Home")
    return ev.groupBy("user_id").agg(
        F.min("ts").alias("began"), F.max("ts").alias("finished"),
        F.max_by(status, "ts").alias("status"),
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("index_time"))


def _outcomes(ev):
    return X.outcomes(_admissions(ev), stays(ev), "user_id", "began", "finished", "status",
                      "started", "ended", "event_type", "view", "expired|death")


@query("outcomes", f"""
WITH {STAYS_SQL}, {_OUTCOME_SQL}
SELECT user_id, round(los_days, 6) AS los_days, died, died_in_unit FROM outc""")
def outcomes(spark, sf):
    return _outcomes(events(spark, sf)).withColumn("los_days", F.round("los_days", 6))


_WIDE_SQL = f"""{_UNIT_SQL}, {_OUTCOME_SQL},
w6 AS (SELECT idx.user_id,
         max(CASE WHEN event_type = 'view' AND secs <= 86400 THEN value END) AS highest_view_24h,
         CAST(coalesce(max(CASE WHEN event_type = 'error' AND secs <= 86400 THEN 1 END), 0)
              AS TINYINT) AS any_error_24h,
         max(CASE WHEN event_type = 'view' AND secs <= 21600 THEN value END) AS highest_view_6h,
         CAST(coalesce(max(CASE WHEN event_type = 'error' AND secs <= 21600 THEN 1 END), 0)
              AS TINYINT) AS any_error_6h
       FROM idx LEFT JOIN (
         SELECT user_id, event_type, value, date_sub('second', ts, index_time) AS secs
         FROM idx JOIN events USING (user_id)
         WHERE date_sub('second', ts, index_time) BETWEEN 0 AND 86400) USING (user_id)
       GROUP BY idx.user_id),
wideframe AS (
  SELECT * FROM idx LEFT JOIN w6 USING (user_id) LEFT JOIN unit USING (user_id)
  LEFT JOIN outc USING (user_id))"""


def _wide(ev):
    index = first_signup(ev)
    looked = X.lookback_features(
        index, ev.select("user_id", "ts", "event_type", "value"), "user_id", "index_time", "ts",
        {"24h": DAY, "6h": 6 * HOUR}, [
            X.Feature("highest_view", "max", F.col("event_type") == "view", "value"),
            X.Feature("any_error", "any", F.col("event_type") == "error")])
    return X.assemble_wide(index, [looked, _unit(ev), _outcomes(ev)], "user_id")


@query("assemble_wide", f"""
WITH {_WIDE_SQL}
SELECT user_id, index_time, highest_view_24h, any_error_24h, highest_view_6h, any_error_6h,
       site, location_at_index, unit_type_at_index, site_type, round(unit_days, 6) AS unit_days,
       provider, round(los_days, 6) AS los_days, died, died_in_unit FROM wideframe""")
def assemble_wide(spark, sf):
    return (_wide(events(spark, sf)).withColumn("unit_days", F.round("unit_days", 6))
            .withColumn("los_days", F.round("los_days", 6)))


@query("modeling_view", f"""
WITH {_WIDE_SQL}
SELECT user_id AS entity, highest_view_24h AS worst_view, any_error_24h AS error_before,
       site AS hospital, provider, CAST(year(index_time) AS SMALLINT) AS calendar_year,
       CAST(quarter(index_time) AS TINYINT) AS calendar_quarter,
       CAST(year(index_time) - min(year(index_time)) OVER () AS SMALLINT) AS calendar_year_c,
       'site_a' AS site_id
FROM wideframe""")
def modeling_view(spark, sf):
    view = X.modeling_view(_wide(events(spark, sf)), {
        "user_id": "entity", "highest_view_24h": "worst_view", "any_error_24h": "error_before",
        "site": "hospital", "provider": "provider"}, "index_time", {"site_id": "site_a"})
    return X.centred_year(view)


_CHANGE_SQL = """midx AS (
  SELECT user_id, min(ts) AS index_time,
         CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS arm
  FROM events WHERE event_type = 'purchase' GROUP BY user_id),
mv AS (SELECT user_id, ts, value, index_time FROM midx
       JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'view') USING (user_id)),
b4 AS (SELECT user_id, max(ts) AS t, max_by(value, (ts, value)) AS v FROM mv
       WHERE ts <= index_time AND date_sub('second', ts, index_time) / 3600.0 <= 100
       GROUP BY user_id),
aft AS (SELECT user_id, min(ts) AS t, min_by(value, (ts, value)) AS v FROM mv
        WHERE ts > index_time AND date_sub('second', index_time, ts) / 3600.0 <= 100
        GROUP BY user_id),
chg AS (
  SELECT user_id, arm, index_time, b4.t AS before_time, b4.v AS before_value,
         aft.t AS after_time, aft.v AS after_value,
         date_sub('second', b4.t, index_time) / 3600.0 AS pre_hours_before,
         date_sub('second', index_time, aft.t) / 3600.0 AS post_hours_after,
         date_sub('second', b4.t, aft.t) / 3600.0 AS pre_to_post_hours, aft.v - b4.v AS change
  FROM midx LEFT JOIN b4 USING (user_id) LEFT JOIN aft USING (user_id))"""
_CHANGE_METRICS = ["pre_hours_before", "post_hours_after", "pre_to_post_hours", "change"]


def _change(ev):
    index = (of_type(ev, "purchase").groupBy("user_id").agg(F.min("ts").alias("index_time"))
             .withColumn("arm", F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")))
    return pre_post_change(index, of_type(ev, "view"), "user_id", "index_time", "ts", "value")


@query("pre_post_change", f"""
WITH {_CHANGE_SQL}
SELECT user_id, arm, before_time, before_value, after_time, after_value,
       round(pre_hours_before, 6) AS pre_hours_before,
       round(post_hours_after, 6) AS post_hours_after,
       round(pre_to_post_hours, 6) AS pre_to_post_hours, round(change, 6) AS change FROM chg""")
def pre_post(spark, sf):
    rows = _change(events(spark, sf)).drop("index_time")
    return rows.select(*[c for c in rows.columns if c not in _CHANGE_METRICS],
                       *[F.round(m, 6).alias(m) for m in _CHANGE_METRICS])


@query("pre_post_change_stats", f"""
WITH {_CHANGE_SQL},
l AS (SELECT arm, metric, x FROM chg UNPIVOT (x FOR metric IN
      ({', '.join(_CHANGE_METRICS)}))),
g AS (SELECT 'overall' AS group_by, 'all' AS group_value, metric, x FROM l
      UNION ALL SELECT 'arm', arm, metric, x FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY group_by, group_value, metric ORDER BY x) AS rn,
             count(*) OVER (PARTITION BY group_by, group_value, metric) AS k FROM g)
SELECT group_by, group_value, metric, count(*) AS n, round(median(x), 6) AS median,
       round(avg(x), 6) AS mean,
       round(max(CASE WHEN rn = floor((k - 1) * 0.25 + 0.5) + 1 THEN x END), 6) AS p25,
       round(max(CASE WHEN rn = floor((k - 1) * 0.75 + 0.5) + 1 THEN x END), 6) AS p75,
       round(min(x), 6) AS min, round(max(x), 6) AS max
FROM r GROUP BY group_by, group_value, metric""")
def pre_post_stats(spark, sf):
    stats = stacked_stats(_change(events(spark, sf)), _CHANGE_METRICS, {"arm": F.col("arm")})
    return stats.select("group_by", "group_value", "metric", "n", *[
        F.round(c, 6).alias(c) for c in ("median", "mean", "p25", "p75", "min", "max")])
