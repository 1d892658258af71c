"""Score queries on diagnoses and measurements derived from lines and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.recode import chain
from ..operators import scores as S
from .cohort_queries import DAY, HOUR, _last_purchase
from .registry import query
from .standins import events, of_type, table

# One code per residue of the part key, with the condition it stands for.
CODES = ["I21.4", "I50.9", "I73.9", "I63.5", "G30.1", "J44.1", "M05.7", "K26.4", "K70.1",
         "E11.9", "E11.4", "G81.9", "N18.3", "C34.1", "K72.9", "C78.0", "B20", "Z00.0",
         "R07.9", "J45.909", "I10", "E66.9", "41401", "4280", "25000", "25040", "19889", "4912"]


@query("charlson", """
WITH d AS (SELECT l_orderkey AS k, l_partkey % 28 AS c FROM lineitem),
f AS (SELECT k, max(c IN (1, 23)) AS chf, max(c = 4) AS dem, max(c IN (5, 19, 27)) AS pul,
             max(c = 6) AS rheu, max(c = 8) AS mild, max(c IN (10, 25)) AS dmc,
             max(c = 11) AS para, max(c = 12) AS renal, max(c = 13) AS can,
             max(c = 14) AS sev, max(c IN (15, 26)) AS met, max(c = 16) AS hiv
      FROM d GROUP BY k)
SELECT k AS l_orderkey,
       2 * chf::INT + 2 * dem::INT + pul::INT + rheu::INT + 2 * (mild AND NOT sev)::INT
       + dmc::INT + 2 * para::INT + renal::INT + 2 * (can AND NOT met)::INT + 4 * sev::INT
       + 6 * met::INT + 4 * hiv::INT AS cci_score FROM f""")
def charlson(spark, sf):
    codes = F.array(*[F.lit(c) for c in CODES])
    place = (F.col("l_partkey") % len(CODES)).cast("int")
    diagnoses = table(spark, sf, "lineitem").select(
        "l_orderkey", F.element_at(codes, place + 1).alias("code"),
        F.when(place >= 22, "ICD9CM").otherwise("ICD10CM").alias("code_format"))
    return S.comorbidity_index(diagnoses, "l_orderkey", "code", "code_format")


@query("sofa", """
WITH idx AS (SELECT user_id, max(ts) AS index_time FROM events WHERE event_type = 'purchase'
             GROUP BY user_id),
w AS (SELECT user_id, event_type AS e, value AS v, event_id % 3 = 0 AS alt,
             date_sub('second', ts, index_time) AS secs
      FROM idx JOIN events USING (user_id)
      WHERE date_sub('second', ts, index_time) BETWEEN 0 AND 86400),
g AS (SELECT user_id, n.hours,
        min(CASE WHEN e = 'view' THEN v * 3 END) AS platelets,
        max(CASE WHEN e = 'click' AND NOT alt THEN v / 20 END) AS creatinine,
        max(CASE WHEN e = 'click' AND alt THEN v / 20 END) AS bilirubin,
        min(CASE WHEN e = 'error' AND NOT alt THEN v + 30 END) AS map,
        max(CASE WHEN e = 'error' AND alt THEN v / 400 END) AS nor,
        min(CASE WHEN e = 'signup' AND NOT alt THEN 3 + floor(v) % 13 END) AS gcs,
        min(CASE WHEN e = 'signup' AND alt THEN v * 6 END) AS pf,
        max(CASE WHEN e = 'purchase' AND alt THEN 1 ELSE 0 END) AS vent
      FROM w, (VALUES (24), (6)) n(hours) WHERE secs <= n.hours * 3600
      GROUP BY user_id, n.hours),
s AS (SELECT user_id, hours,
  coalesce((platelets < 150)::INT + (platelets < 100)::INT + (platelets < 50)::INT
           + (platelets < 20)::INT, 0)
  + coalesce((creatinine >= 1.2)::INT + (creatinine >= 2)::INT + (creatinine >= 3.5)::INT
             + (creatinine >= 5)::INT, 0)
  + coalesce((bilirubin >= 1.2)::INT + (bilirubin >= 2)::INT + (bilirubin >= 6)::INT
             + (bilirubin >= 12)::INT, 0)
  + coalesce((gcs < 15)::INT + (gcs < 13)::INT + (gcs < 10)::INT + (gcs < 6)::INT, 0)
  + coalesce((pf < 400)::INT + (pf < 300)::INT, 0)
  + CASE WHEN vent = 1 THEN coalesce((pf < 200)::INT + (pf < 100)::INT, 0) ELSE 0 END
  + CASE WHEN nor > 0.1 THEN 4 WHEN nor > 0 THEN 3 WHEN map < 70 THEN 1 ELSE 0 END AS sofa
  FROM g)
SELECT user_id, max(CASE WHEN hours = 24 THEN sofa END) AS sofa_24h,
       max(CASE WHEN hours = 6 THEN sofa END) AS sofa_6h FROM s GROUP BY user_id""")
def sofa(spark, sf):
    ev = events(spark, sf)
    kind, v, alt = F.col("event_type"), F.col("value"), F.col("event_id") % 3 == 0
    cases = [
        (kind == "view", "platelets", v * 3), ((kind == "click") & ~alt, "creatinine", v / 20),
        ((kind == "click") & alt, "bilirubin", v / 20),
        ((kind == "error") & ~alt, "map", v + 30),
        ((kind == "error") & alt, "norepinephrine", v / 400),
        ((kind == "signup") & ~alt, "gcs", (3 + F.floor(v) % 13).cast("double")),
        ((kind == "signup") & alt, "pf_ratio", v * 6),
        (kind == "purchase", "ventilated", alt.cast("double"))]
    measures = ev.select("user_id", "ts", chain([(c, name) for c, name, _ in cases]).alias("kind"),
                         chain([(c, value) for c, _, value in cases]).alias("amount"))
    return S.organ_failure(_last_purchase(ev), measures, "user_id", "index_time", "ts", "kind",
                           "amount", {"24h": DAY, "6h": 6 * HOUR})


@query("sepsis_event", """
WITH cult AS (SELECT user_id, ts::DATE AS d, min(ts) AS t FROM events
              WHERE event_type = 'signup' AND value > 60 GROUP BY ALL),
days AS (SELECT user_id, ts::DATE AS d, min(ts) AS t FROM events
         WHERE event_type IN ('purchase', 'click') GROUP BY ALL),
marked AS (SELECT *, CASE WHEN date_diff('day', lag(d) OVER w, d) <= 2 THEN 0 ELSE 1 END AS new
           FROM days WINDOW w AS (PARTITION BY user_id ORDER BY d)),
runs AS (SELECT user_id, run, min(d) AS f, max(d) AS l, min(t) AS t
         FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY d) AS run FROM marked)
         GROUP BY user_id, run),
ends AS (SELECT user_id, max(ts)::DATE AS e FROM events GROUP BY user_id),
good AS (SELECT user_id, f, t FROM runs JOIN ends USING (user_id)
         WHERE date_diff('day', f, l) + 1 >= 4 OR l >= e - 1),
inf AS (SELECT c.user_id, c.d, least(c.t, min(g.t)) AS onset FROM cult c JOIN good g
        ON g.user_id = c.user_id AND abs(date_diff('day', c.d, g.f)) <= 2
        GROUP BY c.user_id, c.d, c.t),
base AS (SELECT user_id, min(CASE WHEN event_id % 3 = 0 THEN value END) AS cr,
                min(CASE WHEN event_id % 3 = 1 THEN value END) AS bi,
                max(CASE WHEN event_id % 3 = 2 THEN value END) AS pl
         FROM events WHERE event_type = 'view' GROUP BY user_id),
dys AS (SELECT user_id, ts FROM events WHERE event_type = 'error' AND value > 100
        UNION ALL
        SELECT v.user_id, v.ts FROM events v JOIN base USING (user_id)
        WHERE event_type = 'view' AND (
          (event_id % 3 = 0 AND value >= 2 * cr) OR (event_id % 3 = 1 AND value >= 2
           AND value >= 2 * bi) OR (event_id % 3 = 2 AND value < 100 AND pl >= 100
           AND value <= 0.5 * pl))),
sep AS (SELECT i.user_id, min(least(i.onset, dys.ts)) AS onset FROM inf i JOIN dys
        ON dys.user_id = i.user_id AND abs(date_diff('day', i.d, dys.ts::DATE)) <= 2
        GROUP BY i.user_id)
SELECT u.user_id, (i.onset IS NOT NULL)::INT AS presumed_infection, i.onset AS infection_onset,
       (sep.onset IS NOT NULL)::INT AS sepsis, sep.onset AS sepsis_onset
FROM (SELECT DISTINCT user_id FROM cult) u
LEFT JOIN (SELECT user_id, min(onset) AS onset FROM inf GROUP BY user_id) i USING (user_id)
LEFT JOIN sep USING (user_id)""")
def sepsis_event(spark, sf):
    ev = events(spark, sf)
    labs = of_type(ev, "view").withColumn("lab", chain([
        (F.col("event_id") % 3 == 0, "creatinine"), (F.col("event_id") % 3 == 1, "bilirubin")],
        "platelets"))
    failing = S.organ_dysfunction(labs, of_type(ev, "error").where(F.col("value") > 100),
                                  "user_id", "ts", "lab", "value")
    ends = ev.groupBy("user_id").agg(F.max("ts").alias("ended"))
    return S.sepsis_event(of_type(ev, "signup").where(F.col("value") > 60),
                          of_type(ev, "purchase", "click"), failing, ends, "user_id", "ts",
                          "ended")
