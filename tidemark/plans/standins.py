"""Frames derived from the TPC-H-like tables that play the clinical roles.

``events`` are the measurements and administrations of an entity (``user_id``), ``orders``
are entities with an owner (``o_custkey``), ``lineitem`` rows are encounters with a provider
(``l_suppkey``) in a site (the supplier's nation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.elapsed import quarter_of, year_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def of_type(df: DataFrame, *kinds: str) -> DataFrame:
    return df.where(F.col("event_type").isin(list(kinds)))


def first_signup(ev: DataFrame) -> DataFrame:
    """Index event: the first sign-up of each user."""
    return of_type(ev, "signup").groupBy("user_id").agg(F.min("ts").alias("index_time"))


def stays(ev: DataFrame) -> DataFrame:
    """Each event opens a stay of ``value`` hours; stays opened by an error stay open."""
    seconds = (F.col("value") * 3600).cast("decimal(18,6)")
    return ev.select(
        "user_id", "event_type", F.concat(F.lit("T"), (F.col("event_id") % 4).cast("string"))
        .alias("unit_type"), (F.col("event_id") % 7).alias("site"),
        F.when(F.col("event_id") % 2 == 0, "academic").otherwise("community").alias("site_type"),
        F.col("ts").alias("started"),
        F.when(F.col("event_type") != "error", F.col("ts") + F.make_dt_interval(secs=seconds))
        .alias("ended"))


STAYS_SQL = """stays AS (
  SELECT user_id, event_type, 'T' || (event_id % 4)::VARCHAR AS unit_type,
         event_id % 7 AS site,
         CASE WHEN event_id % 2 = 0 THEN 'academic' ELSE 'community' END AS site_type,
         ts AS started,
         CASE WHEN event_type <> 'error'
              THEN ts + to_microseconds(CAST(round(value * 3600, 6) * 1000000 AS BIGINT)) END
           AS ended
  FROM events)"""

INDEX_SQL = """idx AS (
  SELECT user_id, min(ts) AS index_time FROM events WHERE event_type = 'signup'
  GROUP BY user_id)"""


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line: site, provider, drug, dose, weight (missing for small quantities)."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    sites = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    weight = F.when(F.col("l_quantity") > 2, F.col("l_quantity"))
    return (lines.join(sites, lines["l_suppkey"] == sites["s_suppkey"])
            .select(
                "l_orderkey", "l_linenumber", "l_partkey",
                F.col("s_nationkey").alias("site"), F.col("l_suppkey").alias("provider"),
                F.col("l_linestatus").alias("drug"), F.col("l_returnflag").alias("place"),
                F.col("l_extendedprice").alias("dose"), weight.alias("weight"),
                (F.col("l_extendedprice") / weight).alias("dose_per_weight"),
                F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
                (F.col("l_returnflag") == "R").cast("int").alias("returned"),
                F.col("l_shipdate").alias("at"), year_of("l_shipdate").alias("year"),
                quarter_of("l_shipdate").alias("quarter")))


ENCOUNTERS_SQL = """enc AS (
  SELECT l_orderkey, l_linenumber, l_partkey, s_nationkey AS site, l_suppkey AS provider,
         l_linestatus AS drug, l_returnflag AS place, l_extendedprice AS dose,
         CASE WHEN l_quantity > 2 THEN l_quantity END AS weight,
         l_extendedprice / CASE WHEN l_quantity > 2 THEN l_quantity END AS dose_per_weight,
         l_discount AS discount, l_tax AS tax,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
         l_shipdate AS at, year(l_shipdate) AS year, quarter(l_shipdate) AS quarter
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
