import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.elapsed import seconds_between, to_site_clock
from tidemark.sources.schemas import SCHEMAS
from tidemark.sources.site import Site, load_table, write_private, write_shared


@pytest.fixture()
def site(tmp_path):
    return Site("s1", str(tmp_path), "parquet", "America/Chicago", f"{tmp_path}/private",
                f"{tmp_path}/share")


def test_instants_become_wall_clock(spark, site):
    instant = spark.sql("""SELECT 'h' hospitalization_id, 'HR' vital_category, '7.5' vital_value,
                           timestamp'2024-07-01 12:00:00Z' recorded_dttm""")
    instant.write.parquet(f"{site.data_directory}/vitals.parquet")
    row = load_table(spark, site, "vitals", {"vital_category": ["hr"]}).first()
    assert row["recorded_dttm"] == dt.datetime(2024, 7, 1, 7)
    assert row["vital_value"] == 7.5
    assert load_table(spark, site, "vitals", {"vital_category": ["sbp"]}).count() == 0


def test_ids_missing_columns_and_optional_tables(spark, site):
    spark.createDataFrame([("h1", None), ("h2", None)], "hospitalization_id string, x int"
                          ).write.parquet(f"{site.data_directory}/adt.parquet")
    with pytest.raises(ValueError, match="missing columns"):
        load_table(spark, site, "adt")
    assert load_table(spark, site, "crrt_therapy").schema == SCHEMAS["crrt_therapy"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_table(spark, site, "patient")
    one = spark.createDataFrame([("p1", "F", "w", "n"), ("p2", "M", "w", "n")],
                                SCHEMAS["patient"])
    one.write.parquet(f"{site.data_directory}/patient.parquet")
    kept = load_table(spark, site, "patient", ids=one.where("patient_id = 'p2'").select(
        "patient_id"))
    assert [r[0] for r in kept.collect()] == ["p2"]


def test_spellings_are_scanned_once_for_each_state_of_the_files(spark, site, monkeypatch):
    rows = spark.sql("""SELECT concat('h', id) hospitalization_id, element_at(array('HR', 'hr', 'Hr', 'SBP'), cast(id % 4 + 1 AS INT))
                        vital_category, CAST(id AS DOUBLE) vital_value, timestamp_ntz'2024-07-01 12:00:00' recorded_dttm FROM range(40)""")
    path = f"{site.data_directory}/vitals.parquet"
    rows.write.parquet(path)
    context = spark.sparkContext

    def load(group):
        context.setJobGroup(group, group)
        found = load_table(spark, site, "vitals", {"vital_category": ["hr"]})
        jobs = len(context.statusTracker().getJobIdsForGroup(group))
        context.setJobGroup("other", "other")
        return found, jobs

    first, jobs = load("first")
    assert first.count() == 30 and jobs > 0
    again, jobs = load("again")
    assert jobs == 0 and again.count() == 30 and again.schema == first.schema
    assert "In(vital_category, [HR,Hr,hr]" in again._jdf.queryExecution().toString()
    spark.sql("""SELECT 'x' hospitalization_id, 'hR' vital_category, 1D vital_value,
                 timestamp_ntz'2024-07-01 12:00:00' recorded_dttm""").write.mode("append").parquet(path)
    grown, jobs = load("grown")
    assert grown.count() == 31 and jobs > 0
    monkeypatch.setattr("tidemark.sources.catalogue.MOST_SPELLINGS", 2)
    other = Site("s2", site.data_directory, "parquet", site.timezone, f"{site.data_directory}/other", "x")
    assert load_table(spark, other, "vitals", {"vital_category": ["hr"]}).count() == 31


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_other_formats(spark, tmp_path, kind):
    site = Site("s1", str(tmp_path), kind, "UTC", "x", "y")
    df = spark.createDataFrame([("h1", "2024-01-01 00:00:00")],
                               "hospitalization_id string, recorded_dttm string")
    writer = df.write.option("header", "true") if kind == "csv" else df.write
    writer.format(kind).save(f"{tmp_path}/crrt_therapy.{kind}")
    assert load_table(spark, site, "crrt_therapy").first()[1] == dt.datetime(2024, 1, 1)


def test_outputs(spark, site):
    df = spark.createDataFrame([(1, "a")], "n int, c string")
    assert spark.read.parquet(write_private(df, site, "rows")).count() == 1
    path = write_shared(df, site, "tables", "t.csv")
    assert path.endswith("/share/tables/s1_t.csv")
    assert spark.read.csv(path, header=True).first()["site_id"] == "s1"
    with pytest.raises(ValueError):
        site.shared("other", "x")


def test_elapsed_ignores_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("""SELECT timestamp_ntz'2024-03-09 12:00:00' a,
                          timestamp_ntz'2024-03-10 12:00:00.9' b,
                          timestamp'2024-07-01 12:00:00Z' c""")
        row = df.select(seconds_between("a", "b"), seconds_between("b", "a"),
                        to_site_clock("c", "America/Chicago"),
                        F.lit(1)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (row[0], row[1]) == (86400, -86400)
    assert row[2] == dt.datetime(2024, 7, 1, 7)
