"""Site settings, table reading and output routing."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.elapsed import to_site_clock
from .catalogue import TableCatalogue
from .schemas import OPTIONAL, SCHEMAS


@dataclass(frozen=True)
class Site:
    """Where a site's tables are and where its results go."""

    name: str
    data_directory: str
    filetype: str
    timezone: str
    output_directory: str
    output_to_share_directory: str

    @classmethod
    def from_json(cls, spark: SparkSession, path: str) -> "Site":
        """Settings from a JSON file on any file system Spark reads."""
        text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
        raw = json.loads(text)
        return cls(raw["site_name"], raw["data_directory"], raw["filetype"], raw["timezone"],
                   raw["output_directory"], raw["output_to_share_directory"])

    def private(self, name: str) -> str:
        """Row-level results, which stay at the site."""
        return f"{self.output_directory.rstrip('/')}/{name}"

    def shared(self, kind: str, name: str) -> str:
        """Aggregates to share: ``kind`` is figures, tables, diagnostics or models."""
        if kind not in ("figures", "tables", "diagnostics", "models", "."):
            raise ValueError(f"unknown output kind {kind}")
        folder = self.output_to_share_directory.rstrip("/")
        prefix = folder if kind == "." else f"{folder}/{kind}"
        return f"{prefix}/{self.name}_{name}"


def conform(df: DataFrame, schema: T.StructType, time_zone: str) -> DataFrame:
    """The schema's columns, cast leniently; instants become the site's wall clock."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    columns = []
    for field in schema:
        have = df.schema[field.name].dataType
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType) and isinstance(have, T.TimestampType):
            column = to_site_clock(column, time_zone)
        elif have != field.dataType:
            column = column.try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def load_table(spark: SparkSession, site: Site, name: str,
               filters: Mapping[str, Sequence[str]] | None = None,
               ids: DataFrame | None = None) -> DataFrame:
    """One input table by its schema.

    ``filters`` are short literal lists matched without regard to case (the spellings in use are kept in a catalogue of
    the table's files, so only the first load of a state scans the column); ``ids`` keeps the rows
    whose shared columns appear in another frame (a semi join, never a collected list).
    Optional tables that do not exist are empty.
    """
    schema = SCHEMAS[name]
    path = f"{site.data_directory.rstrip('/')}/{name}.{site.filetype}"
    reader = spark.read.format(site.filetype)
    if site.filetype == "csv":
        reader = reader.option("header", "true")
    known = TableCatalogue(spark, path, site.output_directory) if site.filetype == "parquet" else None
    if known is not None and known.schema is not None:
        reader = reader.schema(known.schema)
    try:
        raw = reader.load(path)
    except AnalysisException as error:
        if name in OPTIONAL and "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise
    if known is not None and known.schema is None:
        known.keep_schema(raw.schema)
    out = conform(raw, schema, site.timezone)
    for column, values in (filters or {}).items():
        # the spellings in use, so that the reader can prune by the stored values
        stored = known.spellings(out, column, values) if known is not None else None
        out = out.where(F.lower(column).isin([v.lower() for v in values]) if stored is None else F.col(column).isin(stored))
    if ids is not None:
        out = out.join(ids, [c for c in ids.columns if c in out.columns], "left_semi")
    return out


def write_private(df: DataFrame, site: Site, name: str) -> str:
    path = site.private(name)
    df.write.mode("overwrite").parquet(path)
    return path


def write_shared(df: DataFrame, site: Site, kind: str, name: str) -> str:
    """An aggregate as one CSV with the site's name. For results of bounded size."""
    path = site.shared(kind, name)
    tagged = df if "site_id" in df.columns else df.withColumn("site_id", F.lit(site.name))
    tagged.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


def flow_document(flow: DataFrame, site: Site, cohort: DataFrame, key: str,
                  owner: str) -> DataFrame:
    """One row ``site, steps[], final_cohort`` from a flow table and its cohort."""
    steps = flow.agg(F.sort_array(F.collect_list(F.struct(*flow.columns))).alias("steps"))
    size = cohort.agg(F.struct(
        F.countDistinct(key).alias("n_hospitalizations"),
        F.countDistinct(owner).alias("n_patients")).alias("final_cohort"))
    return steps.select(F.lit(site.name).alias("site"), "steps",
                        size.scalar().alias("final_cohort"))


def write_flow(document: DataFrame, site: Site, name: str) -> str:
    path = site.shared(".", name)
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
