"""What is known of an input table's files: its stored schema and the spellings of its category columns.

One small document per table and state of its files lies beside the private outputs. It is read and written through the
file system that the path names, so a load that finds one starts no job before the read. The state is a hash of
names, sizes and times of all files; other files mean another document.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MOST_SPELLINGS = 10_000  # a column with more is no category: it is filtered without them


class TableCatalogue:
    """Schema and spellings of the files under one path, kept in ``folder``."""

    def __init__(self, spark: SparkSession, path: str, folder: str) -> None:
        self.spark = spark
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.state = self._state(path)
        name = path.rstrip("/").rsplit("/", 1)[-1]
        self.path = self._path(f"{folder.rstrip('/')}/_catalogue/{name}-{self.state}.json") if self.state else None
        self.facts = self._read()

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _state(self, path: str) -> str | None:
        """Hash of the files' names, sizes and times; None if there is nothing."""
        at = self._path(path)
        files = at.getFileSystem(self._conf)
        if not files.exists(at):
            return None
        found, listed = [], files.listFiles(at, True)
        while listed.hasNext():
            one = listed.next()
            found.append(f"{one.getPath()} {one.getLen()} {one.getModificationTime()}")
        return sha256("\n".join(sorted(found)).encode()).hexdigest()[:24]

    def _read(self) -> dict:
        if self.path is None or not (files := self.path.getFileSystem(self._conf)).exists(self.path):
            return {}
        stream = files.open(self.path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self) -> None:
        if self.path is None:
            return
        stream = self.path.getFileSystem(self._conf).create(self.path, True)
        try:
            stream.write(json.dumps(self.facts, ensure_ascii=True).encode("ascii"))
        finally:
            stream.close()

    @property
    def schema(self) -> T.StructType | None:
        return T.StructType.fromJson(self.facts["schema"]) if "schema" in self.facts else None

    def keep_schema(self, schema: T.StructType) -> None:
        self.facts["schema"] = schema.jsonValue()
        self._write()

    def spellings(self, table: DataFrame, column: str, values: Sequence[str]) -> list[str] | None:
        """Stored values of a column that match ``values`` without regard to case; None if the column has too many.

        The column is scanned once for each state of the files.
        """
        known = self.facts.setdefault("spellings", {})
        if column not in known:
            found = [r[0] for r in table.select(F.col(column).cast("string")).where(F.col(column).isNotNull())
                     .distinct().limit(MOST_SPELLINGS + 1).collect()]
            known[column] = sorted(found) if len(found) <= MOST_SPELLINGS else None
            self._write()
        if known[column] is None:
            return None
        wanted = {v.lower() for v in values}
        return [v for v in known[column] if v.lower() in wanted]
