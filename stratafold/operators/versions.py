"""Table versions: write, audit, publish.

A table is a folder of complete versions plus a log of those published and a
log of those expired, both only ever appended to.  Readers take the newest
published version, so a failed or unfinished write is never seen.  One writer
at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratafold.operators.writers import replace_table
from stratafold.sources.files import scan_table
from stratafold.workspace import fresh_path

LOG_SCHEMA = (
    StructType().add("version", "long").add("name", "string").add("published_at", "timestamp").add("batch", "long")
)
EXPIRED_SCHEMA = StructType().add("version", "long")

Audit = Callable[[DataFrame], object]


@dataclass(frozen=True)
class VersionedTable:
    """``schema`` is needed where partition values would be read as another type."""

    spark: SparkSession
    root: str
    schema: StructType | None = None

    @property
    def log_path(self) -> str:
        return f"{self.root}/_published"

    @property
    def expired_path(self) -> str:
        return f"{self.root}/_expired"

    @property
    def data_path(self) -> str:
        return f"{self.root}/versions"

    def log(self) -> DataFrame:
        """The live versions, one row each."""
        published = scan_table(self.spark, self.log_path, LOG_SCHEMA)
        if published is None:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        expired = scan_table(self.spark, self.expired_path, EXPIRED_SCHEMA)
        return published if expired is None else published.join(expired, "version", "left_anti")

    def read(self) -> DataFrame | None:
        """The newest published version; None before the first."""
        newest = self._newest()
        if newest is None:
            return None
        stored = scan_table(self.spark, f"{self.data_path}/{newest.name}", self.schema)
        # Partition columns come last in files; a declared schema says where they belong.
        return stored.select(*self.schema.names) if self.schema else stored

    def publish(
        self,
        df: DataFrame,
        as_of: dt.datetime,
        *,
        by: Sequence[str] = (),
        audit: Audit | None = None,
        batch: int | None = None,
    ) -> DataFrame:
        """Write ``df`` as a new version, audit what was written, then publish it.

        ``audit`` gets the staged table and raises to reject it: the newest
        published version stays what it was.  ``batch`` is logged with the version.
        """
        name = uuid.uuid4().hex
        path = f"{self.data_path}/{name}"
        replace_table(df, path, by)
        staged = self.spark.read.schema(_stored_schema(df, by)).parquet(path)
        if audit is not None:
            audit(staged)
        entry = self.spark.createDataFrame([(self.number() + 1, name, as_of, batch)], LOG_SCHEMA)
        entry.coalesce(1).write.mode("append").parquet(self.log_path)
        return staged

    def expire(self, versions: DataFrame) -> int:
        """Take versions off the live log; their files become orphans."""
        path = fresh_path(self.spark, "expiring")
        versions.select("version").coalesce(1).write.parquet(path)
        gone = self.spark.read.schema(EXPIRED_SCHEMA).parquet(path)
        count = gone.count()
        if count:
            gone.write.mode("append").parquet(self.expired_path)
        return count

    def number(self) -> int:
        """Number of the newest published version, -1 before the first."""
        newest = self._newest()
        return -1 if newest is None else newest.version

    def last_batch(self) -> int | None:
        """The greatest batch number published, expired versions too; None if there is none."""
        published = scan_table(self.spark, self.log_path, LOG_SCHEMA)
        return None if published is None else published.agg(F.max("batch")).first()[0]

    def live_folders(self) -> set[str]:
        """Names of the folders of live versions."""
        return {r["name"] for r in self.log().select("name").collect()}

    def newest_path(self) -> str | None:
        """Where the newest published version lies."""
        newest = self._newest()
        return None if newest is None else f"{self.data_path}/{newest.name}"

    def _newest(self):
        return self.log().orderBy(F.col("version").desc()).first()


def _stored_schema(df: DataFrame, by: Sequence[str]):
    return df.select(*[c for c in df.columns if c not in by], *by).schema
