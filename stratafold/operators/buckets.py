"""A current-state table in key buckets: a merge writes only buckets in which something changes.

Every version is a list of bucket folders (the manifest), most of them shared with the version
before.  Beside each bucket the manifest keeps a digest of its active rows, so a snapshot is
compared with the table without reading it: one aggregation of the snapshot tells which buckets
differ, and only those are read, joined and written.  A version is published by one append to
the manifest, after its new rows have passed an audit; readers never see half of it.  One
writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from stratafold.operators.merge import key_bucket, merge_table, refuse_repeated_keys
from stratafold.operators.writers import replace_table
from stratafold.sources.files import scan_table
from stratafold.workspace import fresh_path

BUCKET = "_bucket"
# Buckets of a new table.  Each should hold some 100 MB; their number is fixed when the first version is written.
BUCKETS = 16

MANIFEST = (
    "version long, bucket int, buckets int, name string, rows long, active_rows long, digest_0 long, digest_1 long, published_at timestamp, batch long"
)

Audit = Callable[[DataFrame], object]
# From the rows of some buckets (None if there are none yet) and new rows for them, what the buckets hold next.
Step = Callable[[DataFrame | None, DataFrame], DataFrame]


def row_digests(columns: Sequence[str]) -> list[Column]:
    """128 bits that stand for a row's values, NULLs told from texts."""
    texts = [F.col(c).cast("string") for c in columns]
    missing = F.concat(*[F.when(t.isNull(), "0").otherwise("1") for t in texts])
    return [F.xxhash64(missing, *texts), F.xxhash64(F.lit(1), *texts, missing)]


def _sums(columns: Sequence[str], counted: Column) -> list[Column]:
    """Rows that count and their digest; it does not depend on their order, and no two rows are equal."""
    digests = [F.coalesce(F.bit_xor(F.when(counted, d)), F.lit(0)) for d in row_digests(columns)]
    return [F.count_if(counted).alias("active_rows"), *[d.cast("long").alias(f"digest_{i}") for i, d in enumerate(digests)]]


@dataclass(frozen=True)
class BucketedTable:
    """The current state of entities, by ``keys``; ``schema`` holds their columns and those that a merge manages.

    Without ``active`` every row is, and without ``stamped`` no time of change is kept.
    """

    spark: SparkSession
    root: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int = BUCKETS
    active: str | None = "is_active"
    stamped: str | None = "updated_at"

    @property
    def log_path(self) -> str:
        return f"{self.root}/_published"

    @property
    def expired_path(self) -> str:
        return f"{self.root}/_expired"

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    def manifest(self) -> DataFrame:
        """One row per bucket of every live version."""
        rows = scan_table(self.spark, self.log_path, StructType.fromDDL(MANIFEST))
        if rows is None:
            return self.spark.createDataFrame([], MANIFEST)
        expired = scan_table(self.spark, self.expired_path, StructType.fromDDL("version long"))
        return rows if expired is None else rows.join(expired, "version", "left_anti")

    def log(self) -> DataFrame:
        """One row per live version: version, published_at."""
        return self.manifest().groupBy("version").agg(F.max("published_at").alias("published_at"))

    def number(self) -> int:
        """Number of the newest version, -1 before the first."""
        newest = self.manifest().agg(F.max("version")).first()[0]
        return -1 if newest is None else newest

    def _newest(self) -> list:
        """The newest version's manifest: a row per bucket, so as many as the table was made with."""
        return self.manifest().filter(F.col("version") == self.number()).orderBy("bucket").collect()

    def live_folders(self) -> set[str]:
        """Names of the folders that some live version reads."""
        return {r["name"] for r in self.manifest().select("name").distinct().collect()}

    def last_batch(self) -> int | None:
        """The greatest batch number that was folded in; None if there is none."""
        newest = self._newest()
        return newest[0]["batch"] if newest else None

    def active_rows(self) -> int:
        """Active rows of the newest version, from its manifest."""
        return sum(r["active_rows"] for r in self._newest())

    def _rows_of(self, entries: Sequence) -> DataFrame:
        paths = [f"{self.data_path}/{r['name']}/{BUCKET}={r['bucket']}" for r in entries if r["rows"]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame | None:
        """The newest published version; None before the first."""
        newest = self._newest()
        return self._rows_of(newest) if newest else None

    def merge(
        self,
        source: DataFrame,
        *,
        update: Sequence[str],
        as_of: dt.datetime,
        on_missing: Literal["keep", "deactivate"] = "keep",
        touch: Literal["changed", "always"] = "changed",
        audit: Audit | None = None,
        source_is_unique: bool = False,
    ) -> int:
        """Merge ``source`` as ``merge_table`` does and publish the result; the number of buckets rewritten.

        Without a change nothing is written and no version is made.  ``audit`` gets the new rows of
        the buckets concerned and raises to leave the table as it is; a key lies in one bucket, so
        rules about keys hold for the table if they hold there.  ``source`` is read twice, so it
        should be a written table.
        """
        before = self._newest()
        buckets = before[0]["buckets"] if before else self.buckets
        if not source_is_unique:
            source = refuse_repeated_keys(source, self.keys)
        placed = source.withColumn(BUCKET, key_bucket(self.keys, buckets))
        compared = [*self.keys, *[c for c in update if c not in (self.active, self.stamped)]]
        found = {r[BUCKET]: r for r in placed.groupBy(BUCKET).agg(*_sums(compared, F.lit(True))).collect()}
        held = {r["bucket"]: r for r in before}
        touched = [b for b in range(buckets) if self._differs(held.get(b), found.get(b), on_missing, touch)]
        if not touched:
            return 0

        target = self._rows_of([held[b] for b in touched if b in held])
        rows = placed.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = merge_table(
            target, rows, keys=self.keys, update=update, as_of=as_of, on_missing=on_missing, touch=touch,
            active=self.active, stamped=self.stamped, source_is_unique=True,
        )
        self._publish(before, buckets, touched, merged, compared, as_of, audit)
        return len(touched)

    def fold(self, batch: DataFrame, step: Step, *, as_of: dt.datetime, audit: Audit | None = None, number: int | None = None) -> int:
        """Replace the buckets that hold a key of ``batch`` by ``step(their rows, batch)``; how many there are.

        What the step gives for a key must follow from that key's rows alone; it may drop rows.
        All other buckets are neither read nor written, so the cost is that of the buckets the
        batch falls in.  With ``number``, a batch that was folded in before is passed over.  An empty
        batch makes no version, ``audit`` works as in ``merge``, and ``batch`` should be a written table.
        """
        before = self._newest()
        if number is not None and before and before[0]["batch"] is not None and number <= before[0]["batch"]:
            return 0
        buckets = before[0]["buckets"] if before else self.buckets
        touched = sorted(r[0] for r in batch.select(key_bucket(self.keys, buckets)).distinct().collect())
        if not touched:
            return 0
        held = [r for r in before if r["bucket"] in set(touched)]
        folded = step(self._rows_of(held) if held else None, batch).select(*self.schema.names)
        compared = [c for c in self.schema.names if c not in (self.active, self.stamped)]
        self._publish(before, buckets, touched, folded, compared, as_of, audit, number)
        return len(touched)

    def _publish(
        self,
        before: Sequence,
        buckets: int,
        touched: Sequence[int],
        rows: DataFrame,
        compared: Sequence[str],
        as_of: dt.datetime,
        audit: Audit | None,
        number: int | None = None,
    ) -> None:
        """Write ``rows`` as the new content of the buckets ``touched`` and publish a version of them and the others."""
        name = uuid.uuid4().hex
        path = f"{self.data_path}/{name}"
        replace_table(rows.withColumn(BUCKET, key_bucket(self.keys, buckets)), path, [BUCKET])
        staged = self.spark.read.schema(StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])).parquet(path)
        if audit is not None:
            audit(staged.select(*self.schema.names))
        counts = F.coalesce(F.col(self.active), F.lit(False)) if self.active else F.lit(True)
        sums = staged.groupBy(BUCKET).agg(F.count("*").alias("rows"), *_sums(compared, counts))
        # A bucket may have lost its last row.
        emptied = {b: (name, 0, 0, 0, 0) for b in touched}
        made = {r[BUCKET]: (name, r["rows"], r["active_rows"], r["digest_0"], r["digest_1"]) for r in sums.collect()}
        kept = {r["bucket"]: (r["name"], r["rows"], r["active_rows"], r["digest_0"], r["digest_1"]) for r in before}
        version = (before[0]["version"] if before else self.number()) + 1
        last = before[0]["batch"] if before and number is None else number
        entries = [(version, b, buckets, *entry, as_of, last) for b, entry in sorted({**kept, **emptied, **made}.items())]
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(self.log_path)

    @staticmethod
    def _differs(held, found, on_missing: str, touch: str) -> bool:
        """Whether a merge changes a bucket, by what the manifest and the source have of it."""
        if found is None:
            return held is not None and on_missing == "deactivate" and (held["active_rows"] > 0 or (touch == "always" and held["rows"] > 0))
        if held is None or touch == "always":
            return True
        same = all(held[c] == found[c] for c in ("active_rows", "digest_0", "digest_1"))
        # Without soft deletes the table may well hold more than the source.
        return not same

    def expire(self, versions: DataFrame) -> int:
        """Take versions off the live log; folders that no other version reads become orphans."""
        path = fresh_path(self.spark, "expiring")
        versions.select("version").coalesce(1).write.parquet(path)
        gone = self.spark.read.schema("version long").parquet(path)
        count = gone.count()
        if count:
            gone.write.mode("append").parquet(self.expired_path)
        return count
