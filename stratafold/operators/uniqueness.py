"""Uniqueness against all of a table's history, checked for the partitions that changed only.

A register keeps 128 bits per key and partition, and a Bloom filter over the keys of all
partitions.  A refresh reads the changed partitions, asks the filter which of their new keys some
other partition may hold, and looks those up exactly, in the register's folders they belong to.
Keys found in several partitions (none, where the rule holds) are kept in a table of their own, so
that replacing a partition takes its part in them back.

A version is published by one append to a log after all it needs is written; a refresh that breaks
off leaves the version before, and the next one writes over what it left.  One writer is assumed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from stratafold.operators.bloom import bitmaps, block_of, blocks_for, maybe_in
from stratafold.operators.buckets import row_digests
from stratafold.operators.joins import broadcast_if_small
from stratafold.operators.versions import VersionedTable
from stratafold.operators.writers import NULL_PARTITION, in_partitions, replace_table
from stratafold.sources.files import folder_entries
from stratafold.workspace import delete_folder, materialise

PARTS = "part string, generation long, rows long, keys long"
KEYS = "part string, d0 long, d1 long, n long"
STORED_KEYS = f"{KEYS}, generation long, place int"
FILTER = "block long, bitmap binary, blocks long"

DIGEST = ["d0", "d1"]


def partition_text(value: Column, kind) -> Column:
    """A partition value as the text that names it; an empty text is the NULL partition, as writers have it."""
    text = F.nullif(value.cast(kind).cast("string"), F.lit(NULL_PARTITION))
    return F.coalesce(F.nullif(text, F.lit("")) if isinstance(kind, StringType) else text, F.lit(NULL_PARTITION))


def changed_parts(table: DataFrame, changed: DataFrame, partition: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the partitions that ``changed`` names, their names as ``part``, each once and written)."""
    rows, _ = in_partitions(table, changed, partition)
    kind = table.schema[partition].dataType
    names = changed.select(partition_text(F.col(changed.columns[0]), kind).alias("part")).distinct()
    return rows.withColumn("_part", partition_text(F.col(partition), kind)), materialise(names, "changed")


@dataclass(frozen=True)
class KeyRegister:
    """The keys (``columns``) of a table partitioned by ``partition``, kept under ``root``.

    Rows with a NULL in a key column do not count.  A key may repeat in a partition, in others, or
    both; NULL and empty text are one partition.  ``bits_per_key`` is what the filter has for a key at
    least: with 32, about six keys in a million are looked up in vain by the usual formula.  ``places`` is
    the number of folders the keys of one refresh go to.  Values stand for themselves by 128 bits of hash.
    """

    spark: SparkSession
    root: str
    columns: tuple[str, ...]
    partition: str
    bits_per_key: int = 32
    places: int = 16

    @property
    def _parts(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/parts", StructType.fromDDL(PARTS))

    @property
    def keys_path(self) -> str:
        return f"{self.root}/keys"

    def parts(self) -> DataFrame:
        """One row per partition: the refresh its keys are from, its rows with a key and its distinct keys."""
        kept = self._parts.read()
        return self.spark.createDataFrame([], PARTS) if kept is None else kept

    def _of(self, kind: str, number: int, schema: str) -> DataFrame:
        if number < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/generation={number}")

    def clashes(self) -> DataFrame:
        """A row per partition and key, of keys that several partitions hold."""
        return self._of("clashes", self._parts.number(), KEYS)

    def _stored(self, parts: DataFrame) -> DataFrame:
        """The keys of the partitions in ``parts``, from the folders of their refreshes only."""
        if parts.isEmpty():
            return self.spark.createDataFrame([], STORED_KEYS)
        stored = self.spark.read.schema(STORED_KEYS).parquet(self.keys_path)
        listed, _ = in_partitions(stored, parts.select("generation"), "generation")
        return listed.join(broadcast_if_small(parts.select("part", "generation")), ["part", "generation"], "left_semi")

    def _keys_of(self, rows: DataFrame) -> DataFrame:
        present = rows.dropna(subset=list(self.columns))
        keys = [f"_key_{i}" for i, _ in enumerate(self.columns)]
        counted = present.groupBy("_part", *[F.col(c).alias(k) for c, k in zip(self.columns, keys)]).agg(F.count("*").alias("_n"))
        d0, d1 = row_digests(keys)
        digests = counted.select(F.col("_part").alias("part"), d0.alias("d0"), d1.alias("d1"), F.col("_n").alias("n"))
        return digests.withColumn("place", F.pmod("d1", F.lit(self.places)).cast("int"))

    def refresh(self, table: DataFrame, changed: DataFrame, as_of: dt.datetime) -> dict[str, int]:
        """Take in the partitions that ``changed`` (one column) names as they are in ``table`` now.

        A partition without rows goes.  The result tells how many keys were new to their partition,
        how many of them the filter let through, and how many rows of other partitions they met.
        """
        number = self._parts.number()
        parts = self.parts()
        rows, names = changed_parts(table, changed, self.partition)
        replaced = parts.join(names, "part", "left_semi")
        others = materialise(parts.join(names, "part", "left_anti"), "others")

        path = f"{self.keys_path}/generation={number + 1}"
        replace_table(self._keys_of(rows), path, ["place"])
        new = self.spark.read.schema(f"{KEYS}, place int").parquet(path)
        news = new.groupBy("part").agg(F.sum("n").alias("rows"), F.count("*").alias("keys"))
        current = others.unionByName(news.select("part", F.lit(number + 1).cast("long").alias("generation"), "rows", "keys"))

        # Keys that their partition held before are in other partitions only if they are known to be.
        fresh = new.select(*DIGEST, "place").distinct().join(self._stored(replaced).select(*DIGEST), DIGEST, "left_anti")
        fresh = materialise(fresh, "fresh-keys")
        possible = materialise(self._possible(fresh, number), "possible-keys")
        looked_in, _ = in_partitions(self._stored(others), possible.select("place"), "place")
        met = materialise(looked_in.join(broadcast_if_small(possible.select(*DIGEST)), DIGEST, "left_semi").select("part", *DIGEST, "n"), "met-keys")

        before = self.clashes()
        kept = before.join(names, "part", "left_anti").unionByName(met).distinct()
        repeated = new.groupBy(*DIGEST).agg(F.count("*").alias("holders")).filter("holders > 1").select(*DIGEST)
        contested = repeated.unionByName(kept.select(*DIGEST)).distinct()
        pool = materialise(kept.unionByName(new.join(contested, DIGEST, "left_semi").select("part", *DIGEST, "n")), "pool")
        shared = pool.groupBy(*DIGEST).agg(F.count("*").alias("holders")).filter("holders > 1")
        replace_table(pool.join(shared, DIGEST, "left_semi").select("part", *DIGEST, "n"), f"{self.root}/clashes/generation={number + 1}")

        current = materialise(current, "parts")
        self._write_filter(current, new, number)
        self._parts.publish(current, as_of)
        return {"fresh": fresh.count(), "possible": possible.count(), "met": met.count()}

    def _possible(self, fresh: DataFrame, number: int) -> DataFrame:
        """The keys that the filter cannot rule out."""
        kept = self._of("filter", number, FILTER)
        blocks = kept.select("blocks").first()
        if blocks is None:
            return fresh.limit(0)
        placed = fresh.withColumn("block", block_of("d0", blocks[0]))
        return placed.join(kept.select("block", "bitmap"), "block").filter(maybe_in("bitmap", "d1")).select(*DIGEST, "place")

    def _write_filter(self, current: DataFrame, new: DataFrame, number: int) -> None:
        """Add the new keys' bits; with twice the keys, make it anew, which also drops those of replaced partitions."""
        keys = current.agg(F.coalesce(F.sum("keys"), F.lit(0))).first()[0]
        needed = blocks_for(keys, self.bits_per_key)
        kept = self._of("filter", number, FILTER)
        made = kept.select("blocks").first()
        if made is None or made[0] < needed:
            bits, blocks = bitmaps(self._stored(current), *DIGEST, needed), needed
        else:
            blocks = made[0]
            both = kept.select("block", "bitmap").unionByName(bitmaps(new, *DIGEST, blocks))
            bits = both.groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        replace_table(bits.withColumn("blocks", F.lit(blocks).cast("long")), f"{self.root}/filter/generation={number + 1}")

    def repeats(self) -> DataFrame:
        """One row: ``_rows`` with a key, and ``_duplicates``, those beyond the first of each key."""
        within = self.parts().select("rows", (F.col("rows") - F.col("keys")).alias("more"))
        across = self.clashes().groupBy(*DIGEST).agg((F.count("*") - 1).alias("more")).select(F.lit(0).cast("long").alias("rows"), "more")
        counts = within.unionByName(across)
        return counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"), F.coalesce(F.sum("more"), F.lit(0)).alias("_duplicates"))

    def tidy(self) -> int:
        """Delete what no partition of the newest version needs; the number of folders that went."""
        number, gone = self._parts.number(), 0
        live = {r[0] for r in self.parts().select("generation").distinct().collect()}
        for kind, wanted in (("keys", live), ("clashes", {number}), ("filter", {number})):
            for entry in list(folder_entries(self.spark, f"{self.root}/{kind}")):
                if entry.name.startswith("generation=") and int(entry.name.split("=")[1]) not in wanted:
                    delete_folder(self.spark, f"{self.root}/{kind}/{entry.name}")
                    gone += 1
        return gone
