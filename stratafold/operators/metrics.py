"""Counts of a table kept per partition, so that rules are checked without reading it again.

One row per partition holds its row count and, per column, NULLs, least and greatest value and a
HyperLogLog sketch of its values.  All of these merge, so a refresh reads only the partitions that
changed, and rules and profiles of the whole table come from the kept rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from stratafold.operators.quality import Rule, counted_columns, outcome_of_repeats, outcomes_of_counts
from stratafold.operators.uniqueness import KeyRegister, changed_parts
from stratafold.operators.versions import VersionedTable

# Types that sketches take as they are; others go in as text.
SKETCHED = (IntegerType, LongType, StringType, BinaryType)


@dataclass(frozen=True)
class PartitionMetrics:
    """Metrics of ``columns`` of a table partitioned by ``partition``, kept under ``root``.

    ``columns`` keep their table's types (those must have an order).  NULL and empty text are one partition.
    """

    spark: SparkSession
    root: str
    partition: str
    columns: tuple[StructField, ...]

    @classmethod
    def of(cls, table: DataFrame, root: str, partition: str, columns: Sequence[str]) -> PartitionMetrics:
        """Metrics of some columns of ``table``."""
        return cls(table.sparkSession, root, partition, tuple(table.schema[c] for c in columns))

    @property
    def schema(self) -> StructType:
        """One row per partition."""
        state = StructType().add("part", "string").add("rows", "long")
        for i, c in enumerate(self.columns):
            state.add(f"nulls_{i}", "long").add(f"least_{i}", c.dataType).add(f"greatest_{i}", c.dataType).add(f"sketch_{i}", "binary")
        return state

    @property
    def _table(self) -> VersionedTable:
        # The columns are part of the name: metrics of other columns are another table.
        return VersionedTable(self.spark, f"{self.root}/{'-'.join(c.name for c in self.columns) or 'rows'}", self.schema)

    def read(self) -> DataFrame:
        """The kept rows, one per partition."""
        kept = self._table.read()
        return self.spark.createDataFrame([], self.schema) if kept is None else kept

    def measured(self, rows: DataFrame) -> DataFrame:
        """Metrics of ``rows``, which name their partition in ``_part``."""
        measures = [F.count("*").alias("rows")]
        for i, c in enumerate(self.columns):
            value = F.col(c.name)
            sketched = value if isinstance(c.dataType, SKETCHED) else value.cast("string")
            measures += [
                F.count_if(value.isNull()).alias(f"nulls_{i}"),
                F.min(value).alias(f"least_{i}"),
                F.max(value).alias(f"greatest_{i}"),
                F.hll_sketch_agg(sketched).alias(f"sketch_{i}"),
            ]
        return rows.groupBy(F.col("_part").alias("part")).agg(*measures)

    def refresh(self, table: DataFrame, changed: DataFrame, as_of: dt.datetime) -> DataFrame:
        """Measure the partitions that ``changed`` (one column) names, publish and return all metrics.

        Only those partitions are listed and read.  A partition that has no rows any more goes.
        """
        rows, names = changed_parts(table, changed, self.partition)
        kept = self.read().join(names, "part", "left_anti")
        return self._table.publish(kept.unionByName(self.measured(rows)), as_of)

    def _number(self, column: str) -> int:
        names = [c.name for c in self.columns]
        if column not in names:
            raise ValueError(f"no metrics of column '{column}' are kept")
        return names.index(column)

    def counts(self, columns: Sequence[str]) -> DataFrame:
        """One row: all rows of the table and the NULLs of some columns."""
        missing = [F.coalesce(F.sum(f"nulls_{self._number(c)}"), F.lit(0)).alias(f"_missing_{i}") for i, c in enumerate(columns)]
        return self.read().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"), *missing)

    def evaluate(self, rules: Sequence[Rule], registers: Mapping[tuple[str, ...], KeyRegister] | None = None) -> DataFrame:
        """What ``quality.evaluate`` gives for ``rules``, from kept metrics alone.

        A uniqueness rule needs the register of its columns.  A rule about parents must read the table.
        """
        registers, parts = registers or {}, []
        counting = [r for r in rules if r.kind not in ("unique_count", "relationships")]
        if counting:
            parts.append(outcomes_of_counts(self.counts(counted_columns(counting)), counting))
        for rule in rules:
            if rule.kind == "relationships":
                raise ValueError(f"rule '{rule.name}' compares tables: use quality.evaluate")
            if rule.kind == "unique_count":
                if rule.columns not in registers:
                    raise ValueError(f"rule '{rule.name}' needs a register of its keys")
                parts.append(outcome_of_repeats(registers[rule.columns].repeats(), rule))
        if not parts:
            raise ValueError("a suite needs at least one rule")
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result

    def profile(self) -> DataFrame:
        """One row per column: rows, NULLs, least and greatest value as text, and about how many distinct ones."""
        merged: list[Column] = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
        for i, _ in enumerate(self.columns):
            merged += [
                F.coalesce(F.sum(f"nulls_{i}"), F.lit(0)).alias(f"nulls_{i}"),
                F.min(f"least_{i}").cast("string").alias(f"least_{i}"),
                F.max(f"greatest_{i}").cast("string").alias(f"greatest_{i}"),
                F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{i}")), F.lit(0)).alias(f"distinct_{i}"),
            ]
        shown = [
            F.struct(
                F.lit(c.name).alias("column"), "rows", F.col(f"nulls_{i}").alias("nulls"), F.col(f"least_{i}").alias("least"),
                F.col(f"greatest_{i}").alias("greatest"), F.col(f"distinct_{i}").alias("about_distinct"),
            )
            for i, c in enumerate(self.columns)
        ]
        return self.read().agg(*merged).select(F.inline(F.array(*shown)))
