from pyspark.sql import functions as F

from stratafold.operators.maintenance import compact
from stratafold.operators.writers import in_partitions, replace_table
from stratafold.session import RECOMMENDED
from tests.conftest import plan_of


def test_adaptive_execution_is_on(spark):
    for key in RECOMMENDED:
        if key != "spark.sql.session.timeZone":
            assert spark.conf.get(key) == "true"


def test_named_partitions_prune(spark, base):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, p string")
    replace_table(df, f"{base}/t", ["p"])
    table = spark.read.schema(df.schema).parquet(f"{base}/t")
    wanted = spark.createDataFrame([("a",), ("__HIVE_DEFAULT_PARTITION__",)], "p string")
    rows, count = in_partitions(table, wanted, "p")
    assert count == 2 and sorted(r.n for r in rows.collect()) == [1, 3]
    assert "PartitionFilters: [(" in plan_of(rows)


def test_many_named_partitions_are_joined(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, p string")
    rows, count = in_partitions(table, table.filter("n > 1").select("p"), "p", max_listed=1)
    assert count == 2 and sorted(r.n for r in rows.collect()) == [2, 3]


def test_only_compaction_shuffles_an_unpartitioned_table(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.lit(1)).repartition(8)
    replace_table(df, f"file://{tmp_path}/as-is")
    compact(spark.read.parquet(f"file://{tmp_path}/as-is"), f"file://{tmp_path}/packed")
    files = {n: len(list((tmp_path / n).glob("*.parquet"))) for n in ("as-is", "packed")}
    assert files == {"as-is": 8, "packed": 1}
