"""Tables in key buckets: only what changes is read and written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratafold.operators.buckets import BucketedTable
from stratafold.operators.dedup import latest_per_key
from stratafold.operators.maintenance import maintain, unlisted_folders
from stratafold.operators.merge import merge_table
from stratafold.operators.quality import QualityError, Rule, run_suite
from stratafold.operators.versions import VersionedTable

DAY = dt.datetime(2026, 1, 1)
SCHEMA = "id long, name string, place string, is_active boolean, updated_at timestamp"


@pytest.fixture
def table(spark, base):
    schema = spark.createDataFrame([], SCHEMA).schema
    return BucketedTable(spark, f"{base}/t", schema, ("id",), 8)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, place string")


def at(day):
    return DAY + dt.timedelta(days=day)


def state(df):
    return sorted(map(tuple, df.collect()))


OPTIONS = {"update": ["name", "place"], "on_missing": "deactivate"}


def test_merges_equal_those_of_a_whole_table(spark, table):
    days = [
        [(i, f"n{i}", None if i % 7 else "x") for i in range(60)],
        [(i, f"n{i}" if i != 5 else "new", None if i % 7 else "x") for i in range(60) if i not in (9, 30)],
        [(i, f"n{i}", "" if i == 8 else None if i % 7 else "x") for i in range(3, 62)],
        [],
        [(1, None, None)],
    ]
    for options in (OPTIONS, {**OPTIONS, "touch": "always"}, {"update": ["name"], "on_missing": "keep"}):
        whole = spark.createDataFrame([], SCHEMA)
        own = BucketedTable(spark, f"{table.root}-{len(options)}-{options['on_missing']}", table.schema, ("id",), 5)
        for day, rows in enumerate(days):
            source = frame(spark, rows)
            whole = spark.createDataFrame(merge_table(whole, source, keys=["id"], as_of=at(day), **options).collect(), SCHEMA)
            own.merge(source, as_of=at(day), **options)
            assert state(own.read()) == state(whole)
            assert own.active_rows() == whole.filter("is_active").count()


def test_untouched_buckets_keep_their_files(spark, table):
    rows = [(i, f"n{i}", "x") for i in range(200)]
    assert table.merge(frame(spark, rows), as_of=at(0), **OPTIONS) == 8
    before = set(table.read().inputFiles())
    assert table.merge(frame(spark, rows), as_of=at(1), **OPTIONS) == 0 and table.number() == 0
    changed = [(i, n if i != 17 else "other", p) for i, n, p in rows]
    assert table.merge(frame(spark, changed), as_of=at(2), **OPTIONS) == 1
    after = set(table.read().inputFiles())
    assert len(before & after) == 7 and len(after - before) == 1
    assert {r.id for r in table.read().collect() if r.updated_at == at(2)} == {17}
    # A row that goes touches its bucket only, and comes back there.
    assert table.merge(frame(spark, changed[1:]), as_of=at(3), **OPTIONS) == 1
    assert [r.id for r in table.read().filter("NOT is_active").collect()] == [0]
    assert table.merge(frame(spark, changed), as_of=at(4), **OPTIONS) == 1 and table.active_rows() == 200


def test_a_failed_audit_leaves_the_table_as_it_is(spark, table):
    table.merge(frame(spark, [(1, "a", "x")]), as_of=at(0), **OPTIONS)
    rules = ("t", [Rule("named", "missing_count", ("name",))])
    with pytest.raises(QualityError):
        table.merge(frame(spark, [(1, None, "x")]), as_of=at(1), audit=lambda staged: run_suite(staged, rules), **OPTIONS)
    assert state(table.read()) == [(1, "a", "x", True, at(0))] and table.number() == 0
    assert len(unlisted_folders(table, dt.datetime(2100, 1, 1))) == 1
    with pytest.raises(Exception, match="several rows of one key"):
        table.merge(frame(spark, [(1, "a", "x"), (1, "b", "x")]), as_of=at(1), **OPTIONS)


def test_expired_versions_leave_shared_folders(spark, table):
    assert table.read() is None and table.active_rows() == 0
    for day in range(4):
        table.merge(frame(spark, [(i, f"n{i}" if i else f"day {day}", "x") for i in range(50)]), as_of=at(day), **OPTIONS)
    now = dt.datetime(2100, 1, 1)
    assert maintain(table, now, keep=1) == {"packed": 0, "expired": 3, "removed": 2}
    rows = state(table.read())
    assert len(rows) == 50 and rows[0][1] == "day 3"
    assert maintain(table, now, keep=1)["removed"] == 0


def test_the_number_of_buckets_is_that_of_the_first_version(spark, table):
    table.merge(frame(spark, [(i, "a", "x") for i in range(30)]), as_of=at(0), **OPTIONS)
    other = BucketedTable(spark, table.root, table.schema, ("id",), 3)
    assert other.merge(frame(spark, [(i, "a", "x") for i in range(30)]), as_of=at(1), **OPTIONS) == 0
    assert isinstance(other.log().first().published_at, dt.datetime) and other.manifest().filter(F.col("buckets") != 8).count() == 0
    assert VersionedTable(spark, f"{table.root}-none").live_folders() == set()


def test_a_batch_is_folded_into_its_buckets_only(spark, base):
    schema = spark.createDataFrame([], "id long, v int").schema
    own = BucketedTable(spark, f"{base}/f", schema, ("id",), 8, active=None, stamped=None)

    def latest(current, batch):
        return latest_per_key(batch if current is None else current.unionByName(batch), ["id"], "v", ["id"])

    def batch(*rows):
        return spark.createDataFrame(rows, schema)

    first = [(i, i % 5) for i in range(100)] + [(None, 3)]
    assert own.fold(batch(*first, (4, 9), (None, 1)), latest, as_of=at(0), number=0) == 8
    assert own.fold(batch(), latest, as_of=at(1), number=1) == 0 and own.number() == 0
    before = set(own.read().inputFiles())
    assert own.fold(batch((7, 8), (7, 1)), latest, as_of=at(1), number=2) == 1
    after = set(own.read().inputFiles())
    assert len(before & after) == 7 and own.last_batch() == 2
    want = sorted({**dict(first[:-1]), 4: 9, 7: 8}.items())
    assert state(own.read().filter("id IS NOT NULL")) == want and own.read().filter("id IS NULL").first().v == 3
    # A batch that comes again is passed over, also after a merge in between.
    own.merge(batch((8, 6)), update=["v"], as_of=at(2))
    number = own.number()
    assert own.fold(batch((7, 9)), latest, as_of=at(3), number=2) == 0 and own.number() == number
    assert own.fold(batch((7, 0)), latest, as_of=at(3), number=3) == 1
    assert state(own.read().filter("id IN (7, 8)")) == [(7, 8), (8, 6)]


def test_a_bucket_may_lose_its_last_row(spark, base):
    schema = spark.createDataFrame([], "id long, v int").schema
    own = BucketedTable(spark, f"{base}/f", schema, ("id",), 2, active=None, stamped=None)
    rows = spark.createDataFrame([(i, 0) for i in range(10)], schema)
    own.fold(rows, lambda current, new: new, as_of=at(0))
    own.fold(rows, lambda current, new: current.limit(0), as_of=at(1))
    assert own.read().collect() == [] and own.number() == 1
    own.fold(rows.filter("id = 3"), lambda current, new: new if current is None else current.unionByName(new), as_of=at(2))
    assert state(own.read()) == [(3, 0)]
