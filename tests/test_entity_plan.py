"""The entity catalogue from landed files to gold, on a real file system."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stratafold.operators.merge import SourceShrinkError
from stratafold.operators.quality import QualityError
from stratafold.operators.versions import VersionedTable
from stratafold.plans import contracts as c
from stratafold.plans import gold
from stratafold.plans.entity import ingest_snapshot, silver_table, transform_snapshot
from stratafold.sources.files import scan_table
from workload import flows

ROWS = [
    {"id": "abc-001", "name": "First", "brewery_type": "micro", "address_1": "1 Road", "city": "Portland",
     "country": "United States", "longitude": -122.6, "latitude": 45.5, "state": "Oregon"},
    {"id": "abc-002", "name": "Second", "brewery_type": "brewpub", "address_1": "Gasse 1", "city": "Klagenfurt",
     "country": "Austria", "longitude": 14.3, "latitude": 46.6, "state": "Kärnten", "phone": None},
    {"id": None, "name": "Nameless", "brewery_type": "micro", "address_1": "9 Road", "city": "Nowhere",
     "country": "United States", "state": None},
]
D1, D2, D3 = "2026-01-15", "2026-01-16", "2026-01-17"


class Flow:
    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        self.base = f"file://{tmp_path.as_posix()}"
        self.bronze, self.silver, self.bad = (f"{self.base}/{n}" for n in ("bronze", "silver", "bad"))

    def ingest(self, day, rows):
        folder = self.root / "staging" / day
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "page_1.json").write_text(json.dumps(rows), encoding="utf-8")
        return ingest_snapshot(self.spark, f"{self.base}/staging", self.bronze, day, self.when(day))

    def transform(self, day):
        return transform_snapshot(self.spark, self.bronze, self.silver, self.bad, day, self.when(day))

    @staticmethod
    def when(day):
        return dt.datetime.fromisoformat(f"{day} 06:00:00")

    def day(self, day, rows):
        self.ingest(day, rows)
        return self.transform(day)

    def state(self):
        return silver_table(self.spark, self.silver).read()


@pytest.fixture
def flow(spark, tmp_path):
    return Flow(spark, tmp_path)


def test_bronze_holds_the_partition_once(flow, spark):
    for _ in range(2):
        assert flow.ingest(D1, ROWS[:2]) == 2
    flow.ingest(D2, ROWS[:1])
    bronze = scan_table(spark, flow.bronze, c.ENTITY_BRONZE)
    assert sorted((r.id, r.ingestion_date) for r in bronze.collect()) == [("abc-001", D1), ("abc-001", D2), ("abc-002", D1)]
    assert bronze.filter("ingested_at IS NULL OR ingestion_ts IS NULL").count() == 0


def test_duplicate_ids_stop_the_ingest(flow, spark):
    with pytest.raises(QualityError, match="bronze_id_unique_per_partition"):
        flow.ingest(D1, [ROWS[0], ROWS[0]])
    assert scan_table(spark, flow.bronze, c.ENTITY_BRONZE) is None


def test_empty_snapshot_stops_the_ingest(flow):
    with pytest.raises(QualityError, match="bronze_must_not_be_empty"):
        flow.ingest(D1, [])


def test_upsert_and_soft_delete(flow):
    many = [{**ROWS[0], "id": f"x-{i}"} for i in range(8)]
    flow.day(D1, ROWS[:2] + many)
    flow.day(D2, [{**ROWS[0], "name": "Renamed"}] + many)
    rows = {r.id: r for r in flow.state().collect()}
    assert (rows["abc-001"].name, rows["abc-001"].is_active) == ("Renamed", True)
    assert (rows["abc-002"].is_active, rows["abc-002"].state, rows["abc-002"].ingestion_date) == (False, "Karnten", D1)
    assert {k for k, r in rows.items() if r.updated_at == Flow.when(D2)} == {"abc-001", "abc-002"}
    assert flow.state().columns == c.ENTITY_SILVER.names


def test_null_ids_are_quarantined(flow, spark):
    assert flow.day(D1, ROWS)
    bad = spark.read.parquet(flow.bad)
    assert flow.state().count() == 2
    assert [(r.name, r.quarantine_reason, str(r.quarantine_date)) for r in bad.collect()] == [("Nameless", "NULL_ID", D1)]


def test_nothing_to_merge(flow):
    assert flow.transform(D1) is False
    flow.ingest(D1, ROWS[2:])
    assert flow.transform(D1) is False and flow.transform(D2) is False
    assert flow.state() is None


def test_missing_state_gets_the_sentinel(flow):
    flow.day(D1, [{**ROWS[0], "state": None}])
    assert flow.state().first().state == "__UNKNOWN__"


def test_broken_documents_keep_their_text(flow, spark):
    folder = flow.root / "staging" / D1
    folder.mkdir(parents=True)
    (folder / "page_0.json").write_text('[{"id": "lost", ')
    (folder / "page_1.json").write_text(json.dumps(ROWS[:2]))
    for _ in range(2):
        rows = ingest_snapshot(spark, f"{flow.base}/staging", flow.bronze, D1, flow.when(D1), f"{flow.base}/broken")
        assert rows == 2
    assert [(r.document, r.quarantine_reason) for r in spark.read.parquet(f"{flow.base}/broken").collect()] == [('[{"id": "lost", ', "CORRUPT_DOCUMENT")]


def test_pages_may_share_a_file_by_line(flow, spark):
    folder = flow.root / "staging" / D1
    folder.mkdir(parents=True)
    (folder / "pages.json").write_text("\n".join([json.dumps(ROWS[:1]), "[{broken", json.dumps(ROWS[1:])]), encoding="utf-8")
    rows = ingest_snapshot(
        spark, f"{flow.base}/staging", flow.bronze, D1, flow.when(D1), f"{flow.base}/broken", documents=False
    )
    assert rows == 3 and [r.document for r in spark.read.parquet(f"{flow.base}/broken").collect()] == ["[{broken"]
    bronze = scan_table(spark, flow.bronze, c.ENTITY_BRONZE)
    assert {(r.id, r.state) for r in bronze.collect()} == {(r["id"], r["state"]) for r in ROWS}


def test_landed_pages_take_no_file_each(flow, spark):
    rows = spark.range(20 * flows.PAGE_ROWS).select(
        F.col("id").alias("c_custkey"), F.lit(0.0).alias("c_acctbal"), F.col("id").cast("string").alias("id"),
        F.lit("First").alias("name"), F.lit("micro").alias("brewery_type"),
    )
    flows.land_pages(rows, f"{flow.base}/staging/{D1}")
    assert len(list((flow.root / "staging" / D1).glob("part-*"))) <= 4
    read = ingest_snapshot(spark, f"{flow.base}/staging", flow.bronze, D1, flow.when(D1), documents=False)
    ids = {r.id for r in scan_table(spark, flow.bronze, c.ENTITY_BRONZE).collect()}
    assert read == len(ids) == 20 * flows.PAGE_ROWS and str(20 * flows.PAGE_ROWS - 1) in ids


def test_an_empty_state_is_kept(flow):
    assert flow.day(D1, [{**ROWS[0], "state": ""}])
    assert flow.state().first().state == ""


def test_shrunken_snapshot_is_refused(flow):
    flow.day(D1, [{**ROWS[0], "id": f"bulk-{i:03d}"} for i in range(100)])
    flow.ingest(D2, ROWS[:1])
    with pytest.raises(SourceShrinkError):
        flow.transform(D2)
    assert flow.state().filter("is_active").count() == 100


def test_gold_and_history(flow, spark):
    many = [{**ROWS[0], "id": f"x-{i}"} for i in range(8)]
    days = [(D1, ROWS[:2] + many), (D2, [{**ROWS[0], "brewery_type": "bar"}] + many)]
    for day, rows in days:
        flow.day(day, rows)
        built = gold.build_gold(spark, flow.state(), f"{flow.base}/gold", Flow.when(day))
        history = gold.snapshot_history(spark, flow.state(), f"{flow.base}/history", Flow.when(day))
    mart = {r.city: r for r in built["mart"].collect()}
    assert (mart["Portland"].active_breweries_count, mart["Klagenfurt"].inactive_breweries_count) == (9, 1)
    assert built["fact"].count() == 10
    assert {r.brewery_type: r.brewery_type_description for r in built["dim_types"].collect()}["bar"].startswith("A bar")
    versions = sorted(
        (r.id, r.brewery_type, r.is_active, str(r.valid_from.date()), r.valid_to and str(r.valid_to.date()))
        for r in history.filter("id LIKE 'abc%'").collect()
    )
    assert versions == [
        ("abc-001", "bar", True, D2, None), ("abc-001", "micro", True, D1, D2),
        ("abc-002", "brewpub", False, D2, None), ("abc-002", "brewpub", True, D1, D2),
    ]
    # A repeated run finds nothing new.
    assert gold.snapshot_history(spark, flow.state(), f"{flow.base}/history", Flow.when(D3)).count() == history.count()


def test_failed_gold_check_blocks_what_follows(flow, spark):
    flow.day(D1, [{**ROWS[0], "city": None}])
    with pytest.raises(QualityError, match="stg_city_not_null"):
        gold.build_gold(spark, flow.state(), f"{flow.base}/gold", Flow.when(D1))
    assert VersionedTable(spark, f"{flow.base}/gold/mart").read() is None
