"""The match feed from landed files to its current state."""

import datetime as dt
import json
import shutil
from pathlib import Path

import pytest

from stratafold import workspace
from stratafold.operators.incremental import listed_watermark
from stratafold.operators.ledger import FOLDER, recorded
from stratafold.operators.quality import QualityError
from stratafold.plans import contracts as c
from stratafold.plans import matches
from stratafold.plans.matches import ingest_matches, land_matches, read_matches, rows_per_date, transform_matches
from stratafold.sources.files import scan_table
from stratafold.sources.payload import PAYLOAD_DDL
from stratafold.workspace import shared_root
from tests.conftest import plan_of


def match(number, day, **changes):
    row = {
        "matchweek": 1, "home_team": "Flamengo", "home_team_code": "FLA", "away_team": "Grêmio", "away_team_code": "GRE",
        "score_home": 2, "score_away": 1, "date": day, "kickoff_time": "16:00", "stadium": "Arena do Grêmio",
        "broadcast": "", "match_url": "", "match_started": True, "source": "feed", "ge_match_id": f"m-{number}",
    }
    return {**row, **changes}


class Feed:
    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        base = f"file://{tmp_path.as_posix()}"
        self.staging, self.bronze, self.silver, self.bad, self.marks = (
            f"{base}/{n}" for n in ("staging", "bronze", "silver", "bad", "marks")
        )

    def land(self, day, *rows):
        folder = self.root / "staging" / day
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "matches.json").write_text(json.dumps(list(rows)), encoding="utf-8")

    def ingest(self, hour, **options):
        return ingest_matches(self.spark, self.staging, self.bronze, self.bad, self.at(hour), **options)

    def transform(self, hour, **options):
        return transform_matches(self.spark, self.bronze, self.silver, self.bad, self.marks, self.at(hour), **options)

    @staticmethod
    def at(hour):
        return dt.datetime(2026, 6, 1) + dt.timedelta(hours=hour)

    def state(self):
        return {r.ge_match_id: r for r in read_matches(self.spark, self.silver).collect()}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_nothing_landed(feed):
    assert feed.ingest(0) is False and feed.transform(0) is False


def test_first_load_and_correction(feed, spark):
    feed.land("2026-05-20", match(1, "2026-05-20"), match(2, "2026-05-20", kickoff_time=""))
    feed.land("2026-05-21", match(3, "2026-05-21", stadium="Unknown", home_team="Nobody"))
    assert feed.ingest(0) and feed.transform(1)
    rows = feed.state()
    assert set(rows) == {"m-1", "m-2", "m-3"}
    # Two spellings of one stadium key do not repeat the match.
    assert (rows["m-1"].stadium, rows["m-1"].stadium_state, rows["m-1"].stadium_state_origin) == ("Arena do Gremio", "RS", "STADIUM_LOOKUP")
    assert (rows["m-3"].stadium_state, rows["m-3"].stadium_state_origin) == ("UNKNOWN", "UNKNOWN")
    assert rows["m-2"].kickoff_ts is None and rows["m-1"].total_goals == 3

    # The newest date is replaced in place with a corrected score and another team.
    feed.land("2026-05-21", match(3, "2026-05-21", score_home=0, home_team="Santos", stadium="Unknown"))
    assert feed.ingest(2) and feed.transform(3)
    rows = feed.state()
    assert (rows["m-3"].score_home, rows["m-3"].match_outcome, rows["m-3"].home_team) == (0, "AWAY_WIN", "Nobody")
    assert rows["m-3"].updated_at == feed.at(3) and rows["m-1"].updated_at == feed.at(1)
    bronze = scan_table(spark, feed.bronze, c.MATCH_BRONZE)
    assert {r.ingestion_date: r.rows for r in rows_per_date(bronze).collect()} == {"2026-05-20": 2, "2026-05-21": 1}
    assert feed.transform(4) is False and len(feed.state()) == 3


def test_older_dates_need_a_full_refresh(feed):
    feed.land("2026-05-20", match(1, "2026-05-20"))
    feed.land("2026-05-21", match(2, "2026-05-21"))
    feed.ingest(0), feed.transform(1)
    feed.land("2026-05-20", match(1, "2026-05-20", score_home=9))
    feed.ingest(2), feed.transform(3)
    assert feed.state()["m-1"].score_home == 2
    feed.ingest(4, full_refresh=True), feed.transform(5, full_refresh=True)
    assert feed.state()["m-1"].score_home == 9


def test_rows_landed_during_a_merge_are_not_lost(feed):
    feed.land("2026-05-20", match(1, "2026-05-20"))
    feed.ingest(0)
    feed.land("2026-05-21", match(2, "2026-05-21"))
    feed.transform(5)
    feed.ingest(2)
    assert feed.transform(6) and set(feed.state()) == {"m-1", "m-2"}


def test_null_ids_and_undated_files_are_quarantined(feed, spark):
    feed.land("2026-05-20", match(1, "2026-05-20"), match(2, "2026-05-20", ge_match_id=None))
    feed.land("undated", match(3, "2026-05-20"))
    feed.ingest(0), feed.transform(1)
    assert set(feed.state()) == {"m-1"}
    reasons = [r.quarantine_reason for r in spark.read.parquet(feed.bad).collect()]
    assert sorted(reasons) == ["BAD_PATH_DATE", "NULL_GE_MATCH_ID"]


def test_all_rows_quarantined(feed, spark):
    feed.land("2026-05-20", match(2, "2026-05-20", ge_match_id=None))
    assert feed.ingest(0) and feed.transform(1) is False
    assert read_matches(feed.spark, feed.silver) is None
    assert feed.transform(2) is False and spark.read.parquet(feed.bad).count() == 1


def test_an_idle_run_writes_nothing(feed, spark):
    feed.land("2026-05-20", match(1, "2026-05-20"), match(2, "2026-05-20", ge_match_id=None))
    assert feed.ingest(0) and feed.transform(1)
    before = {p: p.stat().st_mtime_ns for n in ("silver", "bad", "marks") for p in (feed.root / n).rglob("*")}
    for hour in (2, 3):
        assert feed.transform(hour) is False
    assert before == {p: p.stat().st_mtime_ns for n in ("silver", "bad", "marks") for p in (feed.root / n).rglob("*")}


def test_a_run_without_news_opens_no_bronze_file(feed, spark):
    feed.land("2026-05-20", match(1, "2026-05-20"))
    feed.land("2026-05-21", match(2, "2026-05-21"))
    assert feed.ingest(0) and feed.transform(1)
    for part in (feed.root / "bronze").rglob("ingestion_date=*/*.parquet"):
        part.write_bytes(b"not parquet")
        part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    assert feed.transform(2) is False
    # The newest date is taken in again: its files alone are read, the older date's still cannot be.
    assert feed.ingest(3) and feed.transform(4) and set(feed.state()) == {"m-1", "m-2"}


def test_a_table_from_before_its_ledger_gets_one(feed, spark):
    feed.land("2026-05-20", match(1, "2026-05-20"))
    assert feed.ingest(0) and feed.transform(1)
    shutil.rmtree(feed.root / "bronze" / FOLDER)
    assert feed.transform(2) is False
    feed.land("2026-05-21", match(2, "2026-05-21"))
    assert feed.ingest(3) and feed.transform(4) and set(feed.state()) == {"m-1", "m-2"}
    assert sorted((r.batch, r.partition, r.rows) for r in recorded(spark, feed.bronze).collect()) == [
        (1, "2026-05-20", 1), (2, "2026-05-20", 1), (2, "2026-05-21", 1),
    ]


def test_intermediate_tables_go_with_the_run(feed, spark):
    shared = Path(shared_root(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    feed.land("2026-05-20", match(1, "2026-05-20"))
    assert feed.ingest(0) and feed.transform(1)
    feed.land("2026-05-21", match(2, "no date"))
    assert feed.ingest(2)
    with pytest.raises(QualityError):
        feed.transform(3)
    assert set(shared.iterdir()) == before


def test_the_first_merge_copies_nothing_but_its_source(feed, spark, monkeypatch):
    written = []
    fresh = workspace.fresh_path
    monkeypatch.setattr(workspace, "fresh_path", lambda spark, label: written.append(label) or fresh(spark, label))
    feed.land("2026-05-20", match(1, "2026-05-20"), match(2, "2026-06-20"))
    assert feed.ingest(0) and feed.transform(1)
    assert set(written) == {"match-bronze", "lookup", "match-source"}
    rows = feed.state()
    assert {r.is_active for r in rows.values()} == {True} and {r.updated_at for r in rows.values()} == {feed.at(1)}
    assert {r.match_month.isoformat() for r in scan_table(spark, feed.silver).collect()} == {"2026-05-01", "2026-06-01"}

    feed.land("2026-05-21", match(3, "2026-05-21"))
    assert feed.ingest(2) and feed.transform(3) and set(feed.state()) == {"m-1", "m-2", "m-3"}


def test_a_first_merge_that_fails_its_audit_writes_nothing(feed, spark):
    feed.land("2026-05-20", match(1, "no date"))
    assert feed.ingest(0)
    with pytest.raises(QualityError):
        feed.transform(1)
    assert read_matches(spark, feed.silver) is None and scan_table(spark, feed.marks) is None


def test_later_landings_parse_only_their_own_date(feed, spark, tmp_path, monkeypatch):
    feed.land("2026-05-20", match(1, "2026-05-20"))
    (tmp_path / "raw.json").write_text('{"id": "m-1", "data_realizacao": "2026-05-21T16:00", "placar_oficial_mandante": 1, "jogo_ja_comecou": true}')
    landed = []
    monkeypatch.setattr(matches, "land_json_by_date", lambda df, path: landed.append(df))
    land_matches(spark, spark.read.schema(PAYLOAD_DDL).json(f"file://{tmp_path}/raw.json"), feed.staging, "2026-05-21")
    assert "StringStartsWith(data_realizacao,2026-05-21)" in plan_of(landed[0]) and landed[0].count() == 1


def test_the_watermark_comes_from_folder_names(feed, spark):
    for day in ("2026-05-20", "2026-05-21"):
        feed.land(day, match(1, day))
    feed.ingest(0)
    for part in (feed.root / "bronze").rglob("*.parquet"):
        part.write_bytes(b"not parquet")
    assert listed_watermark(spark, feed.bronze, "ingestion_date") == "2026-05-21"
    assert listed_watermark(spark, feed.bronze + "-none", "ingestion_date") is None


def test_landing_first_run_then_increment(feed, spark, tmp_path):
    def doc(number, day, goals):
        return {"rodada": 1, "id": f"m-{number}", "data_realizacao": f"{day}T16:00", "placar_oficial_mandante": goals,
                "placar_oficial_visitante": 0, "jogo_ja_comecou": True}

    def raw(*docs):
        text = "\n".join(json.dumps(d) for d in docs)
        (tmp_path / "raw.json").write_text(text)
        return spark.read.schema(PAYLOAD_DDL).json(f"file://{tmp_path}/raw.json")

    docs = [doc(1, "2026-05-20", 1), doc(2, "2026-05-21", 1), doc(3, "2026-05-30", 1), doc(4, "2026-05-20", None)]
    land_matches(spark, raw(*docs), feed.staging, "2026-05-29")
    assert feed.ingest(0, documents=False) and feed.transform(1)
    assert set(feed.state()) == {"m-1", "m-2"}
    land_matches(spark, raw(*docs, doc(5, "2026-05-20", 1)), feed.staging, "2026-05-30")
    assert feed.ingest(2, documents=False) and feed.transform(3)
    rows = feed.state()
    assert set(rows) == {"m-1", "m-2", "m-3"} and rows["m-3"].match_date == dt.date(2026, 5, 30)
