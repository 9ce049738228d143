"""Field names and types of the two feeds and their tables.

Fixed values: these are the data contracts of the landed files and of the
tables built from them.
"""

from __future__ import annotations

import csv
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fields(text: str) -> T.StructType:
    schema = T.StructType()
    for part in text.split(","):
        name, kind = part.split()
        schema.add(name, kind)
    return schema


# Entity snapshot as landed.
ENTITY = _fields(
    "id string, name string, brewery_type string, address_1 string, address_2 string, "
    "address_3 string, city string, state_province string, postal_code string, country string, "
    "longitude double, latitude double, phone string, website_url string, state string, street string"
)
ENTITY_BRONZE = T.StructType(
    [*ENTITY.fields, *_fields("ingested_at timestamp, ingestion_ts timestamp, ingestion_date string").fields]
)
ENTITY_ATTRIBUTES = ["name", "brewery_type", "address_1", "city", "state", "country"]
ENTITY_SILVER = _fields(
    "id string, name string, brewery_type string, address_1 string, city string, state string, "
    "country string, is_active boolean, updated_at timestamp, ingestion_date string"
)
ENTITY_QUARANTINED = ["id", *ENTITY_ATTRIBUTES, "ingestion_date", "ingested_at"]

# Match feed as landed.
MATCH = _fields(
    "matchweek integer, home_team string, home_team_code string, away_team string, away_team_code string, "
    "score_home integer, score_away integer, date string, kickoff_time string, stadium string, broadcast string, "
    "match_url string, match_started boolean, source string, ge_match_id string"
)
MATCH_BRONZE = T.StructType(
    [
        *MATCH.fields,
        *_fields("ingested_at timestamp, ingestion_ts timestamp, ingest_batch long, ingestion_date string").fields,
    ]
)
MATCH_SILVER = _fields(
    "ge_match_id string, matchweek integer, match_date date, kickoff_ts timestamp, home_team string, "
    "home_team_code string, away_team string, away_team_code string, score_home integer, score_away integer, "
    "total_goals integer, match_outcome string, stadium string, stadium_state string, "
    "stadium_state_origin string, is_active boolean, updated_at timestamp, ingestion_date string"
)
MATCH_UPDATED = [
    "score_home", "score_away", "total_goals", "match_outcome",
    "stadium", "stadium_state", "stadium_state_origin",
]
MATCH_QUARANTINED = [
    "ge_match_id", "matchweek", "home_team", "away_team", "date", "stadium", "ingestion_date", "ingested_at",
]
MATCH_SOURCE = "ge.globo.com"

# Names of the gold tables' columns.
LOCATION_COLUMNS = ["country", "state", "city"]
COVERAGE_NAMES = {
    "active": "active_breweries_count",
    "inactive": "inactive_breweries_count",
    "total": "total_breweries",
    "ratio": "active_ratio",
    "rank": "city_state_rank",
}


def bundled_table(spark: SparkSession, name: str) -> DataFrame:
    """A two-column table that comes with the package (a few hundred rows at most)."""
    text = (resources.files("stratafold") / "resources" / f"{name}.csv").read_text(encoding="utf-8")
    header, *rows = csv.reader(line for line in text.splitlines() if not line.startswith("#"))
    schema = T.StructType([T.StructField(column, T.StringType()) for column in header])
    return spark.createDataFrame([tuple(row) for row in rows], schema)
