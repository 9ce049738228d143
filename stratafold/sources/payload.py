"""Raw nested match payloads and the slices of a feed that a run lands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields read from one raw match document.
PAYLOAD_DDL = (
    "rodada INT, id STRING, data_realizacao STRING, hora_realizacao STRING, "
    "equipes STRUCT<mandante: STRUCT<nome_popular: STRING, sigla: STRING>, "
    "visitante: STRUCT<nome_popular: STRING, sigla: STRING>>, "
    "placar_oficial_mandante INT, placar_oficial_visitante INT, "
    "sede STRUCT<nome_popular: STRING>, jogo_ja_comecou BOOLEAN, "
    "transmissao STRUCT<url: STRING, broadcast: STRUCT<label: STRING>>"
)

# Fixed value: what a missing team or venue is called.
MISSING_NAME = "Unknown"


def _or(field: str, default) -> Column:
    return F.coalesce(F.col(field), F.lit(default))


def flatten_payload(raw: DataFrame, source: str) -> DataFrame:
    """One flat row per match document; documents without a date are dropped.

    A field that is absent and a field that is null both take the default.
    """
    dated = raw.filter(F.length("data_realizacao") > 0)
    return dated.select(
        F.col("rodada").alias("matchweek"),
        _or("equipes.mandante.nome_popular", MISSING_NAME).alias("home_team"),
        _or("equipes.mandante.sigla", "").alias("home_team_code"),
        _or("equipes.visitante.nome_popular", MISSING_NAME).alias("away_team"),
        _or("equipes.visitante.sigla", "").alias("away_team_code"),
        F.col("placar_oficial_mandante").alias("score_home"),
        F.col("placar_oficial_visitante").alias("score_away"),
        F.substring("data_realizacao", 1, 10).alias("date"),
        _or("hora_realizacao", "").alias("kickoff_time"),
        _or("sede.nome_popular", MISSING_NAME).alias("stadium"),
        _or("transmissao.broadcast.label", "").alias("broadcast"),
        _or("transmissao.url", "").alias("match_url"),
        _or("jogo_ja_comecou", False).alias("match_started"),
        F.lit(source).alias("source"),
        F.col("id").alias("ge_match_id"),
    )


def finished(df: DataFrame, required: Sequence[str] = ("score_home",), started: str = "match_started") -> DataFrame:
    """Rows that have started and carry every required score."""
    condition = F.coalesce(F.col(started), F.lit(False))
    for name in required:
        condition = condition & F.col(name).isNotNull()
    return df.filter(condition)


def landing_slice(df: DataFrame, run_date: str, *, first_run: bool, date_column: str = "date") -> DataFrame:
    """What a run lands: everything up to its date at first, later that date only."""
    day = F.col(date_column)
    return df.filter(day <= run_date) if first_run else df.filter(day == run_date)
