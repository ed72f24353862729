"""The warehouse's model graph (staging -> intermediate -> marts) in one call.

``build(raw)`` takes the raw source tables by name and returns every model as
a lazy DataFrame, wired the way the transform project wires them; nothing runs
until a model is written or collected.  ``materialize`` persists the marts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidewater.operators.writers import replace_table
from tidewater.plans import marts

MARTS = ("dim_teams", "dim_players", "dim_games", "fact_standings", "fact_player_per_game")


def build(raw: Mapping[str, DataFrame], conference: DataFrame | Mapping[str, str] | None = None,
          standings_keys: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Every model whose sources are present in ``raw`` (missing sources skip
    the models that need them)."""
    m: dict[str, DataFrame] = {}
    staging = {
        "stg_games": ("team_game_logs", marts.stg_games),
        "stg_player_totals": ("player_game_logs", marts.stg_player_totals),
        "stg_players": ("common_all_players", marts.stg_players),
        "stg_player_info": ("player_info", marts.stg_player_info),
        "stg_roster": ("team_rosters", marts.stg_roster),
        "stg_schedule": ("schedule", marts.stg_schedule),
        "stg_box_summaries": ("box_summaries", marts.stg_box_summaries),
    }
    for name, (source, fn) in staging.items():
        if source in raw:
            m[name] = fn(raw[source])
    if "team_game_logs" in raw:
        m["int_teams"] = marts.dim_teams(raw["team_game_logs"])
        m["dim_teams"] = m["int_teams"]
    if "stg_players" in m and "stg_player_info" in m:
        m["int_player_dim"] = marts.dim_players(m["stg_players"], m["stg_player_info"])
        m["dim_players"] = m["int_player_dim"]
    if "stg_schedule" in m and "stg_box_summaries" in m:
        m["int_game_schedule"] = marts.dim_games(m["stg_schedule"], m["stg_box_summaries"])
        m["dim_games"] = m["int_game_schedule"]
    if "stg_games" in m:
        m["fact_standings"] = marts.fact_standings(m["stg_games"], conference, partition_keys=standings_keys)
    if "stg_player_totals" in m:
        m["fact_player_per_game"] = marts.fact_player_per_game(m["stg_player_totals"])
    return m


def materialize(models: Mapping[str, DataFrame], base: str, names=MARTS) -> list[str]:
    """Write the marts as parquet tables under ``base/<name>`` (staging swap)."""
    done = []
    for name in names:
        if name in models:
            replace_table(models[name], f"{base.rstrip('/')}/{name}")
            done.append(name)
    return done
