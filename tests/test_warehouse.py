"""The whole model graph from raw fixture tables."""

import uuid

from pyspark.sql import functions as F

from conftest import rows
from tidewater.plans import marts, warehouse
from tidewater.session import scratch_path


def _raw(spark):
    none = lambda ty: F.lit(None).cast(ty)
    tgl = spark.createDataFrame(
        [("g1", "BOS", 1, "W"), ("g1", "NYK", 2, "L"), ("g2", "BOS", 1, "L"), ("g2", "NYK", 2, "W"),
         ("g3", "LAL", 3, "W"), ("g3", "XXX", 9, "L")],
        "game_id string, team_abbreviation string, team_id bigint, wl string")
    for c in ("game_date", "season", "season_label", "season_type", "team_name", "matchup"):
        tgl = tgl.withColumn(c, none("string"))
    for c in ("min", "pts", "reb", "ast", "stl", "blk", "tov", "plus_minus"):
        tgl = tgl.withColumn(c, none("double"))
    pgl = spark.createDataFrame([("g1", 7, "Ann", "BOS", "2026", 20.0, 8.0, 16.0)],
                                "game_id string, player_id bigint, player_name string, team_abbreviation string, "
                                "season string, pts double, fgm double, fga double")
    for c in marts.PLAYER_MEASURES:
        if c not in pgl.columns:
            pgl = pgl.withColumn(c, none("double"))
    for c in ("game_date", "season_label", "season_type", "team_id", "team_name"):
        pgl = pgl.withColumn(c, none("string"))
    sched = spark.createDataFrame([("g1", "d1", 1, "s", 1, 2, "Garden", "2026", "RS")],
                                  "game_id string, game_date_est string, game_status_id int, game_status_text string, "
                                  "home_team_id bigint, visitor_team_id bigint, arena_name string, season string, "
                                  "season_type string")
    box = sched.drop("arena_name").filter("false")
    return {"team_game_logs": tgl, "player_game_logs": pgl, "schedule": sched, "box_summaries": box}


def test_build_wires_all_available_models(spark):
    m = warehouse.build(_raw(spark))
    assert {"stg_games", "stg_player_totals", "dim_teams", "dim_games", "fact_standings",
            "fact_player_per_game"} <= set(m)
    assert "dim_players" not in m            # its sources were not given
    st = {r["team"]: (r["conference"], r["conf_rank"], r["wins"], r["losses"]) for r in m["fact_standings"].collect()}
    assert st == {"BOS": ("East", 1, 1, 1), "NYK": ("East", 2, 1, 1), "LAL": ("West", 1, 1, 0)}
    pg = m["fact_player_per_game"].collect()[0]
    assert (pg["g"], pg["pts"], pg["fg_pct"]) == (1, 20.0, 0.5)
    assert rows(m["dim_games"].select("game_id", "arena_name")) == [("g1", "Garden")]
    assert rows(marts.unmapped_teams(m["stg_games"])) == [("XXX", 1)]


def test_materialize_marts(spark):
    m = warehouse.build(_raw(spark))
    base = scratch_path(spark, f"tests/warehouse-{uuid.uuid4().hex[:8]}")
    done = warehouse.materialize(m, base)
    assert set(done) == {"dim_teams", "dim_games", "fact_standings", "fact_player_per_game"}
    assert spark.read.parquet(f"{base}/fact_standings").count() == 3
