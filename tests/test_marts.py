"""Marts on inline fixtures (ties, unmapped teams, nulls, zero attempts, merge sources)."""

import random

from pyspark.sql import functions as F

from conftest import rows
from tidewater.plans import marts


def _games(spark, data):
    return spark.createDataFrame(data, "team string, wl string")


def test_standings_ties_nulls_case_and_unmapped(spark):
    data = [("BOS", "W"), ("BOS", "W"), ("BOS", "L"), ("NYK", "L"), ("NYK", "W"), ("NYK", "W"),
            ("PHI", "W"), ("PHI", "L"), ("PHI", "L"), ("PHI", "w"), ("PHI", None),
            ("LAL", "W"), ("LAL", "W"), ("LAL", "W"), ("SAC", "L"), ("XXX", "W")]
    got = rows(marts.fact_standings(_games(spark, data)))
    assert got == sorted([
        ("BOS", "East", 1, 2, 1, 0.667, 0.0), ("NYK", "East", 2, 2, 1, 0.667, 0.0),
        ("PHI", "East", 3, 1, 2, 0.333, 1.0),
        ("LAL", "West", 1, 3, 0, 1.0, 0.0), ("SAC", "West", 2, 0, 1, 0.0, 2.0),
    ])
    left = {r[0]: r for r in rows(marts.fact_standings(_games(spark, data), how="left"))}
    assert left["XXX"][1] is None and left["XXX"][2] == 1


def _brute_standings(data, conf):
    rec = {}
    for team, wl in data:
        if wl in ("W", "L"):
            w, l_ = rec.get(team, (0, 0))
            rec[team] = (w + (wl == "W"), l_ + (wl == "L"))
    out = []
    for c in set(conf.values()):
        teams = sorted([t for t in rec if conf.get(t) == c], key=lambda t: (-rec[t][0], rec[t][1], t))
        lw, ll = rec[teams[0]]
        for i, t in enumerate(teams, 1):
            w, l_ = rec[t]
            pct = None if w + l_ == 0 else w / (w + l_)
            out.append((t, c, i, w, l_, pct, (lw - w + l_ - ll) / 2))
    return out


def test_standings_random_against_brute_force(spark):
    rnd = random.Random(7)
    teams = list(marts.CONFERENCE_MAP)
    data = [(rnd.choice(teams), rnd.choice(["W", "L", "L", "W", "N"])) for _ in range(3000)]
    got = rows(marts.fact_standings(_games(spark, data)))
    want = _brute_standings(data, marts.CONFERENCE_MAP)
    assert len(got) == len(want)
    g = {r[0]: r for r in got}
    for t, c, rank, w, l_, pct, gb in want:
        r = g[t]
        assert r[1:5] == (c, rank, w, l_)
        assert abs(r[5] - round(pct, 3)) < 1e-9 and abs(r[6] - gb) < 1e-9


def test_standings_partition_keys(spark):
    df = spark.createDataFrame([("BOS", "W", "2025"), ("BOS", "L", "2026"), ("NYK", "W", "2026")],
                               "team string, wl string, season string")
    got = rows(marts.fact_standings(df, partition_keys=("season",)))
    assert got == [("2025", "BOS", "East", 1, 1, 0, 1.0, 0.0), ("2026", "BOS", "East", 2, 0, 1, 0.0, 1.0),
                   ("2026", "NYK", "East", 1, 1, 0, 1.0, 0.0)]


def test_per_game_zero_attempts_null_measure_two_teams(spark):
    schema = ", ".join(["game_id string", "player_id bigint", "player string", "team string", "season string"] +
                       [f"{m} double" for m in marts.PLAYER_MEASURES])
    base = dict.fromkeys(marts.PLAYER_MEASURES)
    def row(g, team, **m):
        d = dict(base, **m)
        return (g, 1, "A", team, "2026", *[d[k] for k in marts.PLAYER_MEASURES])
    data = [row("g1", "BOS", pts=10.0, fgm=4.0, fga=8.0, fg3a=0.0),
            row("g2", "BOS", pts=21.0, fgm=3.0, fga=7.0, fg3a=0.0),
            row("g2", "BOS", pts=None),                       # same game twice: counted once
            row("g3", "NYK", pts=5.0, fgm=0.0, fga=0.0)]
    got = {r["team"]: r for r in marts.fact_player_per_game(spark.createDataFrame(data, schema)).collect()}
    bos, nyk = got["BOS"], got["NYK"]
    assert bos["g"] == 2 and bos["pts"] == 15.5 and bos["fg_pct"] == 0.467
    assert bos["3p_pct"] is None                              # zero attempts -> null ratio
    assert bos["ast"] == 0.0                                  # all-null measure sums to 0
    assert nyk["g"] == 1 and nyk["fg_pct"] is None


def test_dim_games_merge_prefers_box_and_shadows_arena(spark):
    cols = "game_id string, game_date_est string, game_status_id int, game_status_text string, " \
           "home_team_id bigint, visitor_team_id bigint, arena_name string, season string, season_type string"
    sched = spark.createDataFrame([("1", "d1", 1, "s", 1, 2, "Garden", "2026", "RS"),
                                   ("2", "d2", 1, "s", 3, 4, None, "2026", "RS"),
                                   (None, "d0", 1, "s", 5, 6, "X", "2026", "RS")], cols)
    box = spark.createDataFrame([("1", "d1b", 3, "final", 1, 2, "2026", "RS"), ("3", "d3", 3, "final", 7, 8, "2026", "RS")],
                                cols.replace("arena_name string, ", ""))
    got = {r["game_id"]: r for r in marts.dim_games(marts.stg_schedule(sched), marts.stg_box_summaries(box)).collect()}
    assert set(got) == {"1", "2", "3"}
    assert got["1"]["game_date"] == "d1b" and got["1"]["arena_name"] == ""      # box '' shadows arena
    assert got["2"]["arena_name"] == ""
    fixed = {r["game_id"]: r for r in marts.dim_games(marts.stg_schedule(sched), marts.stg_box_summaries(box),
                                                       empty_as_null=True).collect()}
    assert fixed["1"]["arena_name"] == "Garden"


def test_dim_teams_any_non_null(spark):
    df = spark.createDataFrame([(1, None, "Boston"), (1, "BOS", None), (2, None, None), (None, "X", "Y")],
                               "team_id bigint, team_abbreviation string, team_name string")
    assert rows(marts.dim_teams(df)) == [(1, "BOS", "Boston"), (2, "", "")]


def test_staging_renames_and_filters(spark):
    logs = spark.createDataFrame(
        [("g1", "2026", "BOS", "W"), (None, "2026", "NYK", "L")],
        "game_id string, season string, team_abbreviation string, wl string")
    for c in ("game_date", "season_label", "season_type", "team_id", "team_name", "matchup", "min", "pts", "reb",
              "ast", "stl", "blk", "tov", "plus_minus"):
        logs = logs.withColumn(c, F.lit(None).cast("string"))
    staged = marts.stg_games(logs)
    assert "team" in staged.columns and rows(staged.select("game_id", "team")) == [("g1", "BOS")]
    roster = spark.createDataFrame([("3", "Ann", "G", "BOS", "2026"), ("4", None, "F", "BOS", "2026")],
                                   "num string, player string, position string, team_abbreviation string, season string")
    for c in ("height", "weight", "birth_date", "exp", "school", "team_id", "season_label"):
        roster = roster.withColumn(c, F.lit(None).cast("string"))
    r = marts.stg_roster(roster).collect()
    assert [(x["jersey_no"], x["player"], x["pos"], x["team_abbrev"]) for x in r] == [("3", "Ann", "G", "BOS")]
    players = spark.createDataFrame([(1, None, None)], "person_id bigint, team_id bigint, team_abbreviation string")
    for c in ("display_first_last", "display_last_comma_first", "team_city", "team_name", "from_year", "to_year",
              "rosterstatus", "season", "season_label"):
        players = players.withColumn(c, F.lit(None).cast("string"))
    p = marts.stg_players(players).collect()[0]
    assert (p["team_id"], p["team_abbrev"]) == ("", "")


def test_standings_rank_strategies_agree(spark):
    rnd = random.Random(21)
    teams = list(marts.CONFERENCE_MAP) + ["XXX"]
    data = [(rnd.choice(teams), rnd.choice(["W", "L"])) for _ in range(2000)]
    for how in ("inner", "left"):
        a = rows(marts.fact_standings(_games(spark, data), how=how))
        b = rows(marts.fact_standings(_games(spark, data), how=how, rank="range"))
        assert a == b
    df = spark.createDataFrame([(t, w, s) for (t, w), s in zip(data, [rnd.choice(["2025", "2026"]) for _ in data])],
                               "team string, wl string, season string")
    assert rows(marts.fact_standings(df, partition_keys=("season",))) == \
        rows(marts.fact_standings(df, partition_keys=("season",), rank="range"))
