"""Staging projections and the warehouse marts as lazy DataFrame operators.

Each function takes DataFrames and returns a DataFrame; nothing is sorted
inside (ordering is a presentation concern, apply it at the edge), nothing is
collected, and every shuffle is keyed on the grain of the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.exprs import null_as_zero, ratio, round_half_away, to_cents
from tidewater.operators import reshape
from tidewater.operators.joins import join_small_literal, literal_frame, merge_prefer

# --------------------------------------------------------------------------
# staging (P1-P7): renames, null-key filters, text defaults
# --------------------------------------------------------------------------


def _project(df: DataFrame, mapping: Sequence[tuple[str, str | Column]]) -> DataFrame:
    cols = []
    for out, src in mapping:
        c = F.col(src) if isinstance(src, str) else src
        cols.append(c.alias(out))
    return df.select(*cols)


def _text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stg_games(team_game_logs: DataFrame) -> DataFrame:
    m = [("game_id", "game_id"), ("game_date", "game_date"), ("season", "season"),
         ("season_label", "season_label"), ("season_type", "season_type"), ("team_id", "team_id"),
         ("team", "team_abbreviation"), ("team_name", "team_name"), ("matchup", "matchup"),
         ("wl", "wl")] + [(c, c) for c in ("min", "pts", "reb", "ast", "stl", "blk", "tov", "plus_minus")]
    return _project(team_game_logs.filter(F.col("game_id").isNotNull()), m)


# The player game log's measure columns.
PLAYER_MEASURES = ("min", "pts", "reb", "ast", "stl", "blk", "tov", "fgm", "fga", "fg_pct",
                   "fg3m", "fg3a", "fg3_pct", "ftm", "fta", "ft_pct", "oreb", "dreb", "pf")


def stg_player_totals(player_game_logs: DataFrame) -> DataFrame:
    m = [("game_id", "game_id"), ("game_date", "game_date"), ("season", "season"),
         ("season_label", "season_label"), ("season_type", "season_type"), ("player_id", "player_id"),
         ("player", "player_name"), ("team_id", "team_id"), ("team", "team_abbreviation"),
         ("team_name", "team_name")] + [(c, c) for c in PLAYER_MEASURES]
    keep = F.col("game_id").isNotNull() & F.col("player_id").isNotNull()
    return _project(player_game_logs.filter(keep), m)


def stg_players(common_all_players: DataFrame) -> DataFrame:
    m = [("player_id", "person_id"), ("player_name", "display_first_last"),
         ("player_name_sort", "display_last_comma_first"), ("team_id", _text_or_empty("team_id")),
         ("team_abbrev", _text_or_empty("team_abbreviation")), ("team_city", "team_city"),
         ("team_name", "team_name"), ("from_year", "from_year"), ("to_year", "to_year"),
         ("rosterstatus", "rosterstatus"), ("season", "season"), ("season_label", "season_label")]
    return _project(common_all_players.filter(F.col("person_id").isNotNull()), m)


def stg_player_info(player_info: DataFrame) -> DataFrame:
    m = [("player_id", "person_id"), ("player_name", "display_first_last"), ("first_name", "first_name"),
         ("last_name", "last_name"), ("birthdate", "birthdate"), ("college", "school"),
         ("country", "country"), ("height", "height"), ("weight", "weight"), ("position", "position"),
         ("jersey", "jersey"), ("draft_year", _text_or_empty("draft_year")),
         ("draft_round", _text_or_empty("draft_round")), ("draft_pick", _text_or_empty("draft_number")),
         ("season", "season")]
    return _project(player_info.filter(F.col("person_id").isNotNull()), m)


def stg_roster(team_rosters: DataFrame) -> DataFrame:
    m = [("jersey_no", "num"), ("player", "player"), ("pos", "position"), ("height", "height"),
         ("weight", "weight"), ("birth_date", "birth_date"), ("experience", "exp"),
         ("college", "school"), ("team_id", "team_id"), ("team_abbrev", "team_abbreviation"),
         ("season", "season"), ("season_label", "season_label")]
    return _project(team_rosters.filter(F.col("player").isNotNull()), m)


# The game dimension's columns.
_GAME_COLS = ("game_id", "game_date", "game_status_id", "game_status_text", "home_team_id",
              "visitor_team_id", "arena_name", "season", "season_type")


def _game_columns(arena: Column) -> list:
    """The game dimension's columns with their sources, by name."""
    sources = {"game_date": "game_date_est", "arena_name": arena}
    return [(c, sources.get(c, c)) for c in _GAME_COLS]


def stg_schedule(schedule: DataFrame) -> DataFrame:
    m = _game_columns(F.coalesce(F.col("arena_name"), F.lit("")))
    return _project(schedule.filter(F.col("game_id").isNotNull()), m)


def stg_box_summaries(box_summaries: DataFrame) -> DataFrame:
    """Box summaries carry no arena: the column is the constant ``''``."""
    m = _game_columns(F.lit(""))
    return _project(box_summaries.filter(F.col("game_id").isNotNull()), m)


# --------------------------------------------------------------------------
# D1 teams
# --------------------------------------------------------------------------


def dim_teams(team_game_logs: DataFrame, key: str = "team_id",
              attrs: Sequence[str] = ("team_abbreviation", "team_name")) -> DataFrame:
    """One row per team id; attributes are any non-null value, default ``''``.

    ``any_value`` is a partial aggregate, so a hot team id is combined
    map-side before the shuffle.
    """
    agg = (team_game_logs.filter(F.col(key).isNotNull())
           .groupBy(key)
           .agg(*[F.any_value(F.col(a), True).alias(a) for a in attrs]))
    return agg.select(key, *[F.coalesce(F.col(a), F.lit("")).alias(a) for a in attrs])


# --------------------------------------------------------------------------
# D2 players
# --------------------------------------------------------------------------

# The player dimension's columns, and those taken from the bio.
PLAYER_DIM_COLUMNS = ("player_id", "player_name", "player_name_sort", "team", "team_city", "team_name",
                      "from_year", "to_year", "rosterstatus", "season", "season_label", "first_name",
                      "last_name", "birthdate", "college", "country", "height", "weight", "position",
                      "jersey", "draft_year", "draft_round", "draft_pick")
_INFO_COLS = ("first_name", "last_name", "birthdate", "college", "country", "height", "weight",
              "position", "jersey", "draft_year", "draft_round", "draft_pick")


def dim_players(players: DataFrame, info: DataFrame, keys: Sequence[str] = ("player_id", "season")) -> DataFrame:
    """Roster snapshot left-joined to bio on (player, season)."""
    info_cols = [c for c in _INFO_COLS if c in info.columns]
    right = info.select(*keys, *info_cols)
    joined = players.join(right, on=list(keys), how="left")
    out = []
    for c in PLAYER_DIM_COLUMNS:
        if c == "team":
            out.append(F.coalesce(F.col("team_abbrev"), F.lit("")).alias("team"))
        elif c in joined.columns:
            out.append(F.col(c))
    return joined.select(*out)


# --------------------------------------------------------------------------
# D3 games
# --------------------------------------------------------------------------


def dim_games(schedule: DataFrame, box: DataFrame, key: str = "game_id",
              empty_as_null: bool = False) -> DataFrame:
    """Schedule and box summaries merged on game id, box values preferred.

    By default ``''`` from the box side shadows the schedule arena (warehouse
    behaviour); ``empty_as_null=True`` lets the schedule arena through.
    """
    b = box
    if empty_as_null and "arena_name" in b.columns:
        b = b.withColumn("arena_name", F.nullif(F.col("arena_name"), F.lit("")))
    cols = [c for c in _GAME_COLS if c != key]
    merged = merge_prefer(schedule, b, key=key, columns=cols, prefer="right")
    merged = merged.withColumn("arena_name", F.coalesce(F.col("arena_name"), F.lit("")))
    return merged.filter(F.col(key).isNotNull()).select(key, *cols)


# --------------------------------------------------------------------------
# D4 standings
# --------------------------------------------------------------------------

# The 30-team conference map used by the warehouse standings.
CONFERENCE_MAP = {
    "ATL": "East", "BOS": "East", "BRK": "East", "CHO": "East", "CHI": "East",
    "CLE": "East", "DET": "East", "IND": "East", "MIA": "East", "MIL": "East",
    "NYK": "East", "ORL": "East", "PHI": "East", "TOR": "East", "WAS": "East",
    "DAL": "West", "DEN": "West", "GSW": "West", "HOU": "West", "LAC": "West",
    "LAL": "West", "MEM": "West", "MIN": "West", "NOP": "West", "OKC": "West",
    "PHO": "West", "POR": "West", "SAC": "West", "SAS": "West", "UTA": "West",
}


_NULL_KEY = "\u0000"  # stands for a NULL group value inside the rank joins


def win_loss_counts(games: DataFrame, team: str = "team", result: str = "wl",
                    partition_keys: Sequence[str] = ()) -> DataFrame:
    """Wins and losses per team (partial aggregation: hot teams combine map-side)."""
    keep = games.filter(F.col(result).isin("W", "L"))
    up = F.upper(F.col(result))
    return keep.groupBy(*partition_keys, team).agg(
        F.count_if(up == "W").cast("bigint").alias("wins"),
        F.count_if(up == "L").cast("bigint").alias("losses"),
    )


def fact_standings(games: DataFrame, conference: DataFrame | Mapping[str, str] | None = None,
                   team: str = "team", result: str = "wl", partition_keys: Sequence[str] = (),
                   spark: SparkSession | None = None, how: str = "inner", rank: str = "histogram") -> DataFrame:
    """Standings: wins, losses, pct, rank within conference and games behind.

    Rank order is wins desc, losses asc, then the team key (a total order,
    so ties are deterministic).  The rank is computed in two levels so that
    no task ever sorts a whole conference:

    1. a histogram of records ``(group, wins, losses) -> n`` (small: bounded
       by distinct records, not by teams) gives, through a running sum, the
       count of teams with a strictly better record and the leader's record;
    2. teams sharing a record are numbered by team key inside that record.

    ``rank='range'`` instead numbers all teams of a group with
    ``reshape.row_number_within`` (range-partitioned, checkpointed): no task
    holds even a tie shared by a third of all teams, at the price of a
    sampling job and a checkpoint.

    ``conference`` is a dict (a literal map, broadcast) or a DataFrame
    ``(team, conference)`` joined by key (Catalyst/AQE choose the strategy
    from its measured size).  ``how='left'`` keeps unmapped teams with a
    null conference instead of dropping them.
    """
    wl = win_loss_counts(games, team, result, partition_keys)
    wl = wl.withColumn("w_l_pct", ratio("wins", F.col("wins") + F.col("losses"), 3))
    if conference is None:
        conference = CONFERENCE_MAP
    if isinstance(conference, Mapping):
        spark = spark or games.sparkSession
        ranked_in = join_small_literal(wl, spark, conference, key=team, value="conference",
                                       key_type=dict(wl.dtypes)[team], how=how)
    else:
        ranked_in = wl.join(conference.select(team, "conference"), on=team, how=how)

    # Ranking keys: string group columns have NULL replaced by a sentinel so
    # that every join below is a plain equi-join on (group, wins, losses); the
    # tie-rank window then reuses that join's hash partitioning.
    group = [*partition_keys, "conference"]
    types = dict(ranked_in.dtypes)
    kcols = [f"_k_{c}" for c in group]
    keyed = ranked_in.select(*ranked_in.columns, *[
        (F.coalesce(F.col(c), F.lit(_NULL_KEY)) if types[c] == "string" else F.col(c)).alias(k)
        for c, k in zip(group, kcols)])
    null_safe = [k for c, k in zip(group, kcols) if types[c] != "string"]
    gb = (F.col("_leader_wins") - F.col("wins") + F.col("losses") - F.col("_leader_losses")).cast("double") / F.lit(2.0)
    out_cols = [*partition_keys, F.col(team), F.col("conference"), F.col("conf_rank").cast("bigint").alias("conf_rank"),
                "wins", "losses", "w_l_pct", round_half_away(gb, 1).alias("gb")]
    if rank == "range":
        order = [F.col("wins").desc(), F.col("losses").asc(), F.col(team).asc()]
        ranked = reshape.row_number_within(keyed, kcols, order, "conf_rank")
        leaders = ranked.filter(F.col("conf_rank") == 1).select(
            *[F.col(k).alias(f"_l{k}") for k in kcols], F.col("wins").alias("_leader_wins"),
            F.col("losses").alias("_leader_losses"))
        cond = [F.col(k).eqNullSafe(F.col(f"_l{k}")) if k in null_safe else F.col(k) == F.col(f"_l{k}") for k in kcols]
        return ranked.join(leaders, on=cond, how="inner").select(*out_cols)
    if rank != "histogram":
        raise ValueError(f"unknown rank strategy {rank!r}")
    # one exchange on the record serves the histogram, the join back and the tie window
    keyed = keyed.repartition(*kcols, "wins", "losses")
    hist = keyed.groupBy(*kcols, "wins", "losses").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*kcols).orderBy(F.col("wins").desc(), F.col("losses").asc())
    hist = hist.select(
        *kcols, "wins", "losses",
        F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_better"),
        F.first("wins").over(order).alias("_leader_wins"),
        F.first("losses").over(order).alias("_leader_losses"),
    )
    hkeys = [*kcols, "wins", "losses"]
    if null_safe:
        h = hist.select(*[F.col(c).alias(f"_h{c}") for c in hkeys], "_better", "_leader_wins", "_leader_losses")
        cond = [F.col(c).eqNullSafe(F.col(f"_h{c}")) for c in hkeys]
        joined = keyed.join(h, on=cond, how="inner").drop(*[f"_h{c}" for c in hkeys])
    else:
        joined = keyed.join(hist, on=hkeys, how="inner")
    tie = Window.partitionBy(*kcols, "wins", "losses").orderBy(F.col(team).asc())
    return joined.withColumn("conf_rank", F.col("_better") + F.row_number().over(tie)).select(*out_cols)


# --------------------------------------------------------------------------
# D5 per-game averages
# --------------------------------------------------------------------------

# Per-game output name -> source measure (averages per game, 1 digit),
# output name -> (made, attempted) (ratios of totals, 3 digits), and the column order.
PER_GAME_AVERAGES = (
    ("mp", "min"), ("pts", "pts"), ("trb", "reb"), ("ast", "ast"), ("stl", "stl"), ("blk", "blk"),
    ("tov", "tov"), ("fg", "fgm"), ("fga", "fga"), ("3p", "fg3m"), ("3pa", "fg3a"), ("ft", "ftm"),
    ("fta", "fta"), ("orb", "oreb"), ("drb", "dreb"), ("pf", "pf"),
)
PER_GAME_RATIOS = (("fg_pct", ("fgm", "fga")), ("3p_pct", ("fg3m", "fg3a")), ("ft_pct", ("ftm", "fta")))
PER_GAME_ORDER = ("g", "mp", "pts", "trb", "ast", "stl", "blk", "tov", "fg", "fga", "fg_pct", "3p", "3pa",
                  "3p_pct", "ft", "fta", "ft_pct", "orb", "drb", "pf")


def fact_player_per_game(totals: DataFrame, keys: Sequence[str] = ("player_id", "player", "team", "season"),
                         game: str = "game_id",
                         averages: Sequence[tuple[str, str]] = PER_GAME_AVERAGES,
                         ratios: Sequence[tuple[str, tuple[str, str]]] = PER_GAME_RATIOS,
                         cents: Sequence[str] = (), avg_digits: int = 1, ratio_digits: int = 3,
                         output_order: Sequence[str] | None = PER_GAME_ORDER, distinct: str = "inline") -> DataFrame:
    """Per-game averages and shooting ratios per ``keys``.

    ``distinct='inline'`` (default): one scan, aggregated to (keys, game) and then
    to keys, so a hot key is split across tasks by game.  ``distinct='split'``
    reads the facts twice: sums go straight to ``keys``, games are counted from
    a narrow ``(keys, game)`` projection, and the results are joined; it shuffles
    fewer bytes where measures are wide and games have many rows.  Measures named
    in ``cents`` are two-decimal values summed exactly as integer cents.
    """
    measures = list(dict.fromkeys([m for _, m in averages] + [x for _, (n, d) in ratios for x in (n, d)]))
    sums = []
    for m in measures:
        if m in cents:
            sums.append(F.sum(F.coalesce(to_cents(m), F.lit(0))).alias(f"_{m}_tot"))
        else:
            sums.append(F.sum(null_as_zero(m)).alias(f"_{m}_tot"))
    if distinct == "inline":
        agg = totals.groupBy(*keys).agg(F.count_distinct(F.col(game)).cast("bigint").alias("g"), *sums)
    elif distinct == "split":
        summed = totals.groupBy(*keys).agg(*sums)
        games = (totals.select(*keys, game).filter(F.col(game).isNotNull()).distinct()
                 .groupBy(*keys).agg(F.count(F.lit(1)).alias("_g")))
        games = games.select(*[F.col(k).alias(f"_gk_{k}") for k in keys], "_g")
        cond = [F.col(k).eqNullSafe(F.col(f"_gk_{k}")) for k in keys]
        agg = (summed.join(games, on=cond, how="left")
               .select(*keys, F.coalesce(F.col("_g"), F.lit(0)).cast("bigint").alias("g"),
                       *[F.col(f"_{m}_tot") for m in measures]))
    else:
        raise ValueError(f"unknown distinct strategy {distinct!r}")

    def total(m: str) -> Column:
        t = F.col(f"_{m}_tot").cast("double")
        return t / F.lit(100.0) if m in cents else t

    outs = {"g": F.col("g")}
    for name, m in averages:
        outs[name] = round_half_away(total(m) / F.nullif(F.col("g").cast("double"), F.lit(0.0)), avg_digits)
    for name, (n, d) in ratios:
        outs[name] = round_half_away(total(n) / F.nullif(total(d), F.lit(0.0)), ratio_digits)
    order = list(output_order) if output_order else list(outs)
    return agg.filter(F.col("g") > 0).select(*keys, *[outs[c].alias(c) for c in order if c in outs])


def unmapped_teams(games: DataFrame, conference: DataFrame | Mapping[str, str] | None = None,
                   team: str = "team", spark: SparkSession | None = None) -> DataFrame:
    """Teams with results but no conference (they drop out of the standings'
    inner join): ``(team, games)``."""
    if conference is None:
        conference = CONFERENCE_MAP
    if isinstance(conference, Mapping):
        spark = spark or games.sparkSession
        conference = F.broadcast(literal_frame(spark, conference, team, "conference",
                                               key_type=dict(games.dtypes)[team]))
    played = games.filter(F.col("wl").isin("W", "L")) if "wl" in games.columns else games
    counts = played.groupBy(team).agg(F.count(F.lit(1)).alias("games"))
    return counts.join(conference.select(team), team, "left_anti")
