"""The star schema: four dimensions and two facts, from staged match documents."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pavilion.functions.cricket import EXTRAS_ID, EXTRAS_NAME
from pavilion.operators import shred
from pavilion.operators.joins import left_join_spread
from pavilion.operators.ordinals import dense_ids
from pavilion.session import materialize


@dataclass
class Star:
    matches: DataFrame
    teams: DataFrame
    players: DataFrame
    dates: DataFrame
    team_players: DataFrame
    deliveries: DataFrame


def with_extras(players: DataFrame) -> DataFrame:
    """players plus the fixed member that stands for the extras."""
    extras = players.sparkSession.range(1)
    return players.unionAll(extras.select(F.lit(EXTRAS_ID).cast("long"), F.lit(EXTRAS_NAME)))


def player_dim(squads: DataFrame) -> DataFrame:
    return with_extras(dense_ids(squads, "player_name", "player_id"))


def team_dim(squads: DataFrame) -> DataFrame:
    return dense_ids(squads, "team", "team_id")


def match_dim(staging: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """Names become ids by role. The dims are joined by whatever way their size allows; matches without a winner or a best
    player may be most, so a missing name is spread by match.
    """
    rows = shred.match_facts(staging)
    roles = {
        "toss_winner": "toss_winner_id",
        "outright_winner": "outright_id",
        "eliminator_winner": "eliminator_id",
        "first_bat": "first_bat_id",
        "first_field": "first_field_id",
    }
    # No name starts so.
    nobody = F.concat(F.lit("\0"), F.col("match_id").cast("string"))
    for role, key in roles.items():
        rows = left_join_spread(rows, teams.select(F.col("team").alias(role), F.col("team_id").alias(key)), role, nobody)
    best = players.select(F.col("player_name").alias("player_of_match"), F.col("player_id").alias("player_of_match_id"))
    rows = left_join_spread(rows, best, "player_of_match", nobody)
    return rows.withColumn("match_winner_id", F.coalesce("outright_id", "eliminator_id")).select(
        "match_id", "match_date", "match_gender", "season", "event_name", "event_group", "event_match_number",
        "city", "venue", "team_type", "match_type", "match_result", "match_won_by_runs", "match_won_by_wickets",
        "match_won_by_innings", "match_result_method", "umpires", "match_winner_id", "toss_winner_id",
        "toss_decision", "player_of_match_id", "first_bat_id", "first_field_id",
    )


def date_dim(matches: DataFrame) -> DataFrame:
    """A row per day of every year in which, or between which, there were matches."""
    played = F.year("match_date")
    years = matches.agg(F.make_date(F.min(played), F.lit(1), F.lit(1)).alias("a"), F.make_date(F.max(played), F.lit(12), F.lit(31)).alias("b"))
    return years.selectExpr("explode(sequence(a, b, interval 1 day)) as date").selectExpr(
        "date", "extract(year from date) as year", "concat('Q', extract(quarter from date)) as quarter",
        "extract(month from date) as month_number", "date_format(date, 'MMM') as month",
    )


SQUAD_MATCH_COLUMNS = [
    "match_date", "match_winner_id", "toss_winner_id", "player_of_match_id", "first_bat_id", "first_field_id",
]


def team_players_fact(squads, teams, players, matches) -> DataFrame:
    rows = squads.join(teams, "team").join(players, "player_name")
    rows = rows.join(matches.select("match_id", *SQUAD_MATCH_COLUMNS), "match_id")
    return rows.select("match_id", "team_id", "player_id", *SQUAD_MATCH_COLUMNS)


def opponents(team_players: DataFrame) -> DataFrame:
    """(match, team, the other team): of a match's least and greatest team id the one that is not the team's own."""
    ends = team_players.groupBy("match_id").agg(F.min("team_id").alias("least"), F.max("team_id").alias("greatest"))
    own = ends.select("match_id", "least", "greatest", F.explode(F.array_distinct(F.array("least", "greatest"))).alias("team_id"))
    other = F.col("least") + F.col("greatest") - F.col("team_id")
    return own.select("match_id", "team_id", F.when(F.col("least") != F.col("greatest"), other).alias("next_team_id"))


NAMES = ["batter", "non_striker", "bowler", "player_out", "fielder"]


def ball_rows(staging: DataFrame) -> DataFrame:
    """One narrow row per ball, with teams and players by name. The documents are parsed here, where they are read, and nowhere else."""
    innings = shred.explode_innings(staging, ["match_id"]).withColumn("team", F.col("inn.team"))
    return shred.explode_deliveries(innings, ["match_id", "innings", "team"])


def deliveries_fact(balls, teams, players, matches, team_players) -> DataFrame:
    """Stored ball_rows with ids in place of names.

    All lookups happen per match, not per ball: a match's date, the ids of its teams, and those of the names in its balls are
    gathered into one small row, which meets the balls once.
    """
    def as_map(key, value):
        return F.map_from_entries(F.collect_list(F.struct(key, value)))

    sides = opponents(team_players).join(teams, "team_id").groupBy("match_id")
    sides = sides.agg(as_map(F.col("team"), F.struct("team_id", "next_team_id")).alias("sides"))
    names = balls.select("match_id", F.explode(F.array(*NAMES)).alias("player_name")).distinct()
    ids = names.join(players, "player_name").groupBy("match_id").agg(as_map(F.col("player_name"), F.col("player_id")).alias("ids"))
    context = matches.select("match_id", "match_date").join(sides, "match_id").join(ids, "match_id", "left")

    # A table of the matches of a part is small; balls need not be sorted to meet it.
    rows = balls.join(context.hint("shuffle_hash"), "match_id").withColumn("side", F.try_element_at("sides", F.col("team"))).filter("side is not null")
    player = {name: F.try_element_at("ids", F.col(name)).alias(f"{name}_id") for name in NAMES}
    return rows.select(
        "match_id",
        "match_date",
        F.col("side.team_id").alias("batting_team_id"),
        F.col("side.next_team_id").alias("bowling_team_id"),
        "innings", "overs", "balls",
        player["batter"], player["non_striker"], player["bowler"],
        "byes", "leg_byes", "no_balls", "wides", "batter_runs", "total_runs", "wicket_kind",
        player["player_out"], player["fielder"],
    )


def store_name_dim(squads: DataFrame, name: str) -> DataFrame:
    return materialize(player_dim(squads) if name == "t_dim_player" else team_dim(squads), name)


def build_star(staging: DataFrame, store=materialize, store_names=store_name_dim) -> Star:
    """Builds all six tables; each is stored, then read back by the ones that need its keys.

    store(df, name) and store_names(squads, name) say where to; the second is apart so that
    a lasting store can keep the ids it has given out (plans/load.py).
    """
    squads = materialize(shred.squads(staging), "squads")
    players = store_names(squads, "t_dim_player")
    teams = store_names(squads, "t_dim_team")
    matches = store(match_dim(staging, teams, players), "t_dim_match")
    dates = store(date_dim(matches), "t_dim_date")
    team_players = store(team_players_fact(squads, teams, players, matches), "t_fact_team_players")
    # Stored as narrow rows: the names are looked up before the balls are read again.
    balls = materialize(ball_rows(staging), "balls")
    deliveries = store(deliveries_fact(balls, teams, players, matches, team_players), "t_fact_deliveries")
    return Star(matches, teams, players, dates, team_players, deliveries)
