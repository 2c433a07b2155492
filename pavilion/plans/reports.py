"""Report datasets over the star: player and team tables, match lists, cards, slicers."""

from pyspark.sql import DataFrame, functions as F

from pavilion.functions.blanks import text
from pavilion.operators.joins import left_join_spread
from pavilion.operators.texts import joined_text
from pavilion.plans.measures import evaluate
from pavilion.plans.selectors import in_team
from pavilion.plans.star import Star

PLAYER_STATS = [
    "matches", "year_span", "bat_innings", "not_outs", "batter_runs", "highest_score", "batting_average",
    "strike_rate", "hundreds", "fifties", "fours", "sixes", "bowl_innings", "wickets", "best_bowl_innings",
    "five_wickets", "bowling_average", "economy", "catches", "player_of_match",
]
TEAM_STATS = ["year_span", "matches", "match_wins", "win_ratio", "seasons", "season_wins"]
KPIS = ["matches", "hundreds", "fifties", "five_wickets", "sixes", "fours"]


def player_stats(star: Star, teams=None, **context) -> DataFrame:
    rows = in_team(star, ["player_id"], PLAYER_STATS, teams, **context)
    named = rows.join(star.players, "player_id").select("player_id", "player_name", *PLAYER_STATS)
    return named.orderBy(F.desc("matches"), "player_id")


def team_stats(star: Star, **context) -> DataFrame:
    rows = evaluate(star, ["team_id"], TEAM_STATS, **context)
    named = rows.join(star.teams, "team_id").select("team_id", "team", *TEAM_STATS)
    return named.orderBy(F.desc("matches"), "team_id")


def kpi_cards(star: Star, **context) -> DataFrame:
    return evaluate(star, [], KPIS, **context)


def wins_by_year(star: Star, **context) -> DataFrame:
    return evaluate(star, ["year"], ["match_wins"], **context).orderBy(F.desc("match_wins"), "year")


def wins_by_month(star: Star, **context) -> DataFrame:
    """By month of the calendar; the name is ordered by its number."""
    rows = evaluate(star, ["month_number", "month"], ["matches", "match_wins"], **context)
    return rows.orderBy("month_number")


def _team(star, key, name):
    return star.teams.select(F.col("team_id").alias(key), F.col("team").alias(name))


def final_scores(star: Star) -> DataFrame:
    """One text per match: a line per innings with the team's runs and the wickets that fell."""
    sums = star.deliveries.groupBy("match_id", "innings", "batting_team_id").agg(
        F.sum("total_runs").alias("runs"), F.count("wicket_kind").alias("fallen")
    )
    lines = sums.join(_team(star, "batting_team_id", "team"), "batting_team_id").select(
        "match_id", "innings", "team", text(F.col("team"), ": ", F.col("runs"), "-", F.col("fallen")).alias("line")
    )
    return joined_text(lines, ["match_id"], ["innings", "team"], "line", "\n", "final_score")


def teams_played(star: Star) -> DataFrame:
    sides = star.team_players.select("match_id", "team_id").distinct().join(star.teams, "team_id")
    return joined_text(sides, ["match_id"], ["team"], "team", "\n vs \n", "teams_played")


def result_text():
    """What a match came to, from a match row with winner and toss winner by name."""
    winner, result, runs = F.col("match_winner"), F.col("match_result"), F.col("match_won_by_runs")
    decided = text(
        winner, " won by ", F.coalesce(runs, "match_won_by_wickets"),
        F.when(runs.isNull(), " wickets").otherwise(" runs"),
        F.when(F.col("match_won_by_innings").isNotNull(), text(" and ", F.col("match_won_by_innings"), " innings")),
    )
    undecided = text(result, F.when(winner.isNotNull(), text(" (", winner, " won)")))
    method = F.col("match_result_method")
    return text(
        F.when(result.isNotNull(), undecided).otherwise(decided),
        F.when(method.isNotNull(), text(" (", method, ")")),
    )


def match_texts(star: Star) -> DataFrame:
    """Per match with squads: result, toss, best player, event and venue lines."""
    played = star.team_players.groupBy("match_id").agg(F.max("match_date").alias("played"))
    rows = star.matches.join(played, "match_id")
    # Ids are -1 and from 1 on.
    nobody = -2 - F.abs(F.col("match_id"))
    rows = left_join_spread(rows, _team(star, "match_winner_id", "match_winner"), "match_winner_id", nobody)
    rows = left_join_spread(rows, _team(star, "toss_winner_id", "toss_winner"), "toss_winner_id", nobody)
    best = star.players.select(F.col("player_id").alias("player_of_match_id"), F.col("player_name").alias("best"))
    rows = left_join_spread(rows, best, "player_of_match_id", nobody)
    toss = text(F.col("toss_winner"), " won the toss and elected to ", F.col("toss_decision"))
    return rows.select(
        "match_id", "season", "match_date",
        result_text().alias("match_result_text"),
        F.when(F.col("toss_winner").isNotNull(), toss).alias("toss_result"),
        F.col("best").alias("man_of_the_match"),
        text(F.col("event_name"), ", ", F.col("season")).alias("event_card"),
        text(F.col("venue"), ", ", F.date_format("played", "dd-MMM-yyyy")).alias("venue_card"),
    )


def match_results(star: Star) -> DataFrame:
    rows = match_texts(star).join(teams_played(star), "match_id").join(final_scores(star), "match_id", "left")
    return rows.select(
        "match_id", "season", "match_date", "teams_played", "toss_result", "final_score", "match_result_text"
    ).orderBy(F.desc("match_date"), F.desc("match_id"))


def match_cards(star: Star, match_id=None) -> DataFrame:
    """The cards of the drill-through page, for one match or all."""
    rows = match_texts(star)
    rows = rows if match_id is None else rows.filter(F.col("match_id") == match_id)
    return rows.select("match_id", "match_result_text", "man_of_the_match", "event_card", "venue_card")


def slicer_values(star: Star) -> DataFrame:
    """The values offered by each slicer: those that occur in the squads fact."""
    facts = star.team_players
    played = star.matches.join(facts.select("match_id").distinct(), "match_id", "left_semi")
    out = star.teams.join(facts.select("team_id").distinct(), "team_id", "left_semi")
    out = out.select(F.lit("team").alias("slicer"), F.col("team").alias("value"))
    people = star.players.join(facts.select("player_id").distinct(), "player_id", "left_semi")
    out = out.unionAll(people.select(F.lit("player"), "player_name"))
    # One pass over the matches for the three match slicers.
    listed = played.select(
        F.explode(
            F.create_map(
                F.lit("event"), "event_name", F.lit("match type"), "match_type", F.lit("season"), "season"
            )
        ).alias("slicer", "value")
    )
    return out.unionAll(listed.filter("value is not null").distinct())


def player_teams(star: Star) -> DataFrame:
    """Per player: "team (matches)" of every team played for, most matches first."""
    counts = evaluate(star, ["player_id", "team_id"], ["matches"]).join(star.teams, "team_id")
    shown = counts.withColumn("shown", text(F.col("team"), " (", F.col("matches"), ")"))
    shown = shown.withColumn("rank", -F.col("matches"))
    return joined_text(shown, ["player_id"], ["rank", "team"], "shown", ", ", "player_teams")
