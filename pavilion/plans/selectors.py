"""Match sets: each returns the match_ids that a report is then restricted to.

A set is found in the outer selection (the same where / players / teams that `evaluate`
takes); `evaluate(..., selector=set)` then shows those matches with both their sides.
"""

from pyspark.sql import DataFrame, functions as F

from pavilion.operators.joins import top_ties
from pavilion.plans.measures import evaluate
from pavilion.plans.star import Star


def _best(star, measure, grain, **selection) -> DataFrame:
    return top_ties(evaluate(star, grain, [measure], **selection), measure).select("match_id").distinct()


def _reaching(star, measure, least, **selection) -> DataFrame:
    scores = evaluate(star, ["match_id", "player_id"], [measure], **selection)
    return scores.filter(F.col(measure) >= least).select("match_id").distinct()


def all_matches(star: Star, where=None, players=None, teams=None) -> DataFrame:
    """Every match of the selected players and teams."""
    rows = star.team_players
    if players is not None:
        rows = rows.filter(F.col("player_id").isin(*players))
    if teams is not None:
        rows = rows.filter(F.col("team_id").isin(*teams))
    if where is not None:
        rows = rows.join(star.matches.filter(where).select("match_id"), "match_id", "left_semi")
    return rows.select("match_id").distinct()


def highest_score(star, **selection):
    return _best(star, "batter_runs", ["match_id"], **selection)


def highest_wickets(star, **selection):
    return _best(star, "wickets", ["match_id"], **selection)


def hundreds(star, **selection):
    """A batter's runs in the match, not in one innings."""
    return _reaching(star, "batter_runs", 100, **selection)


def five_wickets(star, **selection):
    """A bowler's wickets in the match, not in one innings."""
    return _reaching(star, "wickets", 5, **selection)


def highest_sixes(star, **selection):
    return _best(star, "sixes", ["match_id"], **selection)


def highest_fours(star, **selection):
    return _best(star, "fours", ["match_id"], **selection)


def highest_runs_in_over(star, **selection):
    return _best(star, "overall_runs", ["match_id", "innings", "overs"], **selection)


def highest_wickets_in_over(star, **selection):
    return _best(star, "wickets", ["match_id", "innings", "overs"], **selection)


def tied(star: Star, where=None, players=None, teams=None) -> DataFrame:
    rows = star.matches if where is None else star.matches.filter(where)
    return rows.filter("match_result = 'tie'").select("match_id")


def in_team(star: Star, keys, measures, teams, **context) -> DataFrame:
    """`evaluate` for chosen teams, less the rows that no squad row of these teams stands behind; all rows without a choice."""
    if teams is None:
        return evaluate(star, keys, measures, **context)
    asked = list(dict.fromkeys([*measures, "matches"]))
    rows = evaluate(star, keys, asked, teams=teams, **context)
    return rows.filter("matches is not null").select(*keys, *measures)


SELECTORS = {
    "all_matches": all_matches,
    "highest_score": highest_score,
    "highest_wickets": highest_wickets,
    "hundreds": hundreds,
    "five_wickets": five_wickets,
    "highest_sixes": highest_sixes,
    "highest_fours": highest_fours,
    "highest_runs_in_over": highest_runs_in_over,
    "highest_wickets_in_over": highest_wickets_in_over,
    "tied": tied,
}
