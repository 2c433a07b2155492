"""Measures against brute force over random balls, and identities that hold for any star."""

import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pavilion.plans.measures import DELIVERY_MEASURES, MEASURES, evaluate
from pavilion.plans.selectors import SELECTORS
from pavilion.sources.sample_star import sample_star
from pyspark.sql import functions as F

KINDS = [None] * 12 + ["caught", "bowled", "run out", "caught and bowled", "retired hurt", "stumped", "lbw"]
CREDITED = {"bowled", "caught", "caught and bowled", "lbw", "stumped", "hit wicket"}


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return sample_star(spark, sf_dir)


@pytest.fixture(scope="module")
def balls(spark, star):
    """Random balls of two teams, with the columns of the fact."""
    rng = random.Random(11)
    columns = star.deliveries.columns
    rows = []
    for match in range(4):
        for inn in (1, 2):
            bt, wt = (1, 2) if inn == 1 else (2, 1)
            for over in range(1, 9):
                for n in range(1, 7):
                    r = dict.fromkeys(columns)
                    batter, other = rng.sample(range(bt * 10, bt * 10 + 4), 2)
                    kind = rng.choice(KINDS)
                    r.update(
                        match_id=match, batting_team_id=bt, bowling_team_id=wt, innings=inn, overs=over, balls=n,
                        batter_id=batter, non_striker_id=other, bowler_id=wt * 10 + over % 3,
                        wides=rng.choice([None, None, 1]), no_balls=rng.choice([None, None, None, 1]),
                        byes=rng.choice([None, 2]), batter_runs=rng.choice([0, 0, 1, 4, 6, 30]), wicket_kind=kind,
                        player_out_id=rng.choice([batter, other]) if kind else None,
                        fielder_id=rng.choice([wt * 10, wt * 10 + 1, None]) if kind == "caught" else None,
                    )
                    r["total_runs"] = r["batter_runs"] + sum(r[c] or 0 for c in ("wides", "no_balls", "byes"))
                    rows.append(r)
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], star.deliveries.schema)
    return rows, replace(star, deliveries=df)


def grouped(rows, *columns):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[c] for c in columns)].append(r)
    return groups


def test_player_measures_against_brute_force(balls):
    rows, star = balls
    names = list(DELIVERY_MEASURES)
    got = {r.player_id: r.asDict() for r in evaluate(star, ["player_id"], names).collect()}
    assert set(got) == {r["batter_id"] for r in rows} | {r["bowler_id"] for r in rows}
    for p, m in got.items():
        bat = [r for r in rows if r["batter_id"] == p]
        bowl = [r for r in rows if r["bowler_id"] == p]
        ends = {(r["match_id"], r["innings"]) for r in rows if p in (r["batter_id"], r["non_striker_id"])}
        outs = {(r["match_id"], r["innings"]) for r in rows if r["player_out_id"] == p}
        innings = [sum(r["batter_runs"] for r in g) for g in grouped(bat, "match_id", "innings").values()]
        assert m["batter_runs"] == (sum(innings) if bat else None)
        assert m["highest_score"] == (max(innings) if bat else None)
        assert (m["hundreds"] or 0) == sum(i >= 100 for i in innings)
        assert (m["fifties"] or 0) == sum(50 <= i < 100 for i in innings)
        assert (m["bat_innings"] or 0) == len(ends)
        assert (m["not_outs"] or 0) == len(ends) - len(outs)
        spells = [
            (sum(r["wicket_kind"] in CREDITED for r in g), -sum(r["total_runs"] - (r["byes"] or 0) for r in g))
            for g in grouped(bowl, "match_id", "innings").values()
        ]
        assert (m["wickets"] or 0) == sum(s[0] for s in spells)
        assert m["best_bowl_innings"] == (f"{max(spells)[0]}/{-max(spells)[1]}" if spells else None)
        assert (m["five_wickets"] or 0) == sum(s[0] >= 5 for s in spells)
        overs = grouped(bowl, "match_id", "innings", "overs").values()
        assert (m["maidens"] or 0) == sum(sum(r["total_runs"] for r in g) == 0 for g in overs)
        assert (m["bowler_overs"] or 0) == len({r["overs"] for r in bowl})
        legal = len(bowl) - sum(r["wides"] is not None for r in bowl) - sum(r["no_balls"] is not None for r in bowl)
        economy = -sum(s[1] for s in spells) / (legal / 6) if legal else None
        assert m["economy"] == (pytest.approx(economy) if economy is not None else None)
        held = sum(r["fielder_id"] == p for r in rows) + sum(r["wicket_kind"] == "caught and bowled" for r in bowl)
        assert (m["catches"] or 0) == held


def test_empty_roles_do_not_lose_balls_without_a_player(balls):
    rows, star = balls
    total = evaluate(star, [], ["deliveries", "catches", "wickets", "over_count", "maidens"]).first()
    assert total.deliveries == len(rows)
    # a catch whose fielder is unknown still counts where no player is asked for
    assert total.catches == sum(r["wicket_kind"] in ("caught", "caught and bowled") for r in rows)
    assert total.wickets == sum(r["wicket_kind"] in CREDITED for r in rows)
    assert total.over_count == 4 * 2 * 8


def test_blank_rows_are_left_out_and_blanks_are_not_zero(balls):
    rows, star = balls
    sixes = {r.player_id: r.sixes for r in evaluate(star, ["player_id"], ["sixes"]).collect()}
    assert 0 not in sixes.values() and None not in sixes.values()
    # whoever neither bats nor bowls has no row at all
    assert set(sixes) <= {r["batter_id"] for r in rows}


def test_bowlers_seen_from_the_batting_team(balls):
    rows, star = balls
    got = evaluate(star, ["player_id", "team_id"], ["wickets", "team_wickets"]).collect()
    for r in got:
        taken = [b for b in rows if b["bowler_id"] == r.player_id and b["wicket_kind"] in CREDITED]
        assert (r.wickets or 0) == sum(b["bowling_team_id"] == r.team_id for b in taken)
        assert (r.team_wickets or 0) == sum(b["batting_team_id"] == r.team_id for b in taken)


def test_identities(star):
    keys = ["match_id", "innings"]
    total = evaluate(star, keys, ["overall_runs", "extra_runs"])
    batters = evaluate(star, [*keys, "player_id"], ["batter_runs"]).groupBy(*keys).agg(F.sum("batter_runs").alias("b"))
    both = total.join(batters, keys)
    assert both.count() == total.count()
    assert both.filter("b + extra_runs <> overall_runs").count() == 0


def test_measures_do_not_depend_on_what_else_is_asked(star):
    every = evaluate(star, ["season"], list(MEASURES)).collect()
    for name in ("hundreds", "highest_score", "max_runs_per_over", "bowler_overs", "season_wins", "not_outs"):
        alone = {r.season: r[name] for r in evaluate(star, ["season"], [name]).collect()}
        assert {r.season: r[name] for r in every if r[name] is not None} == alone


@pytest.mark.parametrize("name", SELECTORS)
def test_selectors_show_both_sides(star, name):
    picked = SELECTORS[name](star, teams=[3])
    shown = evaluate(star, ["match_id", "team_id"], ["matches"], selector=picked)
    assert shown.groupBy("match_id").count().filter("count <> 2").count() == 0
    assert shown.select("match_id").distinct().count() == picked.count() == picked.distinct().count()


def test_season_wins_follow_the_selection(star):
    """The last match of a season is looked for among the chosen matches, whoever played it."""
    matches = [r.asDict() for r in star.matches.collect()]

    def expected(chosen):
        last = {}
        for m in sorted(chosen, key=lambda m: m["match_id"]):
            last[m["season"]] = m["match_winner_id"]
        return sum(w is not None for w in last.values()) or None

    tied = [m for m in matches if m["match_result"] == "tie"]
    got = evaluate(star, [], ["season_wins"], selector=SELECTORS["tied"](star)).first()
    assert got.season_wins == expected(tied)
    t20 = [m for m in matches if m["match_type"] == "T20"]
    assert evaluate(star, [], ["season_wins"], where="match_type = 'T20'").first().season_wins == expected(t20)
    both = [m for m in tied if m["match_type"] == "T20"]
    got = evaluate(star, [], ["season_wins"], where="match_type = 'T20'", selector=SELECTORS["tied"](star)).first()
    assert got.season_wins == expected(both)
