import datetime

import pytest
from matches import write_all
from pavilion.plans import reports, scorecard
from pavilion.plans.measures import evaluate
from pavilion.plans.star import build_star
from pavilion.sources.match_json import read_matches


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("matches")
    write_all(folder)
    return build_star(read_matches(spark, str(folder)))


@pytest.fixture(scope="module")
def ids(star):
    people = {r.player_name: r.player_id for r in star.players.collect()}
    return people | {r.team: r.team_id for r in star.teams.collect()}


def test_ids_follow_name_order(ids):
    assert [ids[n] for n in ("a1", "a2", "a3", "b1", "b2", "b3")] == [1, 2, 3, 4, 5, 6]
    assert (ids["Extras"], ids["A"], ids["B"]) == (-1, 1, 2)


def test_match_dimension(star, ids):
    rows = {r.match_id: r for r in star.matches.collect()}
    assert rows[1].umpires == "U1, U2" and rows[2].umpires == ""
    assert (rows[1].match_won_by_runs, rows[1].event_match_number) == ("5", 1)
    assert rows[1].match_date == datetime.date(2020, 1, 2)
    # toss: A fields, so B bats; B bats; A bats; B fields, so A bats
    assert [rows[i].first_bat_id for i in (1, 2, 3, -4)] == [ids["B"], ids["B"], ids["A"], ids["A"]]
    assert [rows[i].first_field_id for i in (1, 2, 3, -4)] == [ids["A"], ids["A"], ids["B"], ids["B"]]
    # one-team squads: no other team, and no error
    assert (rows[5].first_bat_id, rows[5].first_field_id) == (None, ids["A"])
    assert rows[3].match_winner_id == ids["B"] and rows[-4].match_winner_id is None
    assert rows[-4].player_of_match_id is None


def test_dates_cover_whole_years(star):
    days = star.dates.orderBy("date").collect()
    assert (days[0].date, days[-1].date) == (datetime.date(2020, 1, 1), datetime.date(2021, 12, 31))
    assert len(days) == 366 + 365
    assert tuple(days[31])[1:] == (2020, "Q1", 2, "Feb")


def test_team_players(star):
    assert star.team_players.count() == 4 * 6 + 2


def test_deliveries(star, ids):
    balls = {(r.match_id, r.innings, r.overs, r.balls): r for r in star.deliveries.collect()}
    # 11 + 3 balls, one ball each in 2, four in 3, one in -4 and one in 5; an innings without overs has none
    assert len(balls) == 14 + 1 + 4 + 1 + 1
    assert {k[1] for k in balls if k[0] == 3} == {1, 2, 3, 4}
    first = balls[1, 1, 1, 4]
    assert (first.wicket_kind, first.player_out_id, first.fielder_id) == ("caught", ids["b1"], ids["a2"])
    two = balls[1, 1, 2, 3]
    assert (two.wicket_kind, two.player_out_id, two.fielder_id) == ("bowled", ids["b3"], None)
    assert balls[1, 2, 1, 3].fielder_id is None  # a substitute in no squad
    assert (balls[1, 1, 1, 2].wides, balls[1, 1, 1, 3].no_balls, balls[1, 1, 1, 5].byes) == (1, 1, 2)
    assert balls[1, 1, 1, 8].total_runs == 5  # penalty runs are only in the total
    assert (first.batting_team_id, first.bowling_team_id) == (ids["B"], ids["A"])
    assert balls[5, 1, 1, 1].bowling_team_id is None


def test_result_texts(star):
    rows = {r.match_id: r for r in reports.match_results(star).collect()}
    assert rows[1].match_result_text == "B won by 5 runs"
    assert rows[2].match_result_text == "A won by 7 wickets (D/L)"
    assert rows[3].match_result_text == "tie (B won)"
    assert rows[-4].match_result_text == "no result"
    assert rows[5].match_result_text == "A won by 30 runs and 1 innings"
    assert rows[1].teams_played == "A\n vs \nB"
    assert rows[1].toss_result == "A won the toss and elected to field"
    # every recorded wicket counts here, the retired one too
    assert rows[1].final_score == "B: 21-4\nA: 2-2"
    cards = {r.match_id: r for r in reports.match_cards(star).collect()}
    assert cards[1].event_card == "E, 2020" and cards[1].venue_card == "V, 02-Jan-2020"
    assert cards[1].man_of_the_match == "b1" and cards[-4].man_of_the_match is None


def test_fall_of_wickets(star):
    rows = {(r.match_id, r.innings): r.fall_of_wickets for r in scorecard.fall_of_wickets(star).collect()}
    # Ball seven of the first over has the number of the next over's first, whose run it takes in.
    assert rows[1, 1] == "6-1 (b1, 0.2), 16-2 (b2, 0.5), 21-2 (b1, 1.2), 21-3 (b3, 1.3)"


def test_fall_before_any_counted_wicket(spark, star):
    only = star.deliveries.filter("match_id = 1 and innings = 1 and overs = 2 and balls <= 2")
    from dataclasses import replace

    rows = scorecard.fall_of_wickets(replace(star, deliveries=only)).collect()
    assert rows[0].fall_of_wickets == "1- (b1, 1.2)"  # a blank count shows nothing


def test_scorecards(star, ids):
    page = scorecard.page(star, 1, 1)
    rows = page["batting"].collect()
    shown = [(r.row, r.player_name, r.wicket_status, r.runs, r.deliveries) for r in rows]
    assert shown[-1] == ("extras", "Extras", None, 10, None)
    assert ("total", None, None, 21, 11) in shown
    by_name = {r.player_name: r for r in rows if r.row == "batter"}
    assert by_name["b1"].wicket_status == "retired hurt"  # the later text of the two wins
    assert by_name["b2"].wicket_status == "run out (a3)" and by_name["b2"].runs is None
    assert by_name["b3"].wicket_status == "b a2" and (by_name["b3"].runs, by_name["b3"].sixes) == (7, 1)
    bowling = {r.player_name: r for r in page["bowling"].collect()}
    assert (bowling["a1"].conceded_runs, bowling["a1"].wickets, bowling["a1"].bowler_overs) == (17, 1, 1)
    assert (bowling["a1"].wides_bowled, bowling["a1"].no_balls_bowled) == (1, 1)
    assert bowling["a1"].economy == pytest.approx(17.0)
    header = page["header"].collect()[0].header
    # 9 balls by number, none of the last over's three are wides or no-balls
    assert header == "B: 21-3 (1.3 Ov, RR: 10.50, Inn: 1)"
    other = scorecard.page(star, 1, 2)["batting"].collect()
    status = {r.player_name: r.wicket_status for r in other if r.row == "batter"}
    assert status == {"a1": "c & b b1", "a2": "not out", "a3": "st  b b1"}
    assert [r.did_not_bat for r in scorecard.page(star, 2, 1)["did_not_bat"].collect()] == ["b3"]


def test_roles_in_player_measures(star, ids):
    rows = evaluate(star, ["player_id"], ["bat_innings", "not_outs", "batting_average", "catches", "player_of_match"])
    got = {r.player_id: r for r in rows.collect()}
    b2 = got[ids["b2"]]
    assert (b2.bat_innings, b2.not_outs) == (4, 3)  # three at the other end, one at the crease, out once
    assert (got[ids["a2"]].catches, got[ids["b1"]].catches) == (1, 1)  # caught, and caught and bowled
    assert got[ids["b1"]].player_of_match == 4  # also where the match names a player outside its squads
