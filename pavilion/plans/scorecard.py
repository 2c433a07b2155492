"""The scorecard page: batting, bowling, falls of wickets, progress by over, the ball map.

All for every match and innings at once, and unsorted. `page` is the drill-through: one match
(and innings), whose filter reaches the scan, with its tables in display order.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from pavilion.functions.blanks import blank_zero, divide, minus, plus, text
from pavilion.functions.cricket import (
    BOWLER_WICKETS, EXTRAS_ID, EXTRAS_NAME, INNINGS_COLOURS, OTHER_WICKETS,
    ball_number, run_colour, switch, total_overs, two_decimals, wicket_text,
)
from pavilion.operators.joins import left_join_spread
from pavilion.operators.running import running_totals
from pavilion.operators.texts import joined_text
from pavilion.plans.measures import delivery_lines, evaluate
from pavilion.plans.star import Star
from pavilion.session import materialize

INNINGS = ["match_id", "innings"]


def person(star: Star, key: str, name: str) -> DataFrame:
    return star.players.select(F.col("player_id").alias(key), F.col("player_name").alias(name))


def batting_scorecard(star: Star) -> DataFrame:
    """One row per batter of an innings, one for the extras and one for the total.

    The total adds the batters' lines up again, and the extras row is what the total has
    beyond them, so balls are read once.
    """
    keys = [*INNINGS, "player_id"]
    sums = ["balls", "wides", "fours", "sixes", "batter_runs", "total_runs", "nsr_balls"]
    outs = ["out_kind", "out_bowler_id", "out_fielder_id"]
    # Texts make an aggregate sort its input, so the dismissals, few next to the balls, go apart.
    scores = delivery_lines(star.deliveries, keys, {"innings": (["bat", "nsr"], INNINGS)}, [*sums, "first_faced"], True, False)
    dismissed = star.deliveries.filter("player_out_id is not null")
    dismissed = delivery_lines(dismissed, keys, {"innings": (["out"], INNINGS)}, outs, True, False)
    lines = scores.unionByName(dismissed, allowMissingColumns=True)
    rows = lines.groupingSets([keys, INNINGS], *keys).agg(
        F.grouping("player_id").alias("is_total"),
        *[F.sum(c).alias(c) for c in sums],
        F.min("first_faced").alias("first_ball"),
        *[F.max(c).alias(c) for c in outs],
    )
    batter = F.col("is_total") == 0
    kinds = F.when(batter, F.array(F.lit("batter"))).otherwise(F.array(F.lit("extras"), F.lit("total")))
    rows = rows.withColumn("row", F.explode(kinds))
    extras, total = F.col("row") == "extras", F.col("row") == "total"
    rows = rows.join(star.players, "player_id", "left")
    rows = rows.join(person(star, "out_bowler_id", "bowler"), "out_bowler_id", "left")
    rows = rows.join(person(star, "out_fielder_id", "fielder"), "out_fielder_id", "left")
    seen = plus(F.col("balls"), F.col("nsr_balls")) > 0
    status = F.coalesce(
        wicket_text(F.col("out_kind"), F.col("bowler"), F.col("fielder")), F.when(seen, F.lit("not out"))
    )

    def shown(column):
        return F.when(~extras, column)

    return rows.select(
        *INNINGS,
        "row",
        F.when(extras, EXTRAS_ID).otherwise(F.col("player_id")).alias("player_id"),
        F.when(extras, EXTRAS_NAME).otherwise(F.col("player_name")).alias("player_name"),
        F.when(extras, 999).otherwise(F.col("first_ball")).alias("first_ball_faced"),
        F.when(batter, status).alias("wicket_status"),
        F.when(extras, minus(F.col("total_runs"), F.col("batter_runs")))
        .when(total, F.col("total_runs"))
        .otherwise(F.col("batter_runs"))
        .alias("runs"),
        shown(blank_zero(F.col("balls"))).alias("deliveries"),
        shown(blank_zero(F.col("fours"))).alias("fours"),
        shown(blank_zero(F.col("sixes"))).alias("sixes"),
        shown(divide(F.col("batter_runs") * 100, F.col("balls") - F.col("wides"))).alias("strike_rate"),
    )


def bowling_scorecard(star: Star) -> DataFrame:
    measures = [
        "first_ball_bowled", "wickets", "bowler_overs", "maidens", "conceded_runs",
        "no_balls_bowled", "wides_bowled", "economy",
    ]
    keys = [*INNINGS, "player_id"]
    rows = evaluate(star, keys, measures).join(star.players, "player_id", "left")
    return rows.select(*keys, "player_name", *measures)


def fall_of_wickets_rows(star: Star) -> DataFrame:
    """One row per wicket ball with the score, wickets and over it fell at.

    Ball numbers run on at six an over, so an over with extra balls shares numbers with the
    next one; the totals take in every ball with the same or a lower number.
    """
    kind = F.col("wicket_kind")
    credited = kind.isin(*BOWLER_WICKETS, *OTHER_WICKETS)
    balls = star.deliveries.select(
        *INNINGS, "overs", "balls", "total_runs", kind, "player_out_id",
        ball_number().alias("ball_no"),
        F.coalesce(credited, F.lit(False)).cast("int").alias("out"),
    )
    balls = running_totals(balls, INNINGS, "ball_no", {"score": "total_runs", "wicket_no": "out"})
    # Wides and no-balls of an over, as the list of their ball numbers; most overs have none.
    wide, no_ball = F.col("wides") != 0, F.col("no_balls") != 0
    illegal = star.deliveries.filter(wide | no_ball).groupBy(*INNINGS, "overs")
    illegal = illegal.agg(
        F.concat(F.collect_list(F.when(wide, F.col("balls"))), F.collect_list(F.when(no_ball, F.col("balls")))).alias("at")
    )
    fallen = balls.filter(kind.isNotNull()).join(illegal, [*INNINGS, "overs"], "left")
    fallen = fallen.join(person(star, "player_out_id", "player_out"), "player_out_id", "left")
    so_far = F.when(F.col("at").isNull(), 0).otherwise(F.size(F.filter("at", lambda b: b <= F.col("balls"))))
    over_ball = text(F.col("overs") - 1, ".", F.col("balls") - so_far)
    wicket_no = F.nullif(F.col("wicket_no"), F.lit(0).cast("long"))
    return fallen.select(
        *INNINGS, "ball_no", "score", wicket_no.alias("wicket_no"), "player_out",
        text(F.col("score"), "-", wicket_no, " (", F.col("player_out"), ", ", over_ball, ")").alias("fall"),
    )


def fall_of_wickets(star: Star) -> DataFrame:
    """Per innings, the falls in one text. It is one value by definition; `fall_of_wickets_rows` has them as rows."""
    rows = fall_of_wickets_rows(star)
    return joined_text(rows, INNINGS, ["wicket_no", "ball_no"], "fall", ", ", "fall_of_wickets")


def did_not_bat(star: Star) -> DataFrame:
    """Per innings: the squad of the batters' team that neither faced nor stood at the other end."""
    batted = star.deliveries.select(*INNINGS, F.explode(F.array("batter_id", "non_striker_id")).alias("player_id"))
    batted = batted.filter("player_id is not null").distinct()
    squads = star.team_players.select("match_id", "team_id", "player_id")
    sides = batted.join(squads, ["match_id", "player_id"]).select(*INNINGS, "team_id").distinct()
    rest = sides.join(squads, ["match_id", "team_id"]).select(*INNINGS, "player_id").distinct()
    rest = rest.join(batted, [*INNINGS, "player_id"], "left_anti").join(star.players, "player_id")
    return joined_text(rest, INNINGS, ["player_name"], "player_name", ", ", "did_not_bat")


def innings_header(star: Star) -> DataFrame:
    """Per innings: team and "runs-wickets (overs.balls Ov, RR: rate, Inn: n)"."""
    illegal = (F.coalesce("wides", F.lit(0)) != 0).cast("int") + (F.coalesce("no_balls", F.lit(0)) != 0).cast("int")
    overs = star.deliveries.groupBy(*INNINGS, "overs").agg(
        F.sum("total_runs").alias("runs"),
        F.count_if(F.col("wicket_kind").isin(*BOWLER_WICKETS, *OTHER_WICKETS)).alias("out"),
        F.max(ball_number()).alias("last_ball"),
        F.sum(illegal).alias("illegal"),
        F.max("batting_team_id").alias("team_id"),
    )
    sums = overs.groupBy(*INNINGS).agg(
        F.sum("runs").alias("runs"),
        F.sum("out").alias("out"),
        F.count(F.lit(1)).alias("overs"),
        F.max("last_ball").alias("last_ball"),
        F.max_by("illegal", "overs").alias("illegal"),
        F.max("team_id").alias("team_id"),
    )
    legal = F.col("last_ball") - F.col("illegal")
    score = text(
        F.col("runs"), "-", F.col("out"),
        " (", ((legal - legal % 6) / 6).cast("long"), ".", legal % 6,
        " Ov, RR: ", two_decimals(F.col("runs"), F.col("overs")), ", Inn: ", F.col("innings"), ")",
    )
    rows = sums.join(star.teams, "team_id", "left")
    return rows.select(*INNINGS, "team", score.alias("score"), text(F.col("team"), ": ", score).alias("header"))


def over_sums(star: Star) -> DataFrame:
    """Per over: runs, wickets, balls and the bowler (the last by name, where there were several)."""
    kind = F.col("wicket_kind")
    spells = star.deliveries.groupBy(*INNINGS, "overs", "bowler_id").agg(
        F.sum("total_runs").alias("runs"),
        F.count_if(kind.isin(*BOWLER_WICKETS)).alias("wickets"),
        F.count(kind).alias("fallen"),
        F.max("balls").alias("balls"),
    )
    spells = spells.join(person(star, "bowler_id", "bowler"), "bowler_id", "left")
    return spells.groupBy(*INNINGS, "overs").agg(
        *[F.sum(c).alias(c) for c in ("runs", "wickets", "fallen")],
        F.max("balls").alias("balls"), F.max("bowler").alias("bowler_name"), F.lit(1).alias("one"),
    )


def over_progress(overs: DataFrame) -> DataFrame:
    """Overs with the running runs, wickets and rate of their innings."""
    totals = {"cumulative_runs": "runs", "cumulative_wickets": "wickets", "overs_so_far": "one"}
    return running_totals(overs, INNINGS, "overs", totals)


def match_axes(star: Star, overs: DataFrame) -> DataFrame:
    """Per match: highest runs in an over, most balls in an over, and the overs axis. overs needs runs and balls only."""
    per_match = overs.groupBy("match_id").agg(
        F.max("runs").alias("max_runs_per_over"),
        F.max("balls").alias("total_balls_per_over"),
        F.max("overs").alias("last_over"),
    )
    per_match = per_match.join(star.matches.select("match_id", "match_type"), "match_id", "left")
    axis = total_overs(F.col("match_type"), F.col("last_over")).cast("long")
    return per_match.select("match_id", "max_runs_per_over", "total_balls_per_over", axis.alias("total_overs"))


def manhattan(star: Star) -> DataFrame:
    """Runs per over with wickets, run rate so far and bowler, and the axis ends of the match.

    The overs are written once: running totals and axes are made from these few rows, and the balls are read once.
    """
    overs = materialize(over_sums(star), "overs")
    rows = over_progress(overs).join(match_axes(star, overs), "match_id")
    return rows.select(
        *INNINGS, "overs",
        F.col("runs").alias("overall_runs"),
        blank_zero(F.col("wickets")).alias("wickets"),
        divide(F.col("cumulative_runs"), F.col("overs_so_far")).alias("run_rate"),
        "bowler_name", "max_runs_per_over", "total_overs",
    )


def worm(star: Star) -> DataFrame:
    """Cumulative runs by over, with marks (and their error bars) on overs with a wicket."""
    rows = over_progress(over_sums(star))
    mark = F.when(F.col("fallen") > 0, F.col("cumulative_runs"))
    return rows.select(
        *INNINGS, "overs", "cumulative_runs",
        blank_zero(F.col("cumulative_wickets")).alias("cumulative_wickets"),
        mark.alias("wicket_mark"), (mark - 1).alias("mark_low"), (mark + 1).alias("mark_high"),
        switch(F.col("innings"), INNINGS_COLOURS).alias("innings_colour"),
    )


def worm_tooltip(star: Star) -> DataFrame:
    """Per innings and team: overs, runs and wickets; up to the last over, so plain totals."""
    rows = evaluate(star, [*INNINGS, "team_id"], ["max_overs", "overall_runs", "team_wickets"])
    rows = rows.join(star.teams, "team_id", "left")
    return rows.filter("max_overs is not null").select(
        *INNINGS, "team_id", "team", "max_overs",
        F.col("overall_runs").alias("cumulative_runs"),
        "team_wickets",
        F.col("team_wickets").alias("cumulative_wickets"),
    )


def ball_map(star: Star) -> DataFrame:
    """Every ball with runs, wicket, colour, players and the axis ends of its match.

    Names are looked up by id, each role on its own: broadcast while there are few players, else by shuffles, in which balls
    without a wicket or a fielder are spread over the tasks.
    """
    sums = star.deliveries.groupBy(*INNINGS, "overs").agg(F.sum("total_runs").alias("runs"), F.max("balls").alias("balls"))
    axes = match_axes(star, sums).drop("max_runs_per_over")
    rows = star.deliveries.join(axes, "match_id", "left")
    # Ids are -1 and from 1 on.
    nobody = -2 - F.abs(F.xxhash64("match_id", "innings", "overs", "balls") % 2**40)
    for key, name in (("bowler_id", "bowler"), ("batter_id", "batter"), ("player_out_id", "player_out"), ("fielder_id", "fielder")):
        rows = left_join_spread(rows, person(star, key, name), key, nobody)
    kind, out = F.col("wicket_kind"), F.col("player_out")
    # The wicket's names hang on the player out: without one, the details stay blank.
    status = wicket_text(kind, F.col("bowler"), F.col("fielder"))
    return rows.select(
        *INNINGS, "overs", "balls",
        F.col("total_runs").alias("overall_runs"),
        F.when(kind.isin(*BOWLER_WICKETS), 1).alias("wickets"),
        F.when(F.col("wides") != 0, 1).alias("wides"),
        F.when(F.col("no_balls") != 0, 1).alias("no_balls"),
        F.col("bowler").alias("bowler_name"),
        F.col("batter").alias("batsman_name"),
        F.when(out.isNotNull(), text(out, " - ", status)).alias("wicket_details"),
        run_colour(kind, F.col("total_runs")).alias("colour"),
        "total_balls_per_over", "total_overs",
    )


def page(star: Star, match_id, innings=None) -> dict:
    """The page's datasets for one match, or one of its innings (innings number from 1)."""
    facts = star.deliveries.filter(F.col("match_id") == match_id)
    facts = facts if innings is None else facts.filter(F.col("innings") == innings)
    one = replace(
        star,
        deliveries=facts,
        team_players=star.team_players.filter(F.col("match_id") == match_id),
        matches=star.matches.filter(F.col("match_id") == match_id),
    )
    return {
        "batting": batting_scorecard(one).orderBy("innings", "first_ball_faced"),
        "bowling": bowling_scorecard(one).orderBy("innings", "first_ball_bowled"),
        "fall_of_wickets": fall_of_wickets(one).orderBy("innings"),
        "did_not_bat": did_not_bat(one).orderBy("innings"),
        "header": innings_header(one).orderBy("innings"),
        "manhattan": manhattan(one).orderBy("innings", "overs"),
        "worm": worm(one).orderBy("innings", "overs"),
        "worm_tooltip": worm_tooltip(one).orderBy(F.desc("cumulative_runs")),
        "ball_map": ball_map(one).orderBy("innings", "overs", "balls"),
    }
