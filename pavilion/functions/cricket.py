"""Fixed values and small expressions of the game."""

from functools import reduce

from pyspark.sql import Column, functions as F

from pavilion.functions.blanks import text

# Dismissals credited to the bowler, and the others that count as a wicket.
BOWLER_WICKETS = ["bowled", "caught", "caught and bowled", "lbw", "stumped", "hit wicket"]
OTHER_WICKETS = ["obstructing the field", "run out"]

# Display colours of a ball by runs, of a wicket ball, and of an innings.
WICKET_COLOUR = "#E66C37"
RUN_COLOURS = {0: "#CCCCCC", 1: "#B9DBFB", 2: "#A0D1FF", 3: "#70BBFF", 4: "#41A4FF", 5: "#0D6ABF", 6: "#094780"}
INNINGS_COLOURS = {1: "#41A4FF", 2: "#12239E", 3: "#A666B0", 4: "#E8D166", 5: "#744EC2", 6: "#6B007B"}

# Scheduled overs of the limited-overs formats.
FORMAT_OVERS = {"T20": 20, "ODI": 50}

EXTRAS_ID, EXTRAS_NAME = -1, "Extras"


def ball_number() -> Column:
    """Running number of a ball in its innings, at six a started over."""
    return (F.col("overs") - 1) * 6 + F.col("balls")


def switch(value: Column, cases: dict) -> Column:
    """The value of the matching case, else blank."""
    return reduce(lambda c, kv: c.when(value == kv[0], F.lit(kv[1])), cases.items(), F.when(F.lit(False), None))


def run_colour(wicket_kind: Column, runs: Column) -> Column:
    return F.when(wicket_kind.isNotNull(), F.lit(WICKET_COLOUR)).otherwise(switch(runs, RUN_COLOURS))


def total_overs(match_type: Column, last_over: Column) -> Column:
    return F.coalesce(switch(match_type, FORMAT_OVERS), last_over)


def wicket_text(kind: Column, bowler: Column, fielder: Column) -> Column:
    """How a batter was out, as a scorecard prints it."""
    return (
        F.when(kind == "caught", text("c ", fielder, " b ", bowler))
        .when(kind == "caught and bowled", text("c & b ", bowler))
        .when(kind == "run out", text("run out (", fielder, ")"))
        .when(kind == "bowled", text("b ", bowler))
        .when(kind == "stumped", text("st ", fielder, " b ", bowler))
        .when(kind == "lbw", text("lbw b ", bowler))
        .when(kind == "hit wicket", text("hit wkt b ", bowler))
        .otherwise(kind)
    )


def two_decimals(a: Column, b: Column) -> Column:
    """a / b to two places, halves up, no zero before the point.

    Works on whole numbers throughout, so no rounding of a double decides the text.
    """
    scaled, unit = a * 200 + b, b * 2
    hundredths = ((scaled - scaled % unit) / unit).cast("long")
    units = ((hundredths - hundredths % 100) / 100).cast("long")
    return text(F.when(units > 0, units), ".", F.lpad((hundredths % 100).cast("string"), 2, "0"))
