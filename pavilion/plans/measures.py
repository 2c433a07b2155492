"""Measures over the star, evaluated for any keys, filters and match set.

A measure is an outer aggregate over "lines": facts pre-aggregated to the grain the measure
thinks in (an innings, a player's innings, an over, a match). `evaluate` aggregates the lines
of all grains that the asked measures need in one pass over the balls, and the lines once by
the keys. A hot key is spread over its lines first, and both steps combine on the map side.

A ball belongs to several players and to two teams. Which column plays player_id or team_id
is the measure's role. A ball is stacked once for each grain and each role wanted in it, with
only the columns of that grain, so one aggregate serves them all and no line is made that no
measure looks at.

Quantities and measures are written as SQL expressions: a plan has hundreds of them, and one is
one call to the JVM, where columns put together by functions are dozens.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pavilion.functions.cricket import BOWLER_WICKETS, OTHER_WICKETS
from pavilion.plans.star import Star
from pavilion.session import materialize

# role: (player column, team column)
ROLES = {
    "bat": ("batter_id", "batting_team_id"),
    "nsr": ("non_striker_id", "batting_team_id"),
    "out": ("player_out_id", "batting_team_id"),
    "bwl": ("bowler_id", "bowling_team_id"),
    "bwl_bt": ("bowler_id", "batting_team_id"),  # the bowler, seen from the batting team
    "fld": ("fielder_id", "bowling_team_id"),
}

# Rows carry a role as a small number, which is cheaper to compare for every quantity than a text.
CODES = {role: i for i, role in enumerate([*ROLES, "squad", "best"])}

# Without a player in the keys or filters a role only chooses the team, and each ball must
# count once: the roles that can be empty, or that repeat a ball, give way to one that does.
WITHOUT_PLAYER = {"nsr": "bat", "out": "bat", "bwl_bt": "bat", "fld": "bwl"}

# grain: columns a line has besides the keys
GRAINS = {
    "innings": ["match_id", "innings"],
    "player": ["match_id", "innings", "player_id"],
    "over": ["match_id", "innings", "overs"],
    "player_over": ["match_id", "innings", "overs", "player_id"],
    "over_number": ["overs"],
    "match": ["match_id"],
}

GRAIN_CODES = {grain: i for i, grain in enumerate(GRAINS)}

# Keys looked up in the match dimension, and keys that follow from a fact's own date.
MATCH_ATTRIBUTES = ["season", "event_name", "venue", "match_type", "match_result"]
DATE_ATTRIBUTES = {
    "year": "year(match_date)",
    "quarter": "concat('Q', quarter(match_date))",
    "month_number": "month(match_date)",
    "month": "date_format(match_date, 'MMM')",
}


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


CREDITED, OTHER, BALL = f"wicket_kind in ({_texts(BOWLER_WICKETS)})", f"wicket_kind in ({_texts(OTHER_WICKETS)})", "(overs - 1) * 6 + balls"

# Base quantities of a delivery line: aggregate, role, and what of a ball it takes (a condition where it counts).
QUANTITIES = {
    "balls": ("count", "bat", "true"),
    "total_runs": ("sum", "bat", "total_runs"),
    "batter_runs": ("sum", "bat", "batter_runs"),
    "byes": ("sum", "bat", "byes"),
    "leg_byes": ("sum", "bat", "leg_byes"),
    "wides": ("count", "bat", "wides <> 0"),
    "no_balls": ("count", "bat", "no_balls <> 0"),
    "fours": ("count", "bat", "batter_runs = 4"),
    "sixes": ("count", "bat", "batter_runs = 6"),
    "first_faced": ("min", "bat", BALL),
    "last_over": ("max", "bat", "overs"),
    "nsr_balls": ("count", "nsr", "true"),
    "out_balls": ("count", "out", "true"),
    "out_kind": ("max", "out", "wicket_kind"),
    "out_bowler_id": ("max", "out", "bowler_id"),
    "out_fielder_id": ("max", "out", "fielder_id"),
    "team_wickets": ("count", "bwl_bt", CREDITED),
    "bowled_balls": ("count", "bwl", "true"),
    "bowled_runs": ("sum", "bwl", "total_runs"),
    "bowled_byes": ("sum", "bwl", "byes"),
    "bowled_leg_byes": ("sum", "bwl", "leg_byes"),
    "bowled_wides": ("count", "bwl", "wides <> 0"),
    "bowled_no_balls": ("count", "bwl", "no_balls <> 0"),
    "wickets": ("count", "bwl", CREDITED),
    "other_wickets": ("count", "bwl", OTHER),
    "first_bowled": ("min", "bwl", BALL),
    "catches": ("count", "fld", "wicket_kind = 'caught'"),
    "own_catches": ("count", "bwl", "wicket_kind = 'caught and bowled'"),
}


def _line_sums(seat, wanted) -> list:
    """The wanted base quantities of a delivery line. seat(role) is the role that stands in for it."""
    def of(name):
        aggregate, role, value = QUANTITIES[name]
        here = f"role = {CODES[seat(role)]}"
        if aggregate == "count":
            return f"count_if({here} and {value}) as {name}"
        return f"{aggregate}(if({here}, {value}, null)) as {name}"

    return [F.expr(of(name)) for name in wanted]


@dataclass(frozen=True)
class Measure:
    grain: str
    roles: tuple
    value: object  # line columns -> outer aggregate, in SQL


def _plus(*terms) -> str:
    """Blanks add as 0, and nothing but blanks stays blank."""
    return f"if(coalesce({', '.join(terms)}) is null, null, {' + '.join(f'coalesce({t}, 0)' for t in terms)})"


def _minus(first, *rest) -> str:
    return f"if(coalesce({', '.join([first, *rest])}) is null, null, {' - '.join(f'coalesce({t}, 0)' for t in [first, *rest])})"


def _divide(a, b) -> str:
    """Blank on a blank or zero divisor."""
    return f"try_divide(cast({a} as double), cast({b} as double))"


def _conceded(c):
    return _minus(*[f"sum({c(q)})" for q in ("bowled_runs", "bowled_byes", "bowled_leg_byes")])


def _count(c, column):
    """A count of nothing shows blank, not 0."""
    return f"nullif(sum({c(column)}), 0)"


def _having(condition):
    return f"nullif(count_if({condition}), 0)"


def _economy(c):
    legal = f"sum({c('bowled_balls')}) - sum({c('bowled_wides')}) - sum({c('bowled_no_balls')})"
    return _divide(_conceded(c), f"cast({legal} as double) / 6")


def _distinct_overs(c):
    """bowler_overs of lines that are split by match."""
    return f"nullif(count(distinct if({c('bowled_balls')} > 0, {c('overs')}, null)), 0)"


def _best_bowling(c):
    """Most wickets, then fewest runs, as one number: a struct would turn the hash aggregate into a sort."""
    unit = 1 << 32
    conceded = _minus(c("bowled_runs"), c("bowled_byes"), c("bowled_leg_byes"))
    best = f"max(if({c('bowled_balls')} > 0, {c('wickets')} * {unit} - {conceded}, null))"
    wickets = f"(-shiftright(-{best}, 32))"
    return f"if({best} is null, null, concat_ws('', {wickets}, '/', {wickets} * {unit} - {best}))"


def _at_bat(c):
    return f"{_plus(c('balls'), c('nsr_balls'))} > 0"


BAT, BOWL = ("bat",), ("bwl",)

DELIVERY_MEASURES = {
    "deliveries": Measure("innings", BAT, lambda c: _count(c, "balls")),
    "overall_runs": Measure("innings", BAT, lambda c: f"sum({c('total_runs')})"),
    "batter_runs": Measure("innings", BAT, lambda c: f"sum({c('batter_runs')})"),
    "extra_runs": Measure("innings", BAT, lambda c: _minus(f"sum({c('total_runs')})", f"sum({c('batter_runs')})")),
    "byes_runs": Measure("innings", BAT, lambda c: f"sum({c('byes')})"),
    "leg_byes_runs": Measure("innings", BAT, lambda c: f"sum({c('leg_byes')})"),
    "wides": Measure("innings", BAT, lambda c: _count(c, "wides")),
    "no_balls": Measure("innings", BAT, lambda c: _count(c, "no_balls")),
    "innings_count": Measure("innings", BAT, lambda c: _having(f"{c('balls')} > 0")),
    "over_count": Measure("over", BAT, lambda c: _having(f"{c('balls')} > 0")),
    "fours": Measure("innings", BAT, lambda c: _count(c, "fours")),
    "sixes": Measure("innings", BAT, lambda c: _count(c, "sixes")),
    "bat_innings": Measure("innings", ("bat", "nsr"), lambda c: _having(_at_bat(c))),
    "not_outs": Measure(
        "innings", ("bat", "nsr", "out"), lambda c: _minus(_having(_at_bat(c)), _having(f"{c('out_balls')} > 0"))
    ),
    "batting_average": Measure(
        "innings", ("bat", "out"), lambda c: _divide(f"sum({c('batter_runs')})", _having(f"{c('out_balls')} > 0"))
    ),
    "strike_rate": Measure(
        "innings", BAT, lambda c: _divide(f"sum({c('batter_runs')}) * 100", f"(sum({c('balls')}) - sum({c('wides')}))")
    ),
    "highest_score": Measure("innings", BAT, lambda c: f"max({c('batter_runs')})"),
    "fifties": Measure("player", BAT, lambda c: _having(f"{c('batter_runs')} between 50 and 99")),
    "hundreds": Measure("player", BAT, lambda c: _having(f"{c('batter_runs')} >= 100")),
    "first_ball_faced": Measure("innings", BAT, lambda c: f"min({c('first_faced')})"),
    "max_overs": Measure("innings", BAT, lambda c: f"max({c('last_over')})"),
    "team_wickets": Measure("innings", ("bwl_bt",), lambda c: _count(c, "team_wickets")),
    "wickets": Measure("innings", BOWL, lambda c: _count(c, "wickets")),
    "other_wickets": Measure("innings", BOWL, lambda c: _count(c, "other_wickets")),
    "conceded_runs": Measure("innings", BOWL, _conceded),
    "economy": Measure("innings", BOWL, _economy),
    "bowling_average": Measure("innings", BOWL, lambda c: _divide(_conceded(c), _count(c, "wickets"))),
    "bowl_innings": Measure("innings", BOWL, lambda c: _having(f"{c('bowled_balls')} > 0")),
    "bowler_overs": Measure("over_number", BOWL, lambda c: _having(f"{c('bowled_balls')} > 0")),
    "five_wickets": Measure("player", BOWL, lambda c: _having(f"{c('wickets')} >= 5")),
    "best_bowl_innings": Measure("player", BOWL, _best_bowling),
    "maidens": Measure("player_over", BOWL, lambda c: _having(f"{c('bowled_runs')} = 0")),
    "catches": Measure("innings", ("fld", "bwl"), lambda c: f"nullif(sum({c('catches')} + {c('own_catches')}), 0)"),
    "no_balls_bowled": Measure("innings", BOWL, lambda c: _count(c, "bowled_no_balls")),
    "wides_bowled": Measure("innings", BOWL, lambda c: _count(c, "bowled_wides")),
    "first_ball_bowled": Measure("innings", BOWL, lambda c: f"min({c('first_bowled')})"),
    "max_runs_per_over": Measure("over", BAT, lambda c: f"max({c('total_runs')})"),
}

SQUAD, BEST = ("squad",), ("best",)

SQUAD_MEASURES = {
    "matches": Measure("match", SQUAD, lambda c: _having(f"{c('members')} > 0")),
    "match_wins": Measure("match", SQUAD, lambda c: _having(c("won"))),
    "win_ratio": Measure("match", SQUAD, lambda c: _divide(_having(c("won")), _having(f"{c('members')} > 0"))),
    "won_batting_first": Measure("match", SQUAD, lambda c: _having(c("won_batting"))),
    "won_fielding_first": Measure("match", SQUAD, lambda c: _having(c("won_fielding"))),
    "seasons": Measure("match", SQUAD, lambda c: f"nullif(count(distinct if({c('members')} > 0, {c('season')}, null)), 0)"),
    "season_wins": Measure("match", SQUAD, lambda c: _having(f"{c('won')} and {c('season_last')}")),
    "player_of_match": Measure("match", BEST, lambda c: _having(f"{c('best')} > 0")),
    "last_played": Measure("match", SQUAD, lambda c: f"max({c('last_date')})"),
    "year_span": Measure(
        "match", SQUAD,
        lambda c: f"if(max({c('last_date')}) is null, null, concat_ws('', year(min({c('first_date')})), '-', year(max({c('last_date')}))))",
    ),
}

MEASURES = {**DELIVERY_MEASURES, **SQUAD_MEASURES}

# Measures that look at an innings as a whole. The others of its grain add up from finer lines as well.
WHOLE_INNINGS = {"innings_count", "bat_innings", "not_outs", "batting_average", "highest_score", "bowl_innings"}


def grains_of(measures, keys) -> dict:
    """grain -> measures, with no more line sets than needed."""
    # With the player among the keys, a player's innings is the innings; inside one innings, an
    # over's number is the over.
    same = {"player": "innings", "player_over": "over"} if "player_id" in keys else {}
    if {"match_id", "innings"} <= set(keys):
        same["over_number"] = "over"
    own = {name: same.get(MEASURES[name].grain, MEASURES[name].grain) for name in measures}
    finer = next((g for g in ("player", "over", "player_over") if g in own.values()), None)
    if finer is not None and not any(own[name] == "innings" for name in WHOLE_INNINGS & set(measures)):
        own = {name: finer if grain == "innings" else grain for name, grain in own.items()}
    grains = {}
    for name, grain in own.items():
        grains.setdefault(grain, []).append(name)
    return grains


def stack_roles(fact: DataFrame, roles: dict) -> DataFrame:
    """One row per fact row and role, with role, player_id and team_id. Empty roles make no row."""
    return _stacked(fact, [(role, {}) for role in roles], roles)


def _stacked(fact, rows, roles) -> DataFrame:
    """One row per fact row and (role, {further column: value}) of rows."""
    seats = [
        "struct(" + ", ".join([
            f"{CODES[role]} as role", f"{roles[role][0]} as player_id", f"{roles[role][1]} as team_id", *[f"{v} as {name}" for name, v in more.items()]
        ]) + ")"
        for role, more in rows
    ]
    stacked = fact.withColumn("who", F.expr(seats[0] if len(seats) == 1 else f"explode(array({', '.join(seats)}))"))
    rest = [c for c in fact.columns if c not in ("player_id", "team_id")]
    can_be_empty = ", ".join(str(CODES[r]) for r in ("out", "fld", "best"))
    return stacked.select(*rest, "who.*").filter(f"role not in ({can_be_empty}) or player_id is not null")


def _chosen(rows, players, teams):
    if players is not None:
        rows = rows.filter(F.col("player_id").isin(*players))
    if teams is not None:
        rows = rows.filter(F.col("team_id").isin(*teams))
    return rows


def delivery_lines(fact, keys, grains: dict, wanted, by_player, by_team, players=None, teams=None) -> DataFrame:
    """The wanted quantities of deliveries, a line for each keys and columns of each grain.

    grains: {grain: (roles, columns)}. Columns that are not among the keys come out as line__*, null where a grain is without
    them, and __grain says which grain a line is of.
    """
    def seat(role):
        if by_player:
            return "bwl" if role == "bwl_bt" and not by_team else role
        return WITHOUT_PLAYER.get(role, role)

    own = list(dict.fromkeys(c for _, columns in grains.values() for c in columns if c not in keys))
    rows = []
    for grain, (roles, columns) in grains.items():
        for role in dict.fromkeys(map(seat, roles)):
            # In a line's columns, the player is who plays the role.
            at = {c: ROLES[role][0] if c == "player_id" else c for c in own}
            kept = {f"line__{c}": at[c] if c in columns else f"if(false, {at[c]}, null)" for c in own}
            rows.append((role, {**kept, "__grain": str(GRAIN_CODES[grain])}))
    stacked = _chosen(_stacked(fact, rows, ROLES), players, teams)
    return stacked.groupBy(*keys, *[f"line__{c}" for c in own], "__grain").agg(*_line_sums(seat, wanted))


def squad_lines(fact, matches, keys, apart, roles, by_player, players=None, teams=None) -> DataFrame:
    """Squad rows pre-aggregated to keys + match; with matches, also the match's season and
    whether it is the last of it. apart: attributes among the caller's keys, apart from which
    seasons are looked at.
    """
    best = "best" if by_player else "squad"
    seats = {"squad": ("player_id", "team_id"), "best": ("player_of_match_id", "team_id")}
    seats = {r: seats[r] for r in dict.fromkeys(best if r == "best" else r for r in roles)}
    rows = _chosen(stack_roles(fact, seats), players, teams)
    member = f"role = {CODES['squad']}"
    won = f"{member} and match_winner_id = team_id"
    lines = rows.groupBy(*dict.fromkeys([*keys, "match_id"])).agg(*map(F.expr, [
        f"count_if({member}) as members",
        f"count_if(role = {CODES[best]}) as best",
        f"max({won}) as won",
        f"max({won} and first_bat_id = team_id) as won_batting",
        f"max({won} and first_field_id = team_id) as won_fielding",
        f"min(if({member}, match_date, null)) as first_date",
        f"max(if({member}, match_date, null)) as last_date",
    ]))
    if matches is None:
        return lines
    # The last match of a season, whichever team or player is looked at; of a match, where the keys name it, itself.
    named = [k for k in keys if k == "match_id"]
    last = matches.groupBy(*dict.fromkeys(["season", *apart, *named])).agg(F.max("match_id").alias("last_id"))
    last = last.select(F.col("last_id").alias("match_id"), F.lit(True).alias("season_last"))
    seasons = matches.select("match_id", *[] if "season" in apart else ["season"]).join(last, "match_id", "left")
    return lines.join(seasons.withColumn("season_last", F.coalesce("season_last", F.lit(False))), "match_id", "left")


def evaluate(
    star: Star, keys, measures, where: Column = None, players=None, teams=None, selector: DataFrame = None
) -> DataFrame:
    """One row per key with the asked measures; rows whose measures are all blank are left out.

    keys: any of player_id, team_id, match_id, innings, overs, balls, match_date, the date and
    the match attributes. where: a condition on the match dimension. players, teams: slicer
    values. selector: a match set (plans/selectors.py); it replaces the player and team
    filters and is combined with the others.
    """
    facts = {"d": star.deliveries, "s": star.team_players}
    matches = star.matches
    if selector is not None:
        players = teams = None
    if where is not None or selector is not None:
        matches = matches if where is None else matches.filter(where)
        chosen = matches.select("match_id")
        if selector is not None:
            # Found once, as both facts use it.
            chosen = materialize(chosen.join(selector.select("match_id"), "match_id", "left_semi"), "matches")
        matches = matches.join(chosen, "match_id", "left_semi")
        facts = {k: f.join(chosen, "match_id", "left_semi") for k, f in facts.items()}
    dates = [k for k in keys if k in DATE_ATTRIBUTES]
    facts = {k: f.withColumns({d: F.expr(DATE_ATTRIBUTES[d]) for d in dates}) if dates else f for k, f in facts.items()}
    # Match attributes are looked up per line, of which there are far fewer than balls.
    attributes = [k for k in keys if k in MATCH_ATTRIBUTES]
    line_keys = [k for k in keys if k not in attributes]

    by_player = "player_id" in keys or players is not None
    by_team = "team_id" in keys or teams is not None
    grains = grains_of(measures, keys)
    ball_grains = {
        grain: (list(dict.fromkeys(r for n in names for r in MEASURES[n].roles)), list(GRAINS[grain]))
        for grain, names in grains.items() if grain != "match"
    }
    if attributes:
        # Lines are split by match until its attributes are known; over numbers, which span matches, are told apart at the end.
        for _, columns in ball_grains.values():
            columns += ["match_id"] * ("match_id" not in columns)
    wanted, outer = {"balls": {}, "match": {}}, []
    for grain, names in grains.items():
        fact = "match" if grain == "match" else "balls"

        def column(c, grain=grain, fact=fact):
            if c in keys:
                return c
            wanted[fact][c] = True
            value = f"{fact}__{c}"
            return value if len(ball_grains) < 2 or fact == "match" else f"if(__grain = {GRAIN_CODES[grain]}, {value}, null)"

        apart = grain == "over_number" and attributes
        outer += [F.expr(f"{_distinct_overs(column) if apart else MEASURES[n].value(column)} as {n}") for n in names]
    named = matches.select("match_id", *attributes)
    line_sets = []
    if ball_grains:
        numbers = wanted["balls"].pop("overs", None)
        lines = delivery_lines(facts["d"], line_keys, ball_grains, wanted["balls"], by_player, by_team, players, teams)
        if attributes:
            of_match = "match_id" if "match_id" in keys else "line__match_id"
            lines = lines.join(named.withColumnRenamed("match_id", of_match), of_match, "left")
        own = [f"{c} as balls__{c}" for c in wanted["balls"]] + ["line__overs as balls__overs"] * bool(numbers)
        line_sets.append(lines.selectExpr(*keys, *own, "__grain"))
    if "match" in grains:
        roles = list(dict.fromkeys(r for n in grains["match"] for r in MEASURES[n].roles))
        dim = matches if {"seasons", "season_wins"} & set(grains["match"]) else None
        lines = squad_lines(facts["s"], dim, line_keys, attributes, roles, by_player, players, teams)
        if attributes:
            lines = lines.join(named, "match_id", "left")
        line_sets.append(lines.selectExpr(*keys, *[f"{c} as match__{c}" for c in wanted["match"] if c not in keys]))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), line_sets)

    result = stacked.groupBy(*keys).agg(*outer).select(*keys, *measures)
    if not keys:
        return result
    return result.filter(f"coalesce({', '.join(f'cast({n} as string)' for n in measures)}) is not null")
