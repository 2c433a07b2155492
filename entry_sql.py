"""The SQL that each registered query is checked against, for DuckDB over the sample tables.

Written from the definitions, without regard to how the Spark side gets there: windows and
joins over plain rows, no pre-aggregation.
"""

DELIVERIES = """
b as (
  select l_orderkey // 50 as match_id, 1 + l_linenumber % if(l_orderkey // 50 % 3 = 2, 4, 2) as innings, l.*,
         row_number() over (partition by l_orderkey // 50, l_linenumber % if(l_orderkey // 50 % 3 = 2, 4, 2)
           order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) as seq
  from lineitem l),
t as (
  select *, match_id % 8 + 1 as t1, (match_id % 8 + 1 + (match_id // 8) % 7) % 8 + 1 as t2,
         1 + (seq - 1) // 6 as overs, 1 + (seq - 1) % 6 as balls,
         case when l_tax = 0.08 then 1 end as wides,
         case when l_tax = 0.07 and l_linestatus = 'O' then 1 end as no_balls,
         case when l_tax = 0.06 and l_linestatus = 'F' then 1 end as byes,
         case when l_tax = 0.05 and l_linestatus = 'F' then 1 end as leg_byes,
         cast(l_quantity as int) % 7 as batter_runs
  from b),
u as (select *, if(innings % 2 = 1, t1, t2) as bt, if(innings % 2 = 1, t2, t1) as wt from t),
k as (
  select *, case when l_discount > 0.01 then null
    when l_returnflag = 'A' then if(l_suppkey % 4 = 0, 'stumped', 'caught')
    when l_returnflag = 'N' then case l_partkey % 5 when 0 then 'lbw' when 1 then 'hit wicket' else 'bowled' end
    when l_linestatus = 'F' then case l_partkey % 7 when 0 then 'obstructing the field' when 1 then 'retired hurt' else 'run out' end
    else 'caught and bowled' end as kind
  from u),
deliveries as (
  select match_id, date '1995-01-01' + cast(match_id * 3 as int) as match_date,
    bt as batting_team_id, wt as bowling_team_id, innings, overs, balls,
    bt * 11 + l_partkey % 5 as batter_id, bt * 11 + (l_partkey + 1) % 5 as non_striker_id,
    wt * 11 + 5 + overs % 6 as bowler_id, byes, leg_byes, no_balls, wides, batter_runs,
    batter_runs + coalesce(wides, 0) + coalesce(no_balls, 0) + coalesce(byes, 0) + coalesce(leg_byes, 0) as total_runs,
    kind as wicket_kind,
    case when kind is not null then bt * 11 + l_partkey % 5 end as player_out_id,
    case when kind in ('caught', 'stumped', 'run out') then wt * 11 + l_suppkey % 11 end as fielder_id
  from k)"""

MATCHES = """
sides as (
  select match_id, any_value(match_date) as match_date,
         max(case innings when 1 then batting_team_id end) as t1, max(case innings when 2 then batting_team_id end) as t2,
         sum(if(innings % 2 = 1, total_runs, 0)) as r1, sum(if(innings % 2 = 0, total_runs, 0)) as r2,
         min(case when batter_runs = 6 then batter_id end) as player_of_match_id
  from deliveries group by match_id),
matches as (
  select match_id, match_date, cast(year(match_date) as varchar) as season, 'Event_' || (match_id % 5) as event_name,
    'Venue_' || (match_id % 11) as venue,
    case match_id % 3 when 0 then 'T20' when 1 then 'ODI' else 'Test' end as match_type,
    case when match_id % 17 = 0 then 'no result' when match_id % 13 = 0 then 'tie' end as match_result,
    case when match_id % 17 = 0 then null when match_id % 13 = 0 then t2 when r1 >= r2 then t1 else t2 end as match_winner_id,
    case when match_id % 17 <> 0 and match_id % 13 <> 0 and r1 >= r2 then cast(r1 - r2 as varchar) end as match_won_by_runs,
    case when match_id % 17 <> 0 and match_id % 13 <> 0 and r1 < r2 then cast(1 + match_id % 9 as varchar) end as match_won_by_wickets,
    case when match_id % 19 = 0 then '1' end as match_won_by_innings,
    case when match_id % 7 = 0 then 'D/L' end as match_result_method,
    case when match_id % 2 = 0 then t1 else t2 end as toss_winner_id,
    case when match_id % 2 = 0 then 'bat' else 'field' end as toss_decision,
    t1 as first_bat_id, t2 as first_field_id, player_of_match_id
  from sides)"""

SQUADS = """
team_players as (
  select m.match_id, x.team_id, x.team_id * 11 + p.i as player_id, m.match_date, m.match_winner_id, m.toss_winner_id,
    m.player_of_match_id, m.first_bat_id, m.first_field_id
  from matches m, lateral (select m.first_bat_id as team_id union all select m.first_field_id) x, range(11) p(i)),
players as (select i as player_id, 'Player_' || i as player_name from range(11, 99) p(i)),
teams as (select i as team_id, 'Team_' || i as team from range(1, 9) p(i))"""

STAR = "with" + ",".join([DELIVERIES, MATCHES, SQUADS])

JOBS = """
with j as (
  select cast(event_id as varchar) as job_id,
    nullif(cast(first_value(event_id) over (partition by user_id, cast(ts as date) order by ts, event_id) as varchar),
           cast(event_id as varchar)) as parent_job_id,
    event_type || '_' || user_id as job_name, event_type as job_category, ts as start_time,
    case when event_type <> 'error' then ts + to_seconds(cast(floor(value * 1000) as bigint)) end as end_time,
    case event_type when 'error' then 'Failed' when 'signup' then 'InProgress' else 'Completed' end as status,
    cast(null as varchar) as message
  from events),
jobs as (
  select *, cast(epoch(date_trunc('second', coalesce(end_time, timestamp '2024-02-15')))
                 - epoch(date_trunc('second', start_time)) as bigint) as sec
  from j)"""

CREDITED = "('bowled', 'caught', 'caught and bowled', 'lbw', 'stumped', 'hit wicket')"
OTHER = "('obstructing the field', 'run out')"


def _keyed(keys, bat_keys, out_keys, nsr_keys, bowl_keys, fld_keys, bowl_bt_keys,
           outs_only="", held_only="", d="deliveries", w="deliveries"):
    """CTEs with every delivery measure by the given keys; *_keys say what plays the key in each role.

    d and w are the rows a batting and a bowling role sees; outs_only and held_only drop balls nobody fills the role on.
    """
    ks = ", ".join(f"k{i}" for i in range(len(keys)))

    def cols(exprs):
        return ", ".join(f"{e} as k{i}" for i, e in enumerate(exprs))

    return f"""
bat as (
  select {cols(bat_keys)}, count(*) as deliveries, sum(total_runs) as overall_runs, sum(batter_runs) as batter_runs,
    sum(byes) as byes_runs, sum(leg_byes) as leg_byes_runs, count(*) filter (wides <> 0) as wides,
    count(*) filter (no_balls <> 0) as no_balls, count(*) filter (batter_runs = 4) as fours,
    count(*) filter (batter_runs = 6) as sixes, count(distinct (match_id, innings)) as innings_count,
    count(distinct (match_id, innings, overs)) as over_count, min((overs - 1) * 6 + balls) as first_ball_faced,
    max(overs) as max_overs
  from {d} group by all),
bat_i as (
  select {ks}, max(r) as highest_score from
    (select {cols(bat_keys)}, match_id, innings, sum(batter_runs) as r from {d} group by all) group by all),
bat_p as (
  select {ks}, count(*) filter (r between 50 and 99) as fifties, count(*) filter (r >= 100) as hundreds from
    (select {cols(bat_keys)}, match_id, innings, batter_id, sum(batter_runs) as r from {d} group by all) group by all),
bat_o as (
  select {ks}, max(r) as max_runs_per_over from
    (select {cols(bat_keys)}, match_id, innings, overs, sum(total_runs) as r from {d} group by all) group by all),
both_ends as (
  select {ks}, count(distinct (match_id, innings)) as bat_innings from
    (select {cols(bat_keys)}, match_id, innings from {d} union
     select {cols(nsr_keys)}, match_id, innings from {d}) group by all),
outs as (
  select {cols(out_keys)}, count(distinct (match_id, innings)) as out_innings from {d} {outs_only} group by all),
bt_w as (
  select {cols(bowl_bt_keys)}, count(*) as team_wickets from {w} where wicket_kind in {CREDITED} group by all),
bowl as (
  select {cols(bowl_keys)}, count(*) as n, count(*) filter (wicket_kind in {CREDITED}) as wickets,
    count(*) filter (wicket_kind in {OTHER}) as other_wickets,
    sum(total_runs) - coalesce(sum(byes), 0) - coalesce(sum(leg_byes), 0) as conceded_runs,
    count(distinct (match_id, innings)) as bowl_innings, count(distinct overs) as bowler_overs,
    count(*) filter (no_balls <> 0) as no_balls_bowled, count(*) filter (wides <> 0) as wides_bowled,
    min((overs - 1) * 6 + balls) as first_ball_bowled,
    count(*) filter (wicket_kind = 'caught and bowled') as own_catches
  from {w} group by all),
bowl_p as (
  select {ks}, count(*) filter (w >= 5) as five_wickets,
    arg_max(w || '/' || r, (w, -r)) as best_bowl_innings
  from (select {cols(bowl_keys)}, match_id, innings, bowler_id, count(*) filter (wicket_kind in {CREDITED}) as w,
          sum(total_runs) - coalesce(sum(byes), 0) - coalesce(sum(leg_byes), 0) as r
        from {w} group by all) group by all),
bowl_m as (
  select {ks}, count(*) filter (r = 0) as maidens from
    (select {cols(bowl_keys)}, match_id, innings, bowler_id, overs, sum(total_runs) as r from {w} group by all) group by all),
fld as (
  select {cols(fld_keys)}, count(*) as held from {w} where wicket_kind = 'caught' {held_only} group by all),
ids as (
  select {ks} from bat union select {ks} from both_ends union select {ks} from outs union select {ks} from bowl
  union select {ks} from fld),
dm as (
  select {", ".join(f"ids.k{i} as {k}" for i, k in enumerate(keys))},
    deliveries, cast(overall_runs as bigint) as overall_runs, cast(batter_runs as bigint) as batter_runs,
    cast(overall_runs - batter_runs as bigint) as extra_runs, cast(byes_runs as bigint) as byes_runs,
    cast(leg_byes_runs as bigint) as leg_byes_runs, nullif(wides, 0) as wides, nullif(no_balls, 0) as no_balls,
    innings_count, over_count, nullif(fours, 0) as fours, nullif(sixes, 0) as sixes, bat_innings,
    case when bat_innings is not null or out_innings is not null
         then coalesce(bat_innings, 0) - coalesce(out_innings, 0) end as not_outs,
    cast(batter_runs as double) / out_innings as batting_average,
    cast(batter_runs * 100 as double) / nullif(deliveries - wides, 0) as strike_rate,
    cast(highest_score as bigint) as highest_score, nullif(fifties, 0) as fifties, nullif(hundreds, 0) as hundreds,
    first_ball_faced, max_overs, team_wickets, nullif(wickets, 0) as wickets, nullif(other_wickets, 0) as other_wickets,
    cast(conceded_runs as bigint) as conceded_runs,
    cast(conceded_runs as double) / nullif(cast(n - no_balls_bowled - wides_bowled as double) / 6, 0) as economy,
    cast(conceded_runs as double) / nullif(wickets, 0) as bowling_average, bowl_innings, bowler_overs,
    nullif(five_wickets, 0) as five_wickets, best_bowl_innings, nullif(maidens, 0) as maidens,
    nullif(coalesce(held, 0) + coalesce(own_catches, 0), 0) as catches,
    nullif(no_balls_bowled, 0) as no_balls_bowled, nullif(wides_bowled, 0) as wides_bowled, first_ball_bowled,
    cast(max_runs_per_over as bigint) as max_runs_per_over
  from ids {" ".join(f"left join {c} using ({ks})" for c in
      ["bat", "bat_i", "bat_p", "bat_o", "both_ends", "outs", "bt_w", "bowl", "bowl_p", "bowl_m", "fld"])})"""


def _by_player(extra=(), **rows):
    role = [[*extra, c] for c in ("batter_id", "player_out_id", "non_striker_id", "bowler_id", "fielder_id", "bowler_id")]
    return _keyed(
        [*extra, "player_id"], *role,
        outs_only="where player_out_id is not null", held_only="and fielder_id is not null", **rows,
    )


def _by_plain(keys, **rows):
    return _keyed(keys, keys, keys, keys, keys, keys, keys, **rows)


def _by_team(extra=()):
    bt, wt = [*extra, "batting_team_id"], [*extra, "bowling_team_id"]
    return _keyed([*extra, "team_id"], bt, bt, bt, wt, wt, bt)


def _squad_measures(key_list, team_filter=""):
    """sm: squad measures by key. The players' best-of-match count is joined by player."""
    ks = ", ".join(key_list)
    return f"""
last as (select season, max(match_id) as match_id from matches group by season),
tp as (
  select tp.*, m.season, year(tp.match_date) as year, m.event_name, m.match_type, l.match_id is not null as season_last
  from team_players tp join matches m using (match_id) left join last l on l.match_id = tp.match_id {team_filter}),
sm as (
  select {ks}, count(distinct match_id) as matches,
    nullif(count(distinct match_id) filter (match_winner_id = team_id), 0) as match_wins,
    cast(nullif(count(distinct match_id) filter (match_winner_id = team_id), 0) as double)
      / count(distinct match_id) as win_ratio,
    nullif(count(distinct match_id) filter (match_winner_id = team_id and first_bat_id = team_id), 0) as won_batting_first,
    nullif(count(distinct match_id) filter (match_winner_id = team_id and first_field_id = team_id), 0) as won_fielding_first,
    count(distinct season) as seasons,
    nullif(count(distinct season) filter (match_winner_id = team_id and season_last), 0) as season_wins,
    max(match_date) as last_played, min(year) || '-' || max(year) as year_span
  from tp group by all),
best as (select player_of_match_id as player_id, count(distinct match_id) as player_of_match from tp group by all)"""


PLAYER_COLUMNS = (
    "matches, year_span, bat_innings, not_outs, batter_runs, highest_score, batting_average, strike_rate, hundreds, "
    "fifties, fours, sixes, bowl_innings, wickets, best_bowl_innings, five_wickets, bowling_average, economy, catches, "
    "player_of_match"
)

PLAYER_STATS = f"""{STAR}, {_by_player()}, {_squad_measures(["player_id"])}
select player_id, player_name, {PLAYER_COLUMNS}
from players join sm using (player_id) left join dm using (player_id) left join best using (player_id)"""


def _player(columns, extra=""):
    first = columns.split(", ")
    some = " or ".join(f"{c} is not null" for c in first)
    return f"{STAR}, {_by_player()} select player_id, {columns} from dm where player_id is not null and ({some}) {extra}"


ELAPSED = """case when sec < 60 then sec || ' sec'
  when sec < 3600 then (sec // 60) || ' min ' || (sec % 60) || ' sec'
  when sec < 86400 then (sec // 3600) || ' hrs ' || ((sec % 3600) // 60) || ' min'
  else (sec // 86400) || ' day ' || ((sec % 86400) // 3600) || ' hrs ' || ((sec % 86400 % 3600) // 60) || ' min' end"""


def _elapsed_measure(s):
    return f"""concat(case when {s} // 86400 > 0 then ({s} // 86400) || ' day ' end,
  case when {s} // 3600 % 24 > 0 then ({s} // 3600 % 24) || 'hrs ' end,
  case when {s} // 60 % 60 > 0 then ({s} // 60 % 60) || ' min ' end, case when {s} % 60 > 0 then ({s} % 60) || ' sec' end)"""


MONITOR = f"""
      select b.job_id, b.job_name, b.job_category, b.start_time, b.end_time, b.status, b.message, p.job_name as parent_job_name,
        {_elapsed_measure("b.sec")} as time_elapsed, b.sec as duration_sec
      from jobs b left join jobs p on p.job_id = b.parent_job_id"""

LATEST = """
moment as (select max(start_time) as m from jobs where job_id in (select parent_job_id from jobs)),
heads as (select job_id from jobs where start_time = (select m from moment))"""

STATUS = """case {k} when 'caught' then concat('c ', {f}, ' b ', {b}) when 'caught and bowled' then concat('c & b ', {b})
  when 'run out' then concat('run out (', {f}, ')') when 'bowled' then concat('b ', {b})
  when 'stumped' then concat('st ', {f}, ' b ', {b}) when 'lbw' then concat('lbw b ', {b})
  when 'hit wicket' then concat('hit wkt b ', {b}) else {k} end"""

MATCH_TEXT = f"""
mt as (
  select m.match_id, season, match_date,
    concat(case when match_result is not null then concat(match_result, case when w.team is not null then ' (' || w.team || ' won)' end)
      else concat(w.team, ' won by ', coalesce(match_won_by_runs, match_won_by_wickets),
        case when match_won_by_runs is null then ' wickets' else ' runs' end,
        case when match_won_by_innings is not null then ' and ' || match_won_by_innings || ' innings' end) end,
      case when match_result_method is not null then ' (' || match_result_method || ')' end) as match_result_text,
    tw.team || ' won the toss and elected to ' || toss_decision as toss_result,
    p.player_name as man_of_the_match, event_name || ', ' || season as event_card,
    venue || ', ' || strftime(match_date, '%d-%b-%Y') as venue_card
  from matches m left join teams w on w.team_id = match_winner_id left join teams tw on tw.team_id = toss_winner_id
  left join players p on p.player_id = player_of_match_id)"""

OVERS = f"""
ov as (
  select match_id, innings, overs, sum(total_runs) as runs, count(*) filter (wicket_kind in {CREDITED}) as w,
    count(wicket_kind) as fallen
  from deliveries group by all),
run as (
  select *, sum(runs) over x as cum, sum(w) over x as cum_w, count(*) over x as n
  from ov window x as (partition by match_id, innings order by overs)),
axes as (
  select o.match_id, max(o.runs) as max_runs_per_over,
    coalesce(case any_value(match_type) when 'T20' then 20 when 'ODI' then 50 end, max(overs)) as total_overs
  from ov o join matches using (match_id) group by all),
width as (select match_id, max(balls) as total_balls_per_over from deliveries group by all)"""

FALLS = f"""
balls as (
  select *, (overs - 1) * 6 + balls as ball_no,
    sum(total_runs) over (partition by match_id, innings order by (overs - 1) * 6 + balls) as score,
    nullif(count(*) filter (wicket_kind in {CREDITED} or wicket_kind in {OTHER})
      over (partition by match_id, innings order by (overs - 1) * 6 + balls), 0) as wicket_no,
    count(wides) over (partition by match_id, innings, overs order by balls)
      + count(no_balls) over (partition by match_id, innings, overs order by balls) as illegal
  from deliveries),
falls as (
  select match_id, innings, ball_no, cast(score as bigint) as score, cast(wicket_no as bigint) as wicket_no,
    player_name as player_out,
    concat(score, '-', wicket_no, ' (', player_name, ', ', overs - 1, '.', b.balls - illegal, ')') as fall
  from balls b left join players on player_id = player_out_id where wicket_kind is not null)"""

def _top(keys, value):
    return f"""scores as (select {keys}, {value} as v from deliveries group by all),
picked as (select distinct match_id from scores where v is not distinct from (select max(v) from scores))"""


WICKETS = f"nullif(count(*) filter (wicket_kind in {CREDITED}), 0)"

PICKED = {
    "all_matches": "picked as (select distinct match_id from team_players where team_id = 3)",
    "highest_score": _top("match_id", "sum(batter_runs)"),
    "highest_wickets": _top("match_id", WICKETS),
    "hundreds": f"""picked as (select distinct match_id from (select match_id, batter_id, sum(batter_runs) as r
      from deliveries group by all) where r >= 100)""",
    "five_wickets": f"""picked as (select distinct match_id from (select match_id, bowler_id, {WICKETS} as w
      from deliveries group by all) where w >= 5)""",
    "highest_sixes": _top("match_id", "nullif(count(*) filter (batter_runs = 6), 0)"),
    "highest_fours": _top("match_id", "nullif(count(*) filter (batter_runs = 4), 0)"),
    "highest_runs_in_over": _top("match_id, innings, overs", "sum(total_runs)"),
    "highest_wickets_in_over": _top("match_id, innings, overs", WICKETS),
    "tied": "picked as (select match_id from matches where match_result = 'tie')",
}

SELECTED = """
select match_id, batting_team_id as team_id, count(*) as deliveries, cast(sum(total_runs) as bigint) as overall_runs,
  nullif(count(*) filter (batter_runs = 6), 0) as sixes
from deliveries where match_id in (select match_id from picked) group by all"""

# Documents: one a match; ids of players and teams follow the order of their names.
DOCS = f"""{STAR},
named as (select row_number() over (order by player_name) as pid, player_id, player_name from players
          where player_id in (select player_id from team_players)),
named_teams as (select row_number() over (order by team) as tid, team_id, team from teams
                where team_id in (select team_id from team_players)),
parts as (select distinct match_id, match_id as doc_id from deliveries)"""

# The match documents as JSON texts. A member without a value is left out.
FILES = """
balls as (
  select match_id, innings, overs, balls, '{"batter":"Player_' || batter_id || '","bowler":"Player_' || bowler_id
    || '","non_striker":"Player_' || non_striker_id || '","runs":{"batter":' || batter_runs || ',"total":' || total_runs || '},"extras":{'
    || concat_ws(',', '"byes":' || byes, '"legbyes":' || leg_byes, '"noballs":' || no_balls, '"wides":' || wides) || '}'
    || coalesce(',"wickets":[{"kind":"' || wicket_kind || '","player_out":"Player_' || player_out_id || '"'
      || coalesce(',"fielders":[{"name":"Player_' || fielder_id || '"}]', '') || '}]', '') || '}' as ball
  from deliveries),
over_texts as (
  select match_id, innings, overs, '{"deliveries":[' || string_agg(ball, ',' order by balls) || ']}' as text from balls group by all),
innings_texts as (
  select match_id, o.innings, '{"team":"Team_' || any_value(batting_team_id) || '","overs":[' || any_value(texts) || ']}' as text
  from (select match_id, innings, string_agg(text, ',' order by overs) as texts from over_texts group by all) o
  join deliveries using (match_id, innings) group by match_id, o.innings),
all_innings as (select match_id, '[' || string_agg(text, ',' order by innings) || ']' as innings from innings_texts group by match_id),
infos as (
  select match_id, '{"dates":["' || strftime(match_date, '%Y-%m-%d') || '"],"gender":"' || if(match_id % 4 = 1, 'female', 'male')
    || '","season":"' || season || '","event":{"name":"' || event_name || '",' || if(match_id % 6 = 2, '"group":"Group ' || match_id % 2 || '",', '')
    || '"match_number":' || match_id % 100 || '},' || if(match_id % 5 = 3, '', '"city":"City_' || match_id % 11 || '",')
    || '"venue":"' || venue || '","team_type":"' || if(match_id % 3 = 0, 'club', 'international') || '","match_type":"' || match_type
    || '","officials":{"umpires":["U1","U_' || season || '"]},"outcome":{'
    || concat_ws(',', case when match_result is null then '"winner":"Team_' || match_winner_id || '"' end, '"result":"' || match_result || '"',
      case when match_result = 'tie' then '"eliminator":"Team_' || match_winner_id || '"' end, '"method":"' || match_result_method || '"',
      '"by":{' || concat_ws(',', '"runs":' || match_won_by_runs, '"wickets":' || match_won_by_wickets, '"innings":' || match_won_by_innings) || '}')
    || '},"toss":{"winner":"Team_' || toss_winner_id || '","decision":"' || toss_decision || '"}'
    || coalesce(',"player_of_match":["Player_' || player_of_match_id || '"]', '') || ',"players":{'
    || (select string_agg('"Team_' || team || '":[' || (select string_agg('"Player_' || (team * 11 + i) || '"', ',' order by i) from range(11) p(i)) || ']', ',' order by pos)
        from (select first_bat_id as team, 1 as pos union all select first_field_id, 2)) || '}}' as info
  from matches)"""

SQL = {
    "player_stats": PLAYER_STATS,
    "team_stats": f"""{STAR}, {_squad_measures(["team_id"])}
      select team_id, team, year_span, matches, match_wins, win_ratio, seasons, season_wins from sm join teams using (team_id)""",
    "kpi_cards": f"""{STAR}
      select (select count(distinct match_id) from team_players) as matches,
        (select nullif(count(*), 0) from (select 1 from deliveries group by match_id, innings, batter_id having sum(batter_runs) >= 100)) as hundreds,
        (select nullif(count(*), 0) from (select 1 from deliveries group by match_id, innings, batter_id having sum(batter_runs) between 50 and 99)) as fifties,
        (select nullif(count(*), 0) from (select 1 from deliveries where wicket_kind in {CREDITED} group by match_id, innings, bowler_id having count(*) >= 5)) as five_wickets,
        (select nullif(count(*), 0) from deliveries where batter_runs = 6) as sixes,
        (select nullif(count(*), 0) from deliveries where batter_runs = 4) as fours""",
    "wins_by_year": f"""{STAR}
      select cast(year(match_date) as int) as year, count(distinct match_id) as match_wins from team_players
      where match_winner_id = team_id group by all""",
    "wins_by_month": f"""{STAR}
      select cast(month(match_date) as int) as month_number, strftime(match_date, '%b') as month, count(distinct match_id) as matches,
        nullif(count(distinct match_id) filter (match_winner_id = team_id), 0) as match_wins from team_players group by all""",
    "match_results": f"""{STAR}, {MATCH_TEXT},
      tp as (select match_id, string_agg(team, chr(10) || ' vs ' || chr(10) order by team) as teams_played
             from (select distinct match_id, team_id from team_players) join teams using (team_id) group by all),
      fs as (select match_id, string_agg(line, chr(10) order by innings, team) as final_score from
             (select match_id, innings, team, concat(team, ': ', r, '-', w) as line from
               (select match_id, innings, team, sum(total_runs) as r, count(wicket_kind) as w
                from deliveries join teams on team_id = batting_team_id group by all)) group by all)
      select match_id, season, match_date, teams_played, toss_result, final_score, match_result_text
      from mt join tp using (match_id) left join fs using (match_id)""",
    "match_cards": f"{STAR}, {MATCH_TEXT} select match_id, match_result_text, man_of_the_match, event_card, venue_card from mt",
    "slicer_values": f"""{STAR}
      select 'team' as slicer, team as value from teams where team_id in (select team_id from team_players)
      union all select 'player', player_name from players where player_id in (select player_id from team_players)
      union all select distinct 'event', event_name from matches
      union all select distinct 'match type', match_type from matches
      union all select distinct 'season', season from matches""",
    "player_teams": f"""{STAR},
      c as (select player_id, team, count(distinct match_id) as n from team_players join teams using (team_id) group by all)
      select player_id, string_agg(concat(team, ' (', n, ')'), ', ' order by n desc, team) as player_teams from c group by all""",
    "batting_leaderboard": _player("innings_count, batter_runs, deliveries, wides, strike_rate, batting_average, highest_score, fours, sixes"),
    "bat_innings_not_outs": _player("bat_innings, not_outs"),
    "milestones_50_100": _player("fifties, hundreds"),
    "bowling_leaderboard": _player("bowl_innings, wickets, other_wickets, conceded_runs, economy, bowling_average, no_balls_bowled, wides_bowled"),
    "five_wicket_hauls": _player("five_wickets"),
    "best_bowling": _player("best_bowl_innings"),
    "maidens": _player("maidens"),
    "fielding_catches": _player("catches"),
    "player_of_match": f"{STAR}, {_squad_measures(['player_id'])} select player_id, player_of_match from best where player_id is not null",
    "innings_measures": f"""{STAR}, {_by_plain(["match_id", "innings"])}
      select match_id, innings, deliveries, overall_runs, batter_runs, extra_runs, byes_runs, leg_byes_runs, wides,
        no_balls, innings_count, over_count, fours, sixes from dm""",
    "team_measures": f"{STAR}, {_by_team()} select * from dm",
    "season_winners": f"""{STAR}, {_squad_measures(["team_id"])}
      select team_id, season_wins, won_batting_first, won_fielding_first, last_played from sm
      where season_wins is not null or won_batting_first is not null or won_fielding_first is not null or last_played is not null""",
    "filtered_measures": f"""{STAR}
      select batter_id as player_id, cast(sum(batter_runs) as bigint) as batter_runs, count(*) as deliveries,
        nullif(count(*) filter (batter_runs = 4), 0) as fours
      from deliveries join matches using (match_id)
      where matches.match_date between date '1995-03-01' and date '1996-06-30' and match_type in ('T20', 'Test')
        and batting_team_id in (2, 5) group by all""",
    "batting_scorecard": f"""{STAR},
      p as (
        select match_id, innings, batter_id as pid, total_runs, batter_runs, (overs - 1) * 6 + balls as bn, wides, 1 as ball,
          null as kind, null as bowler, null as fielder from deliveries
        union all select match_id, innings, non_striker_id, null, null, null, null, null, null, null, null from deliveries
        union all select match_id, innings, player_out_id, null, null, null, null, null, wicket_kind, bowler_id, fielder_id
          from deliveries where player_out_id is not null),
      l as (
        select match_id, innings, pid, sum(batter_runs) as r, count(ball) as n, count(*) filter (batter_runs = 4) as fours,
          count(*) filter (batter_runs = 6) as sixes, count(wides) as w, min(bn) as first, max(kind) as kind,
          max(bowler) as bowler, max(fielder) as fielder from p group by all),
      tot as (
        select match_id, innings, sum(total_runs) as tr, sum(batter_runs) as br, count(*) as n, count(*) filter (batter_runs = 4) as fours,
          count(*) filter (batter_runs = 6) as sixes, count(wides) as w, min((overs - 1) * 6 + balls) as first
        from deliveries group by all)
      select match_id, innings, 'batter' as row, l.pid as player_id, pl.player_name, first as first_ball_faced,
        coalesce({STATUS.format(k="kind", f="fl.player_name", b="bw.player_name")}, 'not out') as wicket_status,
        cast(r as bigint) as runs, nullif(n, 0) as deliveries, nullif(fours, 0) as fours, nullif(sixes, 0) as sixes,
        cast(r * 100 as double) / nullif(n - w, 0) as strike_rate
      from l left join players pl on pl.player_id = l.pid left join players bw on bw.player_id = l.bowler
        left join players fl on fl.player_id = l.fielder
      union all select match_id, innings, 'extras', -1, 'Extras', 999, null, cast(tr - br as bigint), null, null, null, null from tot
      union all select match_id, innings, 'total', null, null, first, null, cast(tr as bigint), n, nullif(fours, 0), nullif(sixes, 0),
        cast(br * 100 as double) / nullif(n - w, 0) from tot""",
    "bowling_scorecard": f"""{STAR}, {_by_player(["match_id", "innings"])}
      select match_id, innings, player_id, player_name, first_ball_bowled, wickets, bowler_overs, maidens, conceded_runs,
        no_balls_bowled, wides_bowled, economy from dm join players using (player_id) where first_ball_bowled is not null""",
    "fall_of_wickets_rows": f"{STAR}, {FALLS} select * from falls",
    "fall_of_wickets": f"""{STAR}, {FALLS}
      select match_id, innings, string_agg(fall, ', ' order by wicket_no nulls first, ball_no) as fall_of_wickets
      from falls group by all""",
    "did_not_bat": f"""{STAR},
      bats as (select match_id, innings, batter_id as player_id from deliveries union select match_id, innings, non_striker_id from deliveries),
      full_team as (select distinct b.match_id, b.innings, sq.player_id from bats b
        join team_players mine on mine.match_id = b.match_id and mine.player_id = b.player_id
        join team_players sq on sq.match_id = b.match_id and sq.team_id = mine.team_id),
      rest as (select * from full_team except select * from bats)
      select match_id, innings, string_agg(player_name, ', ' order by player_name) as did_not_bat
      from rest join players using (player_id) group by all""",
    "innings_header": f"""{STAR},
      l as (select match_id, innings, max(overs) as last_over, sum(total_runs) as r, count(distinct overs) as n,
              count(*) filter (wicket_kind in {CREDITED} or wicket_kind in {OTHER}) as w,
              max((overs - 1) * 6 + balls) as lb, max(team) as team
            from deliveries join teams on team_id = batting_team_id group by all),
      i as (select l.match_id, l.innings, count(wides) + count(no_balls) as bad from l join deliveries d
              on d.match_id = l.match_id and d.innings = l.innings and d.overs = l.last_over group by all),
      h as (select *, (cast(r as bigint) * 200 + n) // (2 * n) as rr from l join i using (match_id, innings))
      select match_id, innings, team,
        concat(r, '-', w, ' (', (lb - bad) // 6, '.', (lb - bad) % 6, ' Ov, RR: ', case when rr >= 100 then rr // 100 end, '.',
          lpad(cast(rr % 100 as varchar), 2, '0'), ', Inn: ', innings, ')') as score, team || ': ' || score as header from h""",
    "manhattan": f"""{STAR}, {OVERS},
      bn as (select match_id, innings, overs, max(player_name) as bowler_name from deliveries join players on player_id = bowler_id group by all)
      select match_id, innings, overs, cast(runs as bigint) as overall_runs, nullif(w, 0) as wickets, cast(cum as double) / n as run_rate,
        bowler_name, cast(max_runs_per_over as bigint) as max_runs_per_over, total_overs
      from run join bn using (match_id, innings, overs) join axes using (match_id)""",
    "worm": f"""{STAR}, {OVERS}
      select match_id, innings, overs, cast(cum as bigint) as cumulative_runs, cast(nullif(cum_w, 0) as bigint) as cumulative_wickets,
        case when fallen > 0 then cast(cum as bigint) end as wicket_mark, wicket_mark - 1 as mark_low, wicket_mark + 1 as mark_high,
        case innings when 1 then '#41A4FF' when 2 then '#12239E' when 3 then '#A666B0' when 4 then '#E8D166' end as innings_colour from run""",
    "worm_tooltip": f"""{STAR}
      select match_id, innings, team_id, team, max(overs) as max_overs, cast(sum(total_runs) as bigint) as cumulative_runs,
        nullif(count(*) filter (wicket_kind in {CREDITED}), 0) as team_wickets, team_wickets as cumulative_wickets
      from deliveries join teams on team_id = batting_team_id group by all""",
    "ball_map": f"""{STAR}, {OVERS}
      select match_id, innings, overs, balls, total_runs as overall_runs, case when wicket_kind in {CREDITED} then 1 end as wickets,
        wides, no_balls, bw.player_name as bowler_name, bt.player_name as batsman_name,
        po.player_name || ' - ' || {STATUS.format(k="wicket_kind", f="fl.player_name", b="bw.player_name")} as wicket_details,
        case when wicket_kind is not null then '#E66C37' else case total_runs when 0 then '#CCCCCC' when 1 then '#B9DBFB'
          when 2 then '#A0D1FF' when 3 then '#70BBFF' when 4 then '#41A4FF' when 5 then '#0D6ABF' when 6 then '#094780' end end as colour,
        total_balls_per_over, total_overs
      from deliveries left join players bw on bw.player_id = bowler_id left join players bt on bt.player_id = batter_id
        left join players po on po.player_id = player_out_id left join players fl on fl.player_id = fielder_id
        join axes using (match_id) join width using (match_id)""",
    **{f"selector_{name}": f"{STAR}, {picked} {SELECTED}" for name, picked in PICKED.items()},
    "job_report": f"""{JOBS},
      lp as (select job_id, case when row_number() over (order by start_time desc, job_id desc) = 1 then 'Y' else 'N' end as is_latest_parent
             from jobs where parent_job_id is null and job_id in (select parent_job_id from jobs where parent_job_id is not null))
      select b.job_category, b.job_name, p.job_name as parent_job_name, is_latest_parent, b.start_time, b.end_time,
        {ELAPSED.replace("sec ", "b.sec ").replace("(sec", "(b.sec")} as time_elapsed, b.status, b.message, b.sec as duration_sec, b.job_id, b.parent_job_id
      from jobs b left join jobs p on p.job_id = b.parent_job_id
        left join lp on lp.job_id = coalesce(b.parent_job_id, b.job_id)""",
    "job_monitor": f"{JOBS} {MONITOR}",
    "job_monitor_latest_run": f"""{JOBS}, {LATEST}
      select * from ({MONITOR}) where job_id in (select job_id from heads)
        or job_id in (select job_id from jobs where parent_job_id in (select job_id from heads))""",
    "job_latest_parent": f"""{JOBS}, {LATEST}
      select job_id from heads union select job_id from jobs where parent_job_id in (select job_id from heads)""",
    "jobs_by_status": f"{JOBS} select status, count(*) as job_count from jobs where parent_job_id is not null group by all",
    "duration_by_category": f"""{JOBS}
      select job_category, cast(sum(sec) as bigint) as duration_sec from jobs where parent_job_id is not null group by all""",
    "job_cards": f"""{JOBS},
      s as (select cast(sum(sec) filter (parent_job_id is null) as bigint) as rs, count(*) filter (parent_job_id is not null) as n,
              case when count(distinct status) = 1 then max(status) end as st, cast(sum(sec) filter (job_category <> 'Orchestrator') as bigint) as own from jobs)
      select {_elapsed_measure("rs")} as overall_duration, nullif(n, 0) as overall_jobs, st as current_status, own as own_duration_sec from s""",
    "staged_matches": f"{DOCS} select doc_id as match_id, doc_id || '.json' as file_name from parts",
    "compacted_table": f"{STAR} select match_id, count(*) as n, cast(sum(total_runs) as bigint) as runs from deliveries group by all",
    "match_files": f"""{STAR}, {FILES}
      select match_id, match_id || '.json' as file_name, info as match_info, innings as match_innings, true as stamped, null as problem
      from infos join all_innings using (match_id)
      union all select null, unnest(['900001.json', '900002.json', 'notes.json']), null, null, null,
        unnest(['not a JSON object', 'no innings', 'no number in the name'])""",
    "catalog_listing": """
      select 't_customer' as table_name, true as schema_listed, count(*) as n from customer
      union all select 't_order', true, count(*) from orders where o_orderstatus in ('F', 'O')
      union all select 't_literal', true, 2 union all select 't_empty', true, 0""",
    "gate_files": f"""{STAR}
      select match_id || '.json' as file_name from matches where match_id % 2 = 1
      union all select unnest(['900001.json', '900002.json', 'notes.json'])""",
    "load_log": f"""{DOCS},
      steps as (select unnest(['t_dim_player', 't_dim_team', 't_dim_match', 't_dim_date', 't_fact_team_players', 't_fact_deliveries']) as name),
      logged as (
        select 'Load' as name, 'Orchestrator' as category, null as parent, null as parent_job_name, 'Completed' as status, unnest([null, 'No new data']) as message
        union all select 'Gate Staging', 'Ingest to Raw', unnest(['first', 'second']), 'Load', 'Completed', unnest([null, 'No new data'])
        union all select 'Stage Documents', 'Ingest to Raw', 'first', 'Load', 'Completed', null
        union all select name, 'Build Star Schema', 'first', 'Load', 'Completed', null from steps
        union all select 'Refresh', 'Adhoc', 'second', 'Load', 'Failed', 'refresh failed'),
      stored as (
        select 't_dim_match' as name, (select count(*) from matches) as n union all select 't_dim_team', (select count(*) from named_teams)
        union all select 't_dim_player', (select count(*) + 1 from named) union all select 't_fact_team_players', (select count(*) from team_players)
        union all select 't_fact_deliveries', (select count(*) from deliveries) union all select 't_refused_file', 3
        union all select 't_dim_date', (select 1 + date_diff('day', make_date(year(min(match_date)), 1, 1), make_date(year(max(match_date)), 12, 31)) from matches))
      select 'job' as kind, *, 1 as n from logged
      union all select 'table', name, null, null, null, null, null, n from stored""",
    "squad_explode": f"""{DOCS}
      select doc_id as match_id, team, player_name from team_players join parts using (match_id) join teams using (team_id)
        join players using (player_id)""",
    "first_team_case": f"""{DOCS}
      select doc_id as match_id, tw.team as toss_winner, toss_decision,
        case when toss_decision = 'bat' then tw.team when tw.team = a.team then b.team else a.team end as first_bat,
        case when toss_decision = 'field' then tw.team when tw.team = a.team then b.team else a.team end as first_field
      from matches join parts using (match_id) join teams tw on tw.team_id = toss_winner_id
        join teams a on a.team_id = first_bat_id join teams b on b.team_id = first_field_id""",
    "dim_player": f"{DOCS} select pid as player_id, player_name from named union all select -1, 'Extras'",
    "dim_team": f"{DOCS} select tid as team_id, team from named_teams",
    "dim_match": f"""{DOCS}
      select doc_id as match_id, match_date, if(match_id % 4 = 1, 'female', 'male') as match_gender,
        if(match_id % 6 = 2, 'Group ' || match_id % 2, null) as event_group, if(match_id % 5 = 3, null, 'City_' || match_id % 11) as city,
        if(match_id % 3 = 0, 'club', 'international') as team_type, season, event_name, cast(match_id % 100 as int) as event_match_number, venue, match_type,
        match_result, match_won_by_runs, match_won_by_wickets, match_won_by_innings, match_result_method, 'U1, U_' || season as umpires,
        w.tid as match_winner_id, tw.tid as toss_winner_id, toss_decision, pid as player_of_match_id, fb.tid as first_bat_id, ff.tid as first_field_id
      from matches join parts using (match_id) left join named_teams w on w.team_id = match_winner_id
        left join named_teams tw on tw.team_id = toss_winner_id left join named_teams fb on fb.team_id = first_bat_id
        left join named_teams ff on ff.team_id = first_field_id left join named on player_id = player_of_match_id""",
    "dim_date": f"""{STAR},
      d as (select cast(unnest(generate_series(make_date(year(min(match_date)), 1, 1), make_date(year(max(match_date)), 12, 31), interval 1 day)) as date) as date from matches)
      select date, cast(year(date) as int) as year, 'Q' || quarter(date) as quarter, cast(month(date) as int) as month_number, strftime(date, '%b') as month from d""",
    "fact_team_players": f"""{DOCS}
      select doc_id as match_id, t.tid as team_id, n.pid as player_id, match_date, w.tid as match_winner_id, tw.tid as toss_winner_id,
        b.pid as player_of_match_id, fb.tid as first_bat_id, ff.tid as first_field_id
      from team_players tp join parts using (match_id) join named_teams t on t.team_id = tp.team_id join named n on n.player_id = tp.player_id
        left join named_teams w on w.team_id = match_winner_id left join named_teams tw on tw.team_id = toss_winner_id
        left join named_teams fb on fb.team_id = first_bat_id left join named_teams ff on ff.team_id = first_field_id
        left join named b on b.player_id = player_of_match_id""",
    "opponent_window": f"""{DOCS}
      select doc_id as match_id, a.tid as team_id, o.tid as next_team_id from matches join parts using (match_id),
        lateral (select first_bat_id as mine, first_field_id as other union all select first_field_id, first_bat_id) x
        join named_teams a on a.team_id = mine join named_teams o on o.team_id = other""",
    "fact_deliveries": f"""{DOCS}
      select match_id, match_date, bt.tid as batting_team_id, wt.tid as bowling_team_id, innings,
        cast(overs as int) as overs, cast(balls as int) as balls, a.pid as batter_id, b.pid as non_striker_id, c.pid as bowler_id,
        byes, leg_byes, no_balls, wides, batter_runs, total_runs, wicket_kind, o.pid as player_out_id, f.pid as fielder_id
      from deliveries d join named_teams bt on bt.team_id = batting_team_id join named_teams wt on wt.team_id = bowling_team_id
        left join named a on a.player_id = batter_id left join named b on b.player_id = non_striker_id left join named c on c.player_id = bowler_id
        left join named o on o.player_id = player_out_id left join named f on f.player_id = fielder_id""",
    "dim_upsert": """
      with known as (select distinct c_name from customer join orders on o_custkey = c_custkey where o_orderdate < timestamp '1995-02-01'),
      a as (select row_number() over (order by c_name) as customer_id, c_name from known)
      select customer_id, c_name from a
      union all
      select (select count(*) from a) + row_number() over (order by c_name), c_name
      from (select distinct c_name from customer where c_name not in (select c_name from known))""",
    "merge_insert": """
      select c_custkey, c_name, count(*) as n from customer group by all""",
    "merge_update": f"""{JOBS}
      select job_id, start_time, case when status = 'Failed' then null
        when status = 'InProgress' then start_time + to_seconds(90) else end_time end as end_time, status,
        case when status = 'Failed' then null else 'ended' end as message from jobs""",
    "merge_update_month": """
      select o_orderkey, if(month = '1995-03' and o_orderpriority = '1-URGENT', 'C', o_orderstatus) as o_orderstatus, month,
        month in (select strftime(o_orderdate, '%Y-%m') from orders where o_orderpriority = '1-URGENT') and month = '1995-03' as rewritten
      from (select *, strftime(o_orderdate, '%Y-%m') as month from orders)""",
    "dim_hashed_ids": """
      select c_name, 1 as ids, 1 as names, 1 as rows, unnest([63, 8]) as bits from (select distinct c_name from customer)""",
    "schema_merge": """
      select c_custkey, if(c_custkey % 3 = 1, null, c_name) as c_name, if(c_custkey % 3 = 1, c_nationkey, null) as c_nationkey,
        if(c_custkey % 3 = 0, null, c_mktsegment) as c_mktsegment, unnest(['catalog', 'files']) as reader
      from customer""",
    "new_data_gate": f"""{STAR}
      select (select count(*) from matches where match_result is null) as have, (select count(*) from matches) as offered,
        (select count(*) from matches where match_result is not null) as delta,
        (select count(*) > 0 from matches where match_result is not null) as has_new""",
    "new_matches": f"{STAR} select match_id from matches where match_result is not null",
    "digits_cleanup": """
      select c_custkey, cast(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') as bigint) as number from customer""",
    "file_keys": """
      with f as (select distinct case when o_orderstatus = 'F' then 'wi_' || o_orderkey || '.json'
          when o_orderstatus = 'P' then o_orderpriority || '.json' else o_orderkey || '.json' end as file_name from orders)
      select file_name, case when file_name like 'wi\\_%' escape '\\' then -1 else 1 end
        * try_cast(nullif(regexp_extract(file_name, '[0-9]+'), '') as bigint) as match_id from f""",
}

# Balls with attributes of their match, and the two sides of team 3.
SEASONED = f"{STAR}, sd as (select d.*, m.season, m.match_type from deliveries d join matches m using (match_id))"
OF_TEAM = f"""{STAR}, batting as (select * from deliveries where batting_team_id = 3),
  bowling as (select * from deliveries where bowling_team_id = 3)"""

SQL["season_measures"] = f"""{SEASONED}, {_by_plain(["season"], d="sd", w="sd")}, {_squad_measures(["season"])}
  select dm.*, sm.* exclude (season) from dm join sm using (season)"""
SQL["match_type_measures"] = f"{SEASONED}, {_by_plain(['match_type'], d='sd', w='sd')} select * from dm"
SQL["event_measures"] = f"""{STAR}, last as (select event_name, season, max(match_id) as match_id from matches group by all),
  bt as (select event_name, batting_team_id as team_id, cast(sum(total_runs) as bigint) as overall_runs from deliveries
         join matches using (match_id) group by all),
  wt as (select event_name, bowling_team_id as team_id, count(*) filter (wicket_kind in {CREDITED}) as wickets,
           count(distinct overs) as bowler_overs from deliveries join matches using (match_id) group by all),
  hs as (select event_name, team_id, count(*) as hundreds from (
           select event_name, batting_team_id as team_id from deliveries join matches using (match_id)
           group by event_name, batting_team_id, match_id, innings, batter_id having sum(batter_runs) >= 100) group by all),
  sq as (select m.event_name, tp.team_id, count(distinct tp.match_id) as matches, count(distinct m.season) as seasons,
           nullif(count(distinct m.season) filter (tp.match_winner_id = tp.team_id and l.match_id is not null), 0) as season_wins
         from team_players tp join matches m using (match_id) left join last l on l.match_id = tp.match_id group by all)
  select event_name, team_id, overall_runs, nullif(wickets, 0) as wickets, bowler_overs, hundreds, matches, seasons, season_wins
  from sq left join bt using (event_name, team_id) left join wt using (event_name, team_id) left join hs using (event_name, team_id)"""
SQL["player_stats_of_team"] = f"""{OF_TEAM}, {_by_player(d="batting", w="bowling")},
  {_squad_measures(["player_id"], "where tp.team_id = 3")}
  select player_id, player_name, {PLAYER_COLUMNS}
  from players join sm using (player_id) left join dm using (player_id) left join best using (player_id)"""

# Match sets within one season, or a team's balls.
for _name in ("highest_score", "highest_wickets", "hundreds", "highest_sixes", "highest_wickets_in_over", "tied"):
    _picked = PICKED[_name].replace("from deliveries", "from of_season").replace("from matches where", "from matches where season = '1995' and")
    SQL[f"season_{_name}"] = f"""{STAR},
      of_season as (select * from deliveries where match_id in (select match_id from matches where season = '1995')), {_picked} {SELECTED}"""
SQL["team_highest_score"] = f"""{STAR}, {PICKED["highest_score"].replace("from deliveries", "from deliveries where batting_team_id = 3")} {SELECTED}"""
SQL["season_wins_by_match"] = f"""{STAR}
  select match_id, match_winner_id as team_id, cast(1 as bigint) as season_wins from matches where match_winner_id is not null"""

# The drill-through page: a match, or one innings of it.
for _part, _query, _where in (
    ("batting", "batting_scorecard", "match_id = 3"),
    ("bowling", "bowling_scorecard", "match_id = 3"),
    ("header", "innings_header", "match_id = 3"),
    ("fall_of_wickets", "fall_of_wickets", "match_id = 3 and innings = 1"),
    ("did_not_bat", "did_not_bat", "match_id = 3 and innings = 2"),
):
    SQL[f"page_{_part}"] = f"select * from ({SQL[_query]}) where {_where}"

SQL["logged_jobs"] = f"""{JOBS}
  select job_id, parent_job_id, job_name, job_category, start_time, end_time,
    if(end_time is null, 'InProgress', status) as status, if(end_time is null, null, 'ended') as message from jobs"""

# The place of each row in the display order.
for _name, _order in {
    "match_results": "match_date desc nulls last, match_id desc nulls last",
    "wins_by_month": "month_number nulls first",
    "job_report": "start_time desc nulls last, job_id nulls first",
    "page_batting": "innings nulls first, first_ball_faced nulls first, player_name nulls first",
}.items():
    SQL[_name] = f"select *, row_number() over (order by {_order}) as position from ({SQL[_name]})"
