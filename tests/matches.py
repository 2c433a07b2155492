"""Hand-written match documents, each pinning one case."""

import json


def ball(batter, bowler, other, runs=0, total=None, wickets=None, **extras):
    d = {"batter": batter, "bowler": bowler, "non_striker": other}
    d["runs"] = {"batter": runs, "total": runs + sum(extras.values()) if total is None else total}
    if extras:
        d["extras"] = extras
    if wickets:
        d["wickets"] = wickets
    return d


def out(kind, player, *fielders):
    wicket = {"kind": kind, "player_out": player}
    if fielders:
        wicket["fielders"] = [{"name": f} for f in fielders]
    return wicket


def innings(team, *overs):
    return {"team": team, "overs": [{"over": i, "deliveries": list(balls)} for i, balls in enumerate(overs)]}


def info(date="2020-01-02", winner=None, by=None, toss=("A", "field"), players=None, **more):
    outcome = dict(more.pop("outcome", {}))
    if winner:
        outcome["winner"] = winner
    if by:
        outcome["by"] = by
    base = {
        "dates": [date], "gender": "male", "season": date[:4], "city": "C", "venue": "V", "team_type": "club",
        "match_type": "T20", "event": {"name": "E", "match_number": 1}, "officials": {"umpires": ["U1", "U2"]},
        "outcome": outcome, "toss": {"winner": toss[0], "decision": toss[1]}, "player_of_match": ["b1"],
        "players": players or {"A": ["a1", "a2", "a3"], "B": ["b1", "b2", "b3"]},
    }
    base.update(more)
    return {k: v for k, v in base.items() if v is not None}


# An over with a wide, a no-ball and byes, so that it has eight balls; the seventh shares
# its running number with the first ball of the next over.
LONG_OVER = [
    ball("b1", "a1", "b2", 4),
    ball("b1", "a1", "b2", wides=1),
    ball("b1", "a1", "b2", noballs=1),
    ball("b1", "a1", "b2", 0, wickets=[out("caught", "b1", "a2", "a3")]),
    ball("b3", "a1", "b2", byes=2),
    ball("b3", "a1", "b2", legbyes=1),
    ball("b3", "a1", "b2", 6, wickets=[out("run out", "b2", "a3")]),
    ball("b3", "a1", "b1", 0, 5),
]
SECOND_OVER = [
    ball("b3", "a2", "b1", 1),
    ball("b1", "a2", "b3", 0, wickets=[out("retired hurt", "b1")]),
    ball("b3", "a2", "b1", 0, wickets=[out("bowled", "b3"), out("run out", "b1", "a1")]),
]

MATCHES = {
    "1.json": (
        info(winner="B", by={"runs": 5}),
        [
            innings("B", LONG_OVER, SECOND_OVER),
            innings("A", [ball("a1", "b1", "a2", 2), ball("a1", "b1", "a2", 0, wickets=[out("caught and bowled", "a1")]),
                          ball("a3", "b1", "a2", 0, wickets=[out("stumped", "a3", "sub")])]),
        ],
    ),
    "2.json": (
        info("2020-03-04", "A", {"wickets": 7}, ("B", "bat"), outcome={"method": "D/L"}, officials={}),
        [innings("B", [ball("b1", "a1", "b2", 1)]), {"team": "A"}],
    ),
    "3.json": (
        info("2021-05-06", None, None, ("A", "bat"), outcome={"result": "tie", "eliminator": "B"}),
        [innings("A", [ball("a1", "b1", "a2", 1)]), innings("B", [ball("b1", "a1", "b2", 1)]),
         innings("A", [ball("a2", "b1", "a1", 6)]), innings("B", [ball("b2", "a1", "b1", 6)])],
    ),
    "wi_4.json": (
        info("2021-07-08", None, None, ("B", "field"), outcome={"result": "no result"}, player_of_match=None),
        [innings("A", [ball("a1", "b1", "a2", 1)])],
    ),
    "5.json": (
        info("2021-07-09", "A", {"innings": 1, "runs": 30}, ("A", "field"), players={"A": ["a1", "a2"]}),
        [innings("A", [ball("a1", "a2", "a2", 1)])],
    ),
}


def document(name):
    details, played = MATCHES[name]
    return json.dumps({"info": details, "innings": played}, indent=1)


def write_all(folder):
    for name in MATCHES:
        (folder / name).write_text(document(name))
