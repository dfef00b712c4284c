"""Matches and balls."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_even, n, sql, total
from medalyst.checks.registry import query
from medalyst.operators.quantiles import exact_quantiles
from medalyst.operators.relational import frequency
from medalyst.plans import contest as p

_PLAYED = f"""SELECT team, {n()} AS played FROM (SELECT team1 AS team FROM matches UNION ALL SELECT team2 FROM matches) GROUP BY 1"""


@query("b01_season_runs", sql(f"""SELECT season, {n()} AS matches, CAST(COALESCE(SUM(r), 0) AS BIGINT) AS runs, {half_even('COALESCE(SUM(r), 0) / COUNT(*)')} AS runs_per_match
    FROM matches LEFT JOIN (SELECT id, SUM(total_runs) AS r FROM balls GROUP BY 1) USING (id) GROUP BY 1""", "matches", "balls"))
def _(t):
    return p.season_runs(b.matches(t), b.balls(t))


@query("b02_umpire_appearances", sql(f"SELECT umpire, {n()} AS appearances FROM (SELECT umpire1 AS umpire FROM matches UNION ALL SELECT umpire2 FROM matches) GROUP BY 1", "matches"))
def _(t):
    return p.appearances(b.matches(t), ["umpire1", "umpire2"], "umpire")


@query("b02_team_appearances", sql(_PLAYED.replace("AS played", "AS appearances"), "matches"))
def _(t):
    return p.appearances(b.matches(t), ["team1", "team2"], "team")


for _col in ("toss_winner", "result", "venue", "player_of_match"):
    @query(f"b03_{_col}_counts", sql(f"SELECT {_col}, {n()} AS n FROM matches WHERE {_col} IS NOT NULL GROUP BY 1", "matches"))
    def _(t, col=_col):
        return frequency(b.matches(t), [col])


@query("b03_toss_decision_by_season", sql(f"SELECT season, toss_decision, {n()} AS n FROM matches GROUP BY 1, 2", "matches"))
def _(t):
    return frequency(b.matches(t), ["season", "toss_decision"])


@query("b04_toss_advantage", sql(f"""SELECT w AS toss_winner_won, {n()} AS matches, {half_even('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()')} AS pct FROM (
    SELECT CASE WHEN toss_winner = winner THEN 'Yes' ELSE 'No' END AS w FROM matches) GROUP BY 1""", "matches"))
def _(t):
    return p.toss_advantage(b.matches(t))


_CHAMPS = """SELECT season, winner AS champion FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY season ORDER BY date DESC, id DESC) AS r FROM matches) WHERE r = 1"""


@query("b05_champions", sql(_CHAMPS, "matches"))
def _(t):
    return p.champions(b.matches(t))


@query("b05_titles", sql(f"SELECT champion, {n()} AS titles FROM ({_CHAMPS}) WHERE champion IS NOT NULL GROUP BY 1", "matches"))
def _(t):
    return p.titles(b.matches(t))


@query("b06_win_rates", sql(f"""SELECT team, played, COALESCE(wins, 0) AS wins, {half_even('COALESCE(wins, 0) * 100.0::DOUBLE / played')} AS win_pct FROM ({_PLAYED}) LEFT JOIN (
    SELECT winner AS team, {n()} AS wins FROM matches WHERE winner IS NOT NULL GROUP BY 1) USING (team)""", "matches"))
def _(t):
    return p.win_rates(b.matches(t))


@query("b07_favourite_venues", sql(f"""SELECT team, venue, wins, r AS venue_rank FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY team ORDER BY wins DESC, venue) AS INTEGER) AS r FROM (
    SELECT winner AS team, venue, {n()} AS wins FROM matches WHERE winner IS NOT NULL GROUP BY ALL)) WHERE r <= 2""", "matches"))
def _(t):
    return p.favourite_venues(b.matches(t), 2)


@query("b08_innings_totals", sql("SELECT * FROM innings", "innings"))
def _(t):
    return p.innings_totals(b.balls(t, with_teams=True))


@query("b08_innings_spread", sql("""SELECT inning, quantile_cont(runs, 0.25) AS q1, quantile_cont(runs, 0.5) AS median, quantile_cont(runs, 0.75) AS q3 FROM innings GROUP BY 1""", "innings"))
def _(t):
    return exact_quantiles(p.innings_totals(b.balls(t, with_teams=True)), "runs", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["inning"])


for _role, _name in (("batting_team", "made"), ("bowling_team", "conceded")):
    @query(f"b09_big_totals_{_name}", sql(f"SELECT {_role}, {n()} AS big_totals FROM innings WHERE runs >= 30 GROUP BY 1", "innings"))
    def _(t, role=_role):
        return p.big_totals(p.innings_totals(b.balls(t, with_teams=True)), role, 30)


@query("b09_extremes", sql("SELECT MAX(runs) AS highest_total, (SELECT MAX(result_margin) FROM matches WHERE result = 'runs') AS widest_margin FROM innings", "innings"))
def _(t):
    return p.extremes(p.innings_totals(b.balls(t, with_teams=True)), b.matches(t))


_LEADERS = {"balls_faced": ("batsman", "1", 20), "runs": ("batsman", "batsman_runs", 20), "fours": ("batsman", "int(batsman_runs = 4)", 20),
            "sixes": ("batsman", "int(batsman_runs = 6)", 20), "wickets": ("bowler", "is_wicket", 30)}

for _out, (_who, _expr, _k) in _LEADERS.items():
    _duck = _expr.replace("int(", "(").replace(")", ")::INTEGER") if "int(" in _expr else _expr

    @query(f"b10_leaders_{_out}", sql(f"SELECT {_who}, {total(_duck)} AS {_out} FROM balls GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {_k}", "balls"))
    def _(t, who=_who, expr=_expr, k=_k, out=_out):
        return p.leaders(b.balls(t), who, F.expr(expr), k, out)


@query("b11_strike_rates", sql(f"""SELECT batsman, {n()} AS balls_faced, {total('batsman_runs')} AS runs, {half_even('SUM(batsman_runs) * 100.0::DOUBLE / COUNT(*)')} AS strike_rate
    FROM balls GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", "balls"))
def _(t):
    return p.strike_rates(b.balls(t))


@query("b12_season_boundaries", sql(f"""SELECT season, {count_if('batsman_runs = 4')} AS fours, {count_if('batsman_runs = 6')} AS sixes,
    {count_if('batsman_runs = 4')} * 4 + {count_if('batsman_runs = 6')} * 6 AS boundary_runs FROM balls JOIN matches USING (id) GROUP BY 1""", "matches", "balls"))
def _(t):
    return p.season_boundaries(b.matches(t), b.balls(t))


@query("b13_phase_scoring", sql(f"""SELECT team, played, powerplay_runs, death_runs, {half_even('powerplay_runs / (played * 6)::DOUBLE')} AS powerplay_rate,
    {half_even('death_runs / (played * 4)::DOUBLE')} AS death_rate FROM (SELECT batting_team AS team, {total('CASE WHEN over BETWEEN 0 AND 5 THEN total_runs ELSE 0 END')} AS powerplay_runs,
    {total('CASE WHEN over BETWEEN 16 AND 19 THEN total_runs ELSE 0 END')} AS death_runs FROM balls GROUP BY 1) JOIN ({_PLAYED}) USING (team)""", "balls"))
def _(t):
    return p.phase_scoring(b.matches(t), b.balls(t, with_teams=True))
