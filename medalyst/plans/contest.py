"""Cricket contest analytics over matches and ball-by-ball rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.functions.columns import pct
from medalyst.operators.dedupe import top_per_key
from medalyst.operators.relational import frequency, with_share
from medalyst.operators.reshape import stacked_roles

POWERPLAY = (0, 5, 6)       # first over, last over, overs bowled per match
DEATH = (16, 19, 4)


def season_runs(matches: DataFrame, balls: DataFrame) -> DataFrame:
    """Matches, runs and runs per match of each season, joined by season."""
    per_match = balls.groupBy(F.col("id")).agg(F.sum("total_runs").alias("runs"))
    return matches.select("id", "season").join(per_match, "id", "left").groupBy("season").agg(
        F.count(F.lit(1)).alias("matches"), F.coalesce(F.sum("runs"), F.lit(0)).alias("runs")).withColumn(
        "runs_per_match", F.bround(F.try_divide("runs", "matches"), 2))


def appearances(matches: DataFrame, roles: Sequence[str], out: str) -> DataFrame:
    """How often each name fills any of the role columns."""
    return frequency(stacked_roles(matches, roles, out), [out], "appearances")


def toss_advantage(matches: DataFrame) -> DataFrame:
    """Share of matches won by the toss winner; an undecided match counts as not won."""
    won = F.when(F.col("toss_winner") == F.col("winner"), "Yes").otherwise("No").alias("toss_winner_won")
    counted = matches.groupBy(won).agg(F.count(F.lit(1)).alias("matches"))
    return with_share(counted, "matches", "pct")


def champions(matches: DataFrame) -> DataFrame:
    """Winner of the last match of each season (by date, then id)."""
    last = F.max_by(F.struct("winner"), F.struct("date", "id"))
    return matches.groupBy("season").agg(last.alias("last")).select("season", F.col("last.winner").alias("champion"))


def titles(matches: DataFrame) -> DataFrame:
    return frequency(champions(matches), ["champion"], "titles")


def win_rates(matches: DataFrame) -> DataFrame:
    """Wins per team as a share of all its matches, home or away."""
    played = appearances(matches, ["team1", "team2"], "team").withColumnRenamed("appearances", "played")
    wins = frequency(matches.select(F.col("winner").alias("team")), ["team"], "wins")
    return played.join(wins, "team", "left").withColumn("wins", F.coalesce("wins", F.lit(0))).withColumn(
        "win_pct", pct("wins", "played", half_even=True))


def favourite_venues(matches: DataFrame, k: int) -> DataFrame:
    """Each team's ``k`` venues with most wins."""
    wins = frequency(matches.select(F.col("winner").alias("team"), "venue"), ["team", "venue"], "wins")
    return top_per_key(wins, ["team"], [F.desc("wins"), F.asc("venue")], k, rank_as="venue_rank")


def innings_totals(balls: DataFrame) -> DataFrame:
    return balls.groupBy("id", "inning", "batting_team", "bowling_team").agg(
        F.sum("total_runs").alias("runs"), F.sum("is_wicket").alias("wickets"))


def big_totals(innings: DataFrame, team: str, at_least: int = 200) -> DataFrame:
    """How often each team made (``batting_team``) or conceded (``bowling_team``) a big total."""
    return innings.where(F.col("runs") >= at_least).groupBy(team).agg(F.count(F.lit(1)).alias("big_totals"))


def extremes(innings: DataFrame, matches: DataFrame) -> DataFrame:
    """Highest total and widest margin by runs."""
    margin = matches.where("result = 'runs'").agg(F.max("result_margin")).scalar()
    return innings.agg(F.max("runs").alias("highest_total")).withColumn("widest_margin", margin)


def leaders(balls: DataFrame, player: str, measure: Column, k: int, out: str) -> DataFrame:
    """Top ``k`` players by a summed measure, ties by name."""
    return (balls.groupBy(player).agg(F.sum(measure).alias(out))
            .orderBy(F.desc(out), F.asc(player)).limit(k))


def strike_rates(balls: DataFrame, k: int = 20) -> DataFrame:
    """Runs per hundred balls of the ``k`` batsmen who faced most balls."""
    faced = balls.groupBy("batsman").agg(F.count(F.lit(1)).alias("balls_faced"), F.sum("batsman_runs").alias("runs"))
    top = faced.orderBy(F.desc("balls_faced"), F.asc("batsman")).limit(k)
    return top.withColumn("strike_rate", pct("runs", "balls_faced", half_even=True))


def season_boundaries(matches: DataFrame, balls: DataFrame, four: int = 4, six: int = 6) -> DataFrame:
    """Fours, sixes and the runs they brought in each season."""
    hits = balls.where(F.col("batsman_runs").isin(four, six)).groupBy("id").agg(
        F.count_if(F.col("batsman_runs") == four).alias("fours"),
        F.count_if(F.col("batsman_runs") == six).alias("sixes"))
    return matches.select("id", "season").join(hits, "id", "left").groupBy("season").agg(
        F.coalesce(F.sum("fours"), F.lit(0)).alias("fours"), F.coalesce(F.sum("sixes"), F.lit(0)).alias("sixes")).withColumn(
        "boundary_runs", F.col("fours") * four + F.col("sixes") * six)


def phase_scoring(matches: DataFrame, balls: DataFrame) -> DataFrame:
    """Runs and run rate of each team in the opening and closing overs."""
    def phase(first: int, last: int) -> Column:
        return F.sum(F.when(F.col("over").between(first, last), F.col("total_runs")).otherwise(0))

    played = appearances(matches, ["team1", "team2"], "team").withColumnRenamed("appearances", "played")
    runs = balls.groupBy(F.col("batting_team").alias("team")).agg(
        phase(*POWERPLAY[:2]).alias("powerplay_runs"), phase(*DEATH[:2]).alias("death_runs"))
    rate = lambda c, overs: F.bround(F.try_divide(F.col(c), F.col("played") * overs), 2)
    return runs.join(played, "team").withColumns({
        "powerplay_rate": rate("powerplay_runs", POWERPLAY[2]), "death_rate": rate("death_runs", DEATH[2])})
