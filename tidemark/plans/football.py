"""Football statistics from match events, line-ups and substitutions.

Goals are counted by the save attempt of the keeper who let them in, so the team of such an event is
the one that conceded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import signed_text
from tidemark.operators.aggregates import conditional_counts, mean_ratio_percent
from tidemark.operators.joins import keyed_join, lookup
from tidemark.operators.ranking import position_in_group, top_k_per_group
from tidemark.operators.reshape import both_sides

HALF = 45
SUBSTITUTIONS = ("substitution1", "substitution2", "substitution3")


def is_goal() -> Column:
    return (F.col("event") == "Save attempt") & F.array_contains("tags", "Goal")


def match_results(events: DataFrame) -> DataFrame:
    """Goals of both teams per match; matches without goals stay as 0:0."""
    against = {
        "homeTeamGoals": is_goal() & (F.col("eventTeam") == F.col("awayTeam")),
        "awayTeamGoals": is_goal() & (F.col("eventTeam") == F.col("homeTeam")),
    }
    return conditional_counts(events, ["matchId", "competition", "season", "homeTeam", "awayTeam"], against)


def season_standings(matches: DataFrame) -> DataFrame:
    """Games, results, goals and points per team, league and season."""
    home, away = F.col("homeTeamGoals"), F.col("awayTeamGoals")
    sides = [
        {"team": F.col("homeTeam"), "scored": home, "conceded": away},
        {"team": F.col("awayTeam"), "scored": away, "conceded": home},
    ]
    scored, conceded = F.col("scored"), F.col("conceded")
    totals = (
        both_sides(matches, ["competition", "season"], sides)
        .groupBy("competition", "season", "team")
        .agg(
            F.count("*").alias("games"),
            F.count_if(scored > conceded).alias("wins"),
            F.count_if(scored == conceded).alias("draws"),
            F.count_if(scored < conceded).alias("losses"),
            F.sum("scored").alias("goalsScored"),
            F.sum("conceded").alias("goalsConceded"),
        )
    )
    return totals.withColumn("points", F.col("wins") * 3 + F.col("draws"))


def short_names(standings: DataFrame) -> DataFrame:
    """Standings under the headings of a printed table, with the goal difference still a number."""
    return standings.withColumnsRenamed(
        {
            "team": "Team",
            "games": "Pld",
            "wins": "W",
            "draws": "D",
            "losses": "L",
            "goalsScored": "GF",
            "goalsConceded": "GA",
            "points": "Pts",
        }
    ).withColumn("GD", F.col("GF") - F.col("GA"))


def league_tables(standings: DataFrame) -> DataFrame:
    """Tables of all leagues and seasons, placed by points, goal difference and goals scored.

    Teams equal in all three are placed by name.
    """
    order = [F.desc("Pts"), F.desc("GD"), F.desc("GF"), F.asc("Team")]
    placed = position_in_group(short_names(standings), ["competition", "season"], order)
    columns = ["Pos", "Team", "Pld", "W", "D", "L", "GF", "GA", signed_text("GD").alias("GD"), "Pts"]
    return placed.select("competition", "season", *columns)


def league_table(standings: DataFrame, competition: str, season: str) -> DataFrame:
    """One league's table in order. The two conditions reach the scan, as both are grouping keys."""
    chosen = standings.where((F.col("season") == season) & (F.col("competition") == competition))
    return league_tables(chosen).drop("competition", "season").orderBy("Pos")


def team_passes(events: DataFrame) -> DataFrame:
    """Passes and accurate passes per team and match."""
    return (
        events.where(F.col("event") == "Pass")
        .groupBy("matchId", "competition", "season", F.col("eventTeam").alias("team"))
        .agg(
            F.count_if(F.array_contains("tags", "Accurate")).alias("successfulPasses"),
            F.count("*").alias("totalPasses"),
        )
    )


def pass_ratios(passes: DataFrame, season: str, name: str = "passSuccessRatio") -> DataFrame:
    """Mean of a team's pass ratios over the matches of a season, in percent."""
    chosen = passes.where(F.col("season") == season)
    return mean_ratio_percent(chosen, ["competition", "team"], "successfulPasses", "totalPasses", name)


def worst_passers(passes: DataFrame, season: str) -> DataFrame:
    """The team with the lowest mean ratio of each league, the lowest of all first."""
    worst = top_k_per_group(pass_ratios(passes, season), ["competition"], [F.asc_nulls_last("passSuccessRatio")], 1)
    return worst.orderBy("passSuccessRatio", "team")


def best_teams(standings: DataFrame, passes: DataFrame, season: str, k: int = 2, ties: bool = True) -> DataFrame:
    """Teams with the most points per match in each league, with all their figures.

    With ``ties`` teams level with the last place are kept; without, goal difference, goals and name decide.
    """
    average = F.col("points") / F.col("games")
    rows = short_names(standings.where(F.col("season") == season).withColumn("Avg", average))
    order = [F.desc("Avg")] if ties else [F.desc("Avg"), F.desc("GD"), F.desc("GF"), F.asc("Team")]
    best = top_k_per_group(rows, ["competition"], order, k, ties, position="Pos")
    ratios = pass_ratios(passes, season, "PassRatio")
    joined = keyed_join(best, ratios, {"competition": "competition", "Team": "team"})
    return joined.select(
        "Team",
        F.col("competition").alias("League"),
        *["Pos", "Pld", "W", "D", "L", "GF", "GA"],
        signed_text("GD").alias("GD"),
        "Pts",
        F.round("Avg", 2).alias("Avg"),
        "PassRatio",
    ).orderBy(F.desc("Avg"), "Team")


def match_lengths(events: DataFrame, season: str) -> DataFrame:
    """Minutes per match: 45 and the second half up to its last event, rounded up."""
    second = events.where((F.col("season") == season) & (F.col("eventPeriod") == "2H"))
    minutes = F.ceil(F.max("eventTime") / 60) + HALF
    return second.groupBy("matchId").agg(minutes.cast("int").alias("matchLength"))


def player_intervals(matches: DataFrame, lengths: DataFrame, season: str) -> DataFrame:
    """One row per player on a match's lists, with the minutes they came on and went off.

    The line-up starts at 0, a substitution sets either end (the last one that names the player
    counts), an open end is the end of the match. Who never came on has no start and 0 minutes.
    """
    chosen = matches.where(F.col("season") == season)
    timed = lookup(chosen, lengths, "matchId")

    def side(data: str) -> dict[str, Column]:
        return {
            "playerTeam": F.col(f"{data}.team"),
            "players": F.concat(f"{data}.lineup", f"{data}.bench"),
            "starters": F.size(f"{data}.lineup"),
            **{name: F.col(f"{data}.{name}") for name in SUBSTITUTIONS},
        }

    keep = ["matchId", "competition", "season", "matchLength"]
    sides = both_sides(timed, keep, [side("homeTeamData"), side("awayTeamData")])
    players = sides.select("*", F.posexplode("players").alias("listed", "playerId")).drop("players")
    last_first = list(reversed(SUBSTITUTIONS))

    def minute(role: str, otherwise: Column) -> Column:
        def chain(so_far: Column, name: str) -> Column:
            return so_far.when(F.col(f"{name}.{role}") == F.col("playerId"), F.col(f"{name}.minute"))

        return reduce(chain, last_first, F.when(F.lit(False), F.lit(None).cast("int"))).otherwise(otherwise)

    on_field = players.withColumns(
        {
            "startMinute": minute("playerIn", F.when(F.col("listed") < F.col("starters"), F.lit(0))),
            "wentOff": minute("playerOut", F.lit(None).cast("int")),
        }
    )
    end = F.when(F.col("wentOff").isNull() & F.col("startMinute").isNotNull(), F.col("matchLength"))
    timed_players = on_field.withColumn("endMinute", end.otherwise(F.col("wentOff")))
    played = F.when(F.col("startMinute").isNull(), 0).otherwise(F.col("endMinute") - F.col("startMinute"))
    return timed_players.select(
        "matchId",
        "playerId",
        "competition",
        "season",
        "playerTeam",
        "startMinute",
        "endMinute",
        played.alias("minutes"),
        "matchLength",
    )


def full_name() -> Column:
    return F.concat_ws(" ", "firstName", "lastName")


def player_minutes(intervals: DataFrame) -> DataFrame:
    """Minutes per player over all matches."""
    return intervals.groupBy("playerId").agg(F.sum("minutes").alias("minutes"))


def most_minutes_per_role(intervals: DataFrame, players: DataFrame) -> DataFrame:
    """The player or players with the most minutes in each role."""
    named = lookup(player_minutes(intervals), players, "playerId")
    best = top_k_per_group(named, ["role"], [F.desc("minutes")], 1)
    return best.select("role", full_name().alias("player"), "birthArea", "minutes").orderBy(
        F.desc("minutes"), "role", "player"
    )


def goals_by_minute(events: DataFrame, season: str) -> DataFrame:
    """Goals conceded per match, team, half and full minute of the match.

    Player times are whole minutes, so the full minute of a goal decides who was on the field. Counting
    goals per minute first bounds the rows of a match, however many events it has.
    """
    minute = F.floor(F.col("eventTime") / 60) + F.when(F.col("eventPeriod") == "2H", HALF).otherwise(0)
    return (
        events.where((F.col("season") == season) & is_goal())
        .groupBy(
            "matchId",
            F.col("eventTeam").alias("concedingTeam"),
            F.col("eventPeriod").alias("half"),
            minute.cast("int").alias("minute"),
        )
        .agg(F.count("*").alias("goals"))
    )


def was_on_field() -> Column:
    """Whether a player's interval holds a goal's minute.

    A change happens at the start of its minute. A change at minute 45 or later leaves the first half,
    its added time included, as it was. A player still on at the final whistle saw the last minute.
    """
    start, end, minute = F.col("startMinute"), F.col("endMinute"), F.col("minute")
    first_half = (start < HALF) & (start <= minute) & ((minute < end) | (end >= HALF))
    second_half = (start <= minute) & ((minute < end) | (end == F.col("matchLength")))
    return F.when(F.col("half") == "1H", first_half).when(F.col("half") == "2H", second_half).otherwise(False)


def plus_minus(intervals: DataFrame, events: DataFrame, season: str) -> DataFrame:
    """Goals for minus goals against while on the field, per player with any match that had goals."""
    seen = keyed_join(intervals, goals_by_minute(events, season), {"matchId": "matchId"})
    sign = F.when(F.col("playerTeam") != F.col("concedingTeam"), F.col("goals")).otherwise(-F.col("goals"))
    value = F.when(was_on_field(), sign).otherwise(F.lit(0))
    return seen.groupBy("playerId").agg(F.sum(value).alias("plusMinus"))


def plus_minus_above(totals: DataFrame, players: DataFrame, threshold: int = 65) -> DataFrame:
    """Players above a plus-minus total, by name."""
    chosen = lookup(totals.where(F.col("plusMinus") > threshold), players, "playerId")
    return chosen.select(full_name().alias("player"), "birthArea", "role", "plusMinus").orderBy(
        F.desc("plusMinus"), "player"
    )
