import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, values
from tidemark.plans import football as B

SEASON = "2017-2018"
EVENT = (
    "matchId int, competition string, season string, homeTeam string, awayTeam string, event string, "
    "eventTeam string, eventPeriod string, eventTime double, tags array<string>"
)
CHANGE = "struct<playerIn:int,playerOut:int,minute:int>"
TEAM = (
    "struct<team:string,lineup:array<int>,bench:array<int>,"
    f"substitution1:{CHANGE},substitution2:{CHANGE},substitution3:{CHANGE}>"
)
MATCH = f"matchId int, competition string, season string, homeTeamData {TEAM}, awayTeamData {TEAM}"


def event(match, home, away, team, kind="Save attempt", half="1H", time=60.0, tags=("Goal",), league="L", season=SEASON):
    return (match, league, season, home, away, kind, team, half, time, list(tags))


@pytest.fixture(scope="module")
def events(spark):
    data = [
        event(1, "A", "B", "B"),  # the away keeper was beaten: a goal for A
        event(1, "A", "B", "B", half="2H", time=2845.0),
        event(1, "A", "B", "A", half="2H", time=100.0),
        event(1, "A", "B", "A", kind="Shot"),  # the scorer's own event does not count
        event(1, "A", "B", "A", kind="Save attempt", tags=("Accurate",)),
        event(2, "B", "A", "A", kind="Pass", tags=("Accurate",)),
        event(2, "B", "A", "A", kind="Pass", tags=()),
        event(2, "B", "A", "B", kind="Pass", tags=("Accurate",)),
        event(3, "C", "A", "A", kind="Pass", tags=("Accurate",)),
        event(4, "A", "C", "C", season="2016-2017"),
    ]
    return spark.createDataFrame(data, EVENT)


def test_match_results_count_the_beaten_keeper(events):
    got = B.match_results(events).select("matchId", "homeTeamGoals", "awayTeamGoals")
    assert rows(got) == [(1, 2, 1), (2, 0, 0), (3, 0, 0), (4, 1, 0)]


def test_standings(events):
    got = B.season_standings(B.match_results(events)).where(F.col("season") == SEASON).drop("competition", "season")
    assert rows(got) == [
        ("A", 3, 1, 2, 0, 2, 1, 5),
        ("B", 2, 0, 1, 1, 1, 2, 1),
        ("C", 1, 0, 1, 0, 0, 0, 1),
    ]


def test_league_table_order_and_signs(events):
    table = B.league_table(B.season_standings(B.match_results(events)), "L", SEASON)
    assert [tuple(row) for row in table.collect()] == [
        (1, "A", 3, 1, 2, 0, 2, 1, "+1", 5),
        (2, "C", 1, 0, 1, 0, 0, 0, "0", 1),
        (3, "B", 2, 0, 1, 1, 1, 2, "-1", 1),
    ]


def test_goal_difference_sorts_as_a_number(spark):
    fields = (
        "competition string, season string, team string, games long, wins long, draws long, losses long, "
        "goalsScored long, goalsConceded long, points long"
    )
    data = [("L", "S", t, 1, 1, 0, 0, f, c, 3) for t, f, c in (("x", 10, 1), ("y", 12, 0), ("z", 9, 0), ("w", 10, 0))]
    table = B.league_table(spark.createDataFrame(data, fields), "L", "S")
    assert values(table, "Team") == ["y", "w", "x", "z"]
    assert values(table, "GD") == ["+12", "+10", "+9", "+9"]


def test_season_and_league_filters_reach_the_scan(spark, events, folder):
    events.write.parquet(folder + "/events")
    stored = spark.read.parquet(folder + "/events")
    text = plan(B.league_table(B.season_standings(B.match_results(stored)), "L", SEASON))
    assert f"EqualTo(season,{SEASON})" in text and "EqualTo(competition,L)" in text
    assert "eventTime" not in text  # pruned


def test_passes(events):
    got = B.team_passes(events).select("matchId", "team", "successfulPasses", "totalPasses")
    assert rows(got) == [(2, "A", 1, 2), (2, "B", 1, 1), (3, "A", 1, 1)]
    assert rows(B.pass_ratios(B.team_passes(events), SEASON)) == [("L", "A", 75.0), ("L", "B", 100.0)]
    assert rows(B.worst_passers(B.team_passes(events), SEASON)) == [("L", "A", 75.0)]


def test_worst_passers_keep_ties(spark):
    fields = "matchId int, competition string, season string, team string, successfulPasses long, totalPasses long"
    data = [(1, "L", SEASON, "A", 1, 2), (1, "L", SEASON, "B", 2, 4), (2, "M", SEASON, "A", 9, 10)]
    got = B.worst_passers(spark.createDataFrame(data, fields), SEASON)
    assert [tuple(row) for row in got.collect()] == [("L", "A", 50.0), ("L", "B", 50.0), ("M", "A", 90.0)]


def test_best_teams(events):
    standings, passes = B.season_standings(B.match_results(events)), B.team_passes(events)
    got = B.best_teams(standings, passes, SEASON)
    assert got.columns == ["Team", "League", "Pos", "Pld", "W", "D", "L", "GF", "GA", "GD", "Pts", "Avg", "PassRatio"]
    # C is second by average but made no pass, so it has no ratio to join.
    assert [tuple(r) for r in got.collect()] == [("A", "L", 1, 3, 1, 2, 0, 2, 1, "+1", 5, 1.67, 75.0)]


def test_same_team_name_in_two_leagues(spark):
    data = [
        event(1, "A", "B", "B", kind="Pass", tags=("Accurate",), league="L"),
        event(1, "A", "B", "A", kind="Pass", tags=("Accurate",), league="L"),
        event(2, "A", "D", "A", kind="Pass", tags=(), league="M"),
        event(2, "A", "D", "D", kind="Pass", tags=(), league="M"),
    ]
    events = spark.createDataFrame(data, EVENT)
    got = B.best_teams(B.season_standings(B.match_results(events)), B.team_passes(events), SEASON)
    assert rows(got.select("Team", "League", "PassRatio")) == [
        ("A", "L", 100.0), ("A", "M", 0.0), ("B", "L", 100.0), ("D", "M", 0.0),
    ]


def test_match_length(events):
    assert rows(B.match_lengths(events, SEASON)) == [(1, 93)]


@pytest.fixture(scope="module")
def match(spark):
    home = ("A", [1, 2, 3], [4, 5], (4, 2, 60), None, (5, 3, 45))
    away = ("B", [11, 12], [13], (13, 11, 46), (14, 99, 50), None)
    return spark.createDataFrame([(1, "L", SEASON, home, away), (9, "L", "2016-2017", home, away)], MATCH)


def intervals_of(spark, match, length=93):
    lengths = spark.createDataFrame([(1, length), (9, length)], "matchId int, matchLength int")
    return B.player_intervals(match, lengths, SEASON)


def test_player_intervals(spark, match):
    got = intervals_of(spark, match).select("playerId", "playerTeam", "startMinute", "endMinute", "minutes")
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "A", 0, 93, 93),
        (2, "A", 0, 60, 60),
        (3, "A", 0, 45, 45),
        (4, "A", 60, 93, 33),
        (5, "A", 45, 93, 48),
        (11, "B", 0, 46, 46),
        (12, "B", 0, 93, 93),
        (13, "B", 46, 93, 47),
    ]


def test_bench_player_without_change_has_no_minutes(spark):
    team = ("A", [1], [2], None, None, None)
    match = spark.createDataFrame([(1, "L", SEASON, team, ("B", [], [], None, None, None))], MATCH)
    got = intervals_of(spark, match).select("playerId", "startMinute", "endMinute", "minutes")
    assert rows(got) == [(1, 0, 93, 93), (2, None, None, 0)]


def test_last_change_of_a_player_counts(spark):
    team = ("A", [1], [2], (2, 1, 50), (2, 3, 70), (3, 2, 80))
    match = spark.createDataFrame([(1, "L", SEASON, team, ("B", [], [], None, None, None))], MATCH)
    got = intervals_of(spark, match).select("playerId", "startMinute", "endMinute")
    assert rows(got) == [(1, 0, 50), (2, 70, 80)]


def brute_plus_minus(players, goals, length):
    """One player and one goal at a time, with exact goal times."""
    totals = {}
    for ident, team, start, end in players:
        for half, seconds, loser in goals:
            t = seconds / 60 + (45 if half == "2H" else 0)
            on = start is not None and start <= t
            if half == "1H":
                on = on and start < 45 and (t < end or end >= 45)
            else:
                on = on and (t < end or end == length)
            totals[ident] = totals.get(ident, 0) + (0 if not on else -1 if team == loser else 1)
    return totals


def test_plus_minus_against_brute_force(spark, match):
    goals = [
        (half, float(seconds), loser)
        for half, top in (("1H", 2900), ("2H", 2880))
        for seconds in (0, 59, 60, 899, 900, 2639, 2640, 2699, 2700, 2701, 2760, 2799, top)
        for loser in ("A", "B")
    ] + [("2H", 900.0, "B")] * 3
    events = spark.createDataFrame(
        [event(1, "A", "B", loser, half=half, time=seconds) for half, seconds, loser in goals]
        + [event(1, "A", "B", "A", half="E1", time=5.0)],
        EVENT,
    )
    intervals = intervals_of(spark, match)
    players = [(r.playerId, r.playerTeam, r.startMinute, r.endMinute) for r in intervals.collect()]
    got = dict(tuple(r) for r in B.plus_minus(intervals, events, SEASON).collect())
    assert got == brute_plus_minus(players, goals, 93)


@pytest.mark.parametrize(
    "half, seconds, expected",
    [
        ("1H", 2760.0, {3: 1, 5: 0}),  # added time: who goes off at 45 was on, who comes on was not
        ("2H", 0.0, {3: 0, 5: 1}),
        ("2H", 900.0, {2: 0, 4: 1}),  # at the very minute of the change the new player is on
        ("2H", 899.0, {2: 1, 4: 0}),
    ],
)
def test_goal_at_a_change(spark, match, half, seconds, expected):
    events = spark.createDataFrame([event(1, "A", "B", "B", half=half, time=seconds)], EVENT)
    got = dict(tuple(r) for r in B.plus_minus(intervals_of(spark, match), events, SEASON).collect())
    assert {ident: got[ident] for ident in expected} == expected


def test_minutes_and_roles(spark, match):
    people = [(1, "Ann", "A", "X", "Forward"), (12, "Bob", None, "Y", "Forward"), (2, "Cy", "C", "Z", "Defender")]
    players = spark.createDataFrame(people, "playerId int, firstName string, lastName string, birthArea string, role string")
    intervals = intervals_of(spark, match)
    assert rows(B.most_minutes_per_role(intervals, players)) == [
        ("Defender", "Cy C", "Z", 60),
        ("Forward", "Ann A", "X", 93),
        ("Forward", "Bob", "Y", 93),
    ]
    totals = spark.createDataFrame([(1, 66), (2, 65), (12, 90)], "playerId int, plusMinus long")
    top = B.plus_minus_above(totals, players)
    assert [tuple(r) for r in top.collect()] == [("Bob", "Y", "Forward", 90), ("Ann A", "X", "Forward", 66)]


def test_a_hot_match_is_counted_before_the_join(spark, match):
    """A match with a third of all goals meets the players as one row per minute and team."""
    events = spark.range(30000).select(
        F.lit(1).alias("matchId"), F.lit(SEASON).alias("season"), F.lit("Save attempt").alias("event"),
        F.lit("B").alias("eventTeam"), F.lit("2H").alias("eventPeriod"),
        (F.col("id") % 2880).cast("double").alias("eventTime"), F.array(F.lit("Goal")).alias("tags"),
    )
    assert B.goals_by_minute(events, SEASON).count() == 48
    got = dict(tuple(r) for r in B.plus_minus(intervals_of(spark, match), events, SEASON).collect())
    assert got[1] == 30000 and got[12] == -30000
