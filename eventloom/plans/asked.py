"""Play rows for a caller's filters, on both facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import playquery as pq
from eventloom.plans.binding import Tables
from eventloom.plans.registry import query

#: No feed text comes with the given tables: a text of what the row says.
_KICK_TEXT = "concat(coalesce(kicker_name, 'Team'), ' ', play_kind, CASE WHEN returned THEN ' returned' ELSE '' END)"
_SNAP_TEXT = "concat(play_kind, ' for ', coalesce(cast(yards_gained as varchar(10)), 'no'), ' yards')"


def texted(t: Tables, fact: str) -> DataFrame:
    return t.play_wide.withColumn("play_text", F.expr(_KICK_TEXT)) if fact == "kicks" else t.scrimmage_wide.withColumn("play_text", F.expr(_SNAP_TEXT))


def plays(t: Tables, fact: str, **asked) -> DataFrame:
    return pq.selected(fact, texted(t, fact), **asked)


@query("q38b_kicks_asked", f"SELECT play_uid, season, game_id, fg_distance_yds, {_KICK_TEXT} AS play_text FROM play_wide WHERE season_type = 'regular' AND play_kind = 'field_goal' AND fg_made AND fg_distance_yds BETWEEN 30 AND 50 AND both_top_division AND {_KICK_TEXT} ILIKE '%FIELD^_goal%' ESCAPE '^'")
def kicks_asked(t: Tables) -> DataFrame:
    """Seven filters of the kicks, every row they keep."""
    rows = plays(t, "kicks", season_type="regular", play_kind="field_goal", fg_made=True, min_fg_distance=30, max_fg_distance=50, top_division_only=True, text_contains="FIELD_goal")
    return rows.select("play_uid", "season", "game_id", "fg_distance_yds", "play_text")


@query("q38c_kicks_of_a_team", "SELECT play_uid, season, week, play_kind, returned FROM play_wide WHERE 7 IN (kicking_team_id, receiving_team_id) AND returned = false AND touchback = false AND is_clutch ORDER BY season DESC, game_id, play_uid LIMIT 200")
def kicks_of_a_team(t: Tables) -> DataFrame:
    """The newest clutch kicks of a team, either side, said not to be returned nor a touchback (not stated is neither)."""
    return pq.newest(plays(t, "kicks", team_id=7, returned=False, touchback=False, is_clutch=True), 200).select("play_uid", "season", "week", "play_kind", "returned")


@query("q38d_snaps_asked", f"SELECT play_uid, season, game_id, yards_gained, {_SNAP_TEXT} AS play_text FROM scrimmage_wide WHERE play_kind = 'pass' AND down = 3 AND yards_gained BETWEEN 10 AND 30 AND NOT is_turnover AND is_touchdown = false AND first_down_gained AND both_top_division AND {_SNAP_TEXT} ILIKE '%YARDS%'")
def snaps_asked(t: Tables) -> DataFrame:
    rows = plays(t, "scrimmage", play_kind="pass", down=3, min_yards=10, max_yards=30, is_turnover=False, is_touchdown=False, first_down_gained=True, top_division_only=True, text_contains="YARDS")
    return rows.select("play_uid", "season", "game_id", "yards_gained", "play_text")


@query("q38e_snaps_of_a_person", "SELECT play_uid, season, week, play_kind FROM scrimmage_wide WHERE 9 IN (coalesce(passer_athlete_id, -1), coalesce(rusher_athlete_id, -1), coalesce(receiver_athlete_id, -1), coalesce(tackler_athlete_id, -1)) AND season = 1996 ORDER BY season DESC, game_id, play_uid LIMIT 500")
def snaps_of_a_person(t: Tables) -> DataFrame:
    """A person's newest plays of a season, in any of four roles."""
    return pq.newest(plays(t, "scrimmage", athlete_id=9, season=1996), 500).select("play_uid", "season", "week", "play_kind")
