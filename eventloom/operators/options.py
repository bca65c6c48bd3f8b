"""Lists to choose from, read off the plays of a lens, and what stays of choices when the lists change.

Lenses are "st" (kicks), "off" and "def" (scrimmage plays from either side); every function takes the
wide table of the lens's fact.  A null is no option.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators import lenses
from eventloom.operators.filters import KINDS

SIDES = {"st": "kicking", "off": "offense", "def": "defense"}
#: Whom a lens's player filter can name: id and name columns, by role.
PEOPLE = {
    "st": (("kicker_athlete_id", "kicker_known_name"),),
    "off": (("passer_athlete_id", "passer_name"), ("rusher_athlete_id", "rusher_name"), ("receiver_athlete_id", "receiver_name")),
    "def": (("tackler_athlete_id", "tackler_name"),),
}


def outcome(lens: str) -> Column:
    return lenses.kick_outcome() if lens == "st" else lenses.scrimmage_outcome(SIDES[lens], lenses.possible_yards())


def facet_values(lens: str) -> dict[str, Column]:
    """What each list of a lens holds; kicks have no field zone."""
    own = SIDES[lens]
    found = {"team": F.col(f"{own}_team"), "conference": F.col(f"{own}_conference"), "division": F.col(f"{own}_division"), "surface": F.col("surface"), "outcome": outcome(lens)}
    return found if lens == "st" else found | {"zone": F.col("field_zone")}


def lists(wide: DataFrame, lens: str) -> DataFrame:
    """(facet, value) for all lists of a lens in one pass; a task sends each value once."""
    entries = [F.struct(F.lit(name).alias("facet"), c.alias("value")) for name, c in facet_values(lens).items()]
    return wide.select(F.inline(F.array(*entries))).where("value IS NOT NULL").distinct()


def teams(wide: DataFrame, lens: str, conferences: Sequence[str] = (), seasons: tuple[int, int] | None = None) -> DataFrame:
    """(team_id, team, plays), narrowed to teams that played in one of the conferences in those seasons.

    Membership is the plays' own, as conferences change with the season.  Seasons alone narrow nothing.
    """
    own = SIDES[lens]
    if conferences:
        wide = wide.where(F.col(f"{own}_conference").isin(*conferences))
        wide = wide if seasons is None else wide.where(F.col("season").between(*seasons))
    rows = wide.groupBy(F.col(f"{own}_team_id").alias("team_id")).agg(F.max(f"{own}_team").alias("team"), F.count(F.lit(1)).alias("plays"))
    return rows.where("team_id IS NOT NULL AND team <> ''")


def people(wide: DataFrame, lens: str, phases: Sequence[str] = (), least: int = 20) -> DataFrame:
    """(player_id, player, plays, first_season, last_season, label): everyone with that many plays in any role of the lens.

    A person who fills two roles of one play counts twice.  One without a name is left out, as there is nothing to pick.
    """
    if phases:
        wide = wide.where(F.col("play_kind").isin([k for chip in phases for k in KINDS.get(chip, (chip,))]))
    named = F.coalesce("kicker_known_name", "kicker_name") if lens == "st" else None
    roles = [F.struct(F.col(i).alias("player_id"), (F.col(n) if named is None else named).alias("player")) for i, n in PEOPLE[lens]]
    rows = wide.select("season", F.inline(F.array(*roles))).where("player_id IS NOT NULL").groupBy("player_id")
    found = rows.agg(F.max("player").alias("player"), F.count(F.lit(1)).alias("plays"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    years = F.concat_ws("-", F.col("first_season").cast("string"), F.col("last_season").cast("string"))
    return found.where((F.col("plays") >= least) & (F.col("player") != "")).withColumn("label", F.concat_ws(" · ", "player", years, F.format_number("plays", 0)))


def marked(options: DataFrame, column: str, picks: Sequence) -> DataFrame:
    """The options, each with whether it is picked.  A pick that is no option any more appears nowhere: it is dropped."""
    return options.withColumn("picked", F.col(column).isin(*picks) if picks else F.lit(False))


def kept(options: DataFrame, column: str, picks: Sequence) -> DataFrame:
    """The picks that are still options."""
    return marked(options, column, picks).where("picked").select(column).distinct()
