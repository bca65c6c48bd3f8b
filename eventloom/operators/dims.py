"""Dimensions from what many rows claim: precedence, majority votes, careers, season status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.clean import name_key


def by_precedence(claims: DataFrame, key: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """One row per key: the columns of the claim that comes first.  An aggregate: no key's claims are gathered."""
    first = F.min_by(F.struct(*columns), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    return claims.groupBy(*key).agg(first.alias("el_first")).select(*key, "el_first.*")


def latest_file_owns(rows: DataFrame, unit: str, order: str, uid: str) -> DataFrame:
    """Extracts overlap: of each unit (a season) only the latest file's rows count, and of those one per uid."""
    owner = rows.groupBy(unit).agg(F.max(order).alias("el_owner"))
    kept = rows.join(owner, unit).where(F.col(order) == F.col("el_owner")).drop("el_owner")
    return kept.dropDuplicates([uid])


def name_votes(spellings: DataFrame, player: str, name: str, least: int = 2, share: float = 0.6) -> DataFrame:
    """(player, name, confidence): the key most rows agree on, shown in its fullest spelling; null below the share.

    Votes are summed per spelling first, so a popular player is a few rows before the last shuffle.
    """
    counted = spellings.where(F.col(name).isNotNull()).groupBy(player, name).agg(F.count(F.lit(1)).alias("n")).withColumn("el_key", name_key(name))
    full = F.max_by(name, F.struct(F.length(name), F.col("n"), F.col(name)))
    keys = counted.groupBy(player, "el_key").agg(F.sum("n").alias("n"), full.alias("el_full"))
    best = F.max_by(F.struct("el_full", "n"), F.struct("n", "el_key"))
    voted = keys.groupBy(player).agg(F.sum("n").alias("el_all"), best.alias("el_best"))
    agreed = (F.col("el_best.n") >= least) & (F.col("el_best.n") >= F.col("el_all") * share)
    return voted.select(player, F.when(agreed, F.col("el_best.el_full")).alias("name"), (F.col("el_best.n") / F.col("el_all")).alias("confidence"))


def modal_by_key(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """The most frequent value per key; of equally frequent ones the greatest."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(key).agg(F.max_by(value, F.struct("n", value)).alias(out))


def careers(people: DataFrame, plays: DataFrame, uid: str = "play_uid") -> DataFrame:
    """One row per athlete: seasons, plays (a play counts once, whatever the roles), main role."""
    rows = people.join(plays.select(uid, "season"), uid)
    life = rows.groupBy("athlete_id").agg(F.min("season").alias("first_season"), F.max("season").alias("last_season"), F.countDistinct(uid).alias("plays"))
    return life.join(modal_by_key(people, "athlete_id", "role", "primary_role"), "athlete_id", "left")


def careers_of(entries: DataFrame) -> DataFrame:
    """careers() from the entries of plays (season, role, athlete_id, is_first): two aggregates, the second over a few rows an athlete."""
    by_role = entries.groupBy("athlete_id", "role").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_first").cast("long")).alias("plays"), F.min("season").alias("low"), F.max("season").alias("high"))
    return by_role.groupBy("athlete_id").agg(F.min("low").alias("first_season"), F.max("high").alias("last_season"), F.sum("plays").alias("plays"), F.max_by("role", F.struct("n", "role")).alias("primary_role"))


def season_status(plays: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Per season games, plays, the last regular week, and whether it was still going at as_of."""
    last = F.max("kickoff_utc")
    return plays.groupBy("season").agg(
        F.countDistinct("game_id").alias("games"), F.count(F.lit(1)).alias("plays"), F.max(F.when(F.col("season_type") == "regular", F.col("week"))).alias("last_regular_week"),
        last.alias("last_kickoff"), (last > F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")).alias("is_in_progress"),
    )


#: A season's tree of groups as the feed gives it: groups hold divisions, divisions hold teams.
GROUP_TREE = "struct<groups:array<struct<id:bigint,name:string,children:array<struct<id:bigint,name:string,teams:array<struct<id:bigint>>>>>>>"
#: A game as the feed gives it.
GAME_ROW = "struct<id:bigint,season:int,week:int,season_type:int,date:string,venue:struct<id:bigint>,attendance:bigint,neutral_site:boolean,conference_competition:boolean,teams:array<struct<id:bigint,home_away:string>>>"
#: Roles of a conversion that are a role of the game.
CANON = {"patScorer": "kicker", "patPasser": "passer"}


def last_group(trees: DataFrame, season: str = "season", tree: str = "tree") -> DataFrame:
    """(season, team_id, conference_id, conference_name, division): of all places a tree lists a team in, the last one in its order.

    Trees are rows of JSON text and are laid out level by level; "last" is an aggregate over the places.
    """
    levels = trees.select(season, F.posexplode(F.from_json(tree, GROUP_TREE)["groups"]).alias("g_at", "g"))
    levels = levels.select(season, "g_at", "g", F.posexplode("g.children").alias("c_at", "c"))
    listed = levels.select(season, "g_at", "g", "c_at", "c", F.posexplode("c.teams").alias("t_at", "t")).select(
        season, F.col("t.id").alias("team_id"), F.struct("g_at", "c_at", "t_at").alias("place"),
        F.struct(F.col("g.id").alias("conference_id"), F.col("g.name").alias("conference_name"), F.col("c.name").alias("division")).alias("own"),
    )
    return listed.where("team_id IS NOT NULL").groupBy(season, "team_id").agg(F.max_by("own", "place").alias("own")).select(season, "team_id", "own.*")


def game_rows(feed: DataFrame, game: str = "game") -> DataFrame:
    """Games as rows: type 3 is the postseason and all else the regular season; the sides by what the feed says of each team."""
    g = feed.select(F.from_json(game, GAME_ROW).alias("g")).where("g.id IS NOT NULL")
    side = lambda name: F.get(F.filter("g.teams", lambda t: t["home_away"] == name), F.lit(0))["id"]
    return g.select(
        F.col("g.id").alias("game_id"), "g.season", "g.week", F.when(F.col("g.season_type") == 3, "postseason").otherwise("regular").alias("season_type"), F.col("g.date").alias("kickoff"),
        side("home").alias("home_team_id"), side("away").alias("away_team_id"), F.col("g.venue.id").alias("venue_id"), "g.attendance", "g.neutral_site", F.col("g.conference_competition").alias("conference_game"),
    )


def canonical(role: str | Column) -> Column:
    """A role under the one name it counts under."""
    col = F.col(role) if isinstance(role, str) else role
    return F.coalesce(F.create_map(*[F.lit(x) for pair in CANON.items() for x in pair])[col], col)
