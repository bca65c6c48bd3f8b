"""Readers of landed feeds and staged files, writers of tables and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLAY = (
    "struct<id:string,sequenceNumber:string,type:struct<id:string,text:string>,text:string,period:struct<number:int>,clock:struct<displayValue:string>,"
    "homeScore:int,awayScore:int,scoringPlay:boolean,statYardage:int,start:struct<down:int,distance:int,yardsToEndzone:int,team:struct<id:string>>,"
    "end:struct<down:int,distance:int,yardsToEndzone:int,team:struct<id:string>>,teamParticipants:array<struct<id:string,type:string>>>"
)
GAME = f"game_id string, drives array<struct<id:string,team:struct<id:string>,result:string,displayResult:string,description:string,isScore:boolean,plays:array<{PLAY}>>>"


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed game document (JSON, gzip or plain); unreadable ones are kept apart in _corrupt."""
    return spark.read.schema(f"{GAME}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("multiLine", True).json(path)


def plays_of(games: DataFrame) -> DataFrame:
    """One row per play in feed order: game, drive and play position, the nested fields flat."""
    drives = games.where("game_id IS NOT NULL").select("game_id", F.posexplode_outer("drives").alias("drive_no", "d"))
    plays = drives.select("game_id", "drive_no", F.col("d.id").alias("drive_id"), F.col("d.result").alias("drive_result"), F.posexplode_outer("d.plays").alias("play_no", "p")).where("p IS NOT NULL")
    side = lambda kind: F.get(F.filter("p.teamParticipants", lambda x: x["type"] == kind), F.lit(0))["id"]
    return plays.select(
        "game_id", "drive_no", "drive_id", "drive_result", "play_no", F.concat_ws(":", F.lit("t"), "game_id", "p.sequenceNumber").alias("base_uid"),
        F.col("p.type.text").alias("play_type"), F.col("p.text").alias("play_text"), F.col("p.period.number").alias("period"), F.col("p.clock.displayValue").alias("clock"),
        F.col("p.homeScore").alias("home_score"), F.col("p.awayScore").alias("away_score"), F.col("p.statYardage").alias("yards_gained"), F.col("p.start.down").alias("down"),
        F.col("p.start.distance").alias("distance"), F.nullif(F.col("p.start.yardsToEndzone"), F.lit(0)).alias("yards_to_goal"),
        F.coalesce(side("offense"), F.col("p.start.team.id")).alias("offense_team_id"), side("defense").alias("defense_team_id"),
    )


def participants_of(documents: DataFrame, game: str = "game_id", people: str = "participants") -> DataFrame:
    """(game, sequence, role, athlete_id, ordinal) of a map from sequence number to [role, athlete] pairs.

    Older keys put the game before the sequence: what is left of the last ':' is cut off.
    """
    entry = documents.select(game, F.explode(people).alias("key", "pairs"))
    rows = entry.select(game, F.element_at(F.split("key", ":"), -1).alias("sequence"), F.posexplode("pairs").alias("ordinal", "pair"))
    return rows.select(game, "sequence", F.get("pair", F.lit(0)).alias("role"), F.get("pair", F.lit(1)).try_cast("bigint").alias("athlete_id"), "ordinal")


def read_staging(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A headered CSV as text columns: typing is a step of its own, so a bad value never loses a row."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def read_extracts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several extracts as one frame by column name, each row tagged with its file's place."""
    out = None
    for i, p in enumerate(paths):
        part = spark.read.option("header", True).csv(p).withColumn("_ord", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError("no extracts are named")
    return out


def snapshot(tables: dict[str, DataFrame], path: str, source: str, built_at: str) -> None:
    """Tables as Parquet with a one-row stamp of when and from what they were built."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    stamp = spark.range(1).select(F.lit(built_at).cast("timestamp").alias("built_at"), F.lit(source).alias("source"), F.lit(len(tables)).alias("tables"))
    stamp.write.mode("overwrite").parquet(f"{path}/snapshot_meta")


def export(df: DataFrame, path: str, cap: int = 100_000) -> dict:
    """CSV of at most cap rows, named for it when cut: the returned facts say how many there were."""
    total = df.count()
    cut = total > cap
    target = f"{path}_first_{cap}" if cut else path
    df.limit(cap).write.mode("overwrite").option("header", True).csv(target)
    return {"path": target, "rows": min(total, cap), "total": total, "truncated": cut}


def pages_of(df: DataFrame, rows: str, periods: str, value: str, names: Sequence) -> DataFrame:
    """A report grid: rows by periods, with the row's total."""
    grid = df.groupBy(rows).pivot(periods, list(names)).agg(F.sum(value))
    total = sum((F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in names), F.lit(0))
    return grid.withColumn("total", total)
