"""The given tables in the shape of the sports feeds. All of these are plain projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchflow import schemas
from matchflow.functions import columns as fx

# fixed values: event classes and tag lists of the event table, and the tag dictionary
EVENT_NAMES = {"purchase": "Shot", "click": "Pass", "error": "Foul", "view": "Duel"}
TAG_LISTS = {0: "[101, 1801]", 1: "[1801]", 2: "[703]", 3: ""}
TAG_NAMES = {101: "Goal", 1801: "accurate"}  # 703 is left out, so that it is unknown


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def match_events(events: DataFrame) -> DataFrame:
    """Football events: a user is a match, the two halves are the halves of the day."""
    names = F.lit("Other")
    for kind, name in EVENT_NAMES.items():
        names = F.when(F.col("event_type") == kind, name).otherwise(names)
    tags = F.try_element_at(fx.literal_map(TAG_LISTS), F.from_json("props", "k int")["k"] % 4)
    by_id = F.col("event_id") % 5
    return events.select(
        "event_id",
        F.col("user_id").alias("match_id"),
        fx.seconds_since("ts", "2024-01-01").alias("event_sec"),
        F.when(F.hour("ts") < 12, "1H").otherwise("2H").alias("match_period"),
        F.when(by_id <= 1, "home").when(by_id <= 3, "away").otherwise("unknown").alias("side"),
        names.alias("event_name"),
        tags.alias("tags_list"),
        (F.col("event_id") % 25).alias("team_id"),
    )


def laps(orders: DataFrame) -> DataFrame:
    """Laps: a customer is a driver, an order is a lap, its priority the position."""
    return orders.select(
        (F.col("o_custkey") % 10).alias("race_id"),
        F.col("o_custkey").alias("driver"),
        F.col("o_orderkey").alias("lap"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("position"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("milliseconds"),
    )


def deliveries(events: DataFrame) -> DataFrame:
    """Deliveries: a user is a match, an hour of the day is an over of one of two innings."""
    hour = F.hour("ts")
    return events.select(
        F.col("user_id").alias("match_id"),
        F.when(hour < 12, 1).otherwise(2).alias("inning"),
        (hour % 12).alias("over"),
        "event_id",
        (F.floor("value") % 7).alias("runs"),
        (F.col("event_type") == "error").alias("wicket"),
    )


def match_facts(overs: DataFrame) -> DataFrame:
    """Add teams, toss and season of a match, derived from its id."""
    match = F.col("match_id")
    return overs.withColumns(
        {
            "team_1": F.concat(F.lit("Team "), (match % 8).cast("string")),
            "team_2": F.concat(F.lit("Team "), ((match + 1) % 8).cast("string")),
            "toss_decision": (match % 3 == 0).cast("int"),
            "toss_winner": (match % 2).cast("int"),
            "season": F.when(match % 2 == 0, "2007/08").otherwise("2020"),
            "current_team": (F.col("inning") == 2).cast("int"),
        }
    )


def _shaped(df: DataFrame, schema: T.StructType, **values: Column) -> DataFrame:
    """All columns of a feed schema; those without a value are null."""
    return df.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def event_feed(events: DataFrame) -> DataFrame:
    """The flat event feed, whose message and document forms are built from it."""
    e = match_events(events)
    return _shaped(
        e,
        schemas.EVENTS,
        id=F.col("event_id"),
        matchId=F.col("match_id"),
        matchPeriod=F.col("match_period"),
        eventSec=F.col("event_sec"),
        eventName=F.col("event_name"),
        teamId=F.col("team_id"),
        tagsList=F.col("tags_list"),
        pos_orig_x=F.col("event_id") % 100,
        pos_dest_y=F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 50),
    )


def match_feed(orders: DataFrame) -> DataFrame:
    """The flat match feed: an order is a match of two neighbouring teams."""
    team = F.col("o_custkey") % 20
    return _shaped(
        orders,
        schemas.MATCHES,
        wyId=F.col("o_orderkey"),
        gameweek=F.month("o_orderdate"),
        competitionId=F.col("o_custkey") % 5,
        status=F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
        winner=F.when(F.col("o_orderstatus") == "P", "").otherwise((team + F.col("o_orderkey") % 3).cast("string")),
        **{
            "team1.teamId": team,
            "team1.side": F.lit("home"),
            "team1.formation.bench": F.col("o_orderpriority"),
            "team2.teamId": team + 1,
            "team2.side": F.lit("away"),
        },
    )


def over_feed(events: DataFrame) -> DataFrame:
    """Over documents: an event is an over with up to three deliveries."""
    number, value = F.col("event_id"), F.floor("value").cast("int")

    def delivery(i: int) -> Column:
        runs = ((value + i) % 7).cast("int")
        out = F.array(F.struct(F.lit("p").alias("player_out"), F.lit("k").alias("kind")))
        return F.struct(
            F.concat(F.lit("b"), ((number + i) % 9).cast("string")).alias("batter"),
            F.lit("c").alias("bowler"),
            F.lit("d").alias("non_striker"),
            F.struct(runs.alias("batter"), F.lit(0).alias("extras"), runs.alias("total")).alias("runs"),
            F.when((number + i) % 5 == 0, out).alias("wickets"),
        )

    match, players = F.col("user_id"), F.array(F.lit("x"), F.lit("y"))
    return _shaped(
        events,
        schemas.OVER_DOCUMENT,
        match_id=match,
        team=F.when(F.hour("ts") < 12, "Reds").otherwise("Blues"),
        players=F.create_map(F.lit("Reds"), players, F.lit("Blues"), players),
        toss_winner=F.when(match % 2 == 0, "Reds").otherwise("Blues"),
        toss_decision=F.when(match % 3 == 0, "field").otherwise("bat"),
        season=F.lit("2009/10"),
        over_number=F.hour("ts") % 12,
        winner=F.when(match % 5 == 0, "Reds").otherwise("Blues"),
        deliveries=F.slice(F.array(*[delivery(i) for i in (1, 2, 3)]), 1, (number % 4).cast("int")),
    )
