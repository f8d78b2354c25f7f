"""Live football: parsing, enrichment, running match statistics and predictions.

Spark offers no row windows on streams, and one stateful Python task per match would have to
gather a hot match. The statistics therefore run per micro-batch with the batch operator
``running``, which splits hot matches, and the state of every match is carried between
micro-batches in tables. Statistics, predictions and states of a micro-batch count together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchflow import schemas
from matchflow.functions import football
from matchflow.functions.columns import int_list
from matchflow.operators.joins import enrich_side
from matchflow.operators.running import High, Previous, Total, advance, cut, hot_cuts, running
from matchflow.sources.messages import accepted, split_messages, unreadable
from matchflow.streaming.commits import CarriedState, CommitLog

# events of one second go by a hash of their id: any fixed order will do, and a number can be cut along
KEY, ORDER = ["matchId"], ["eventSec", "__order"]


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Event columns of the messages that are JSON objects and name a match and no mistyped second; see ``rejected_events``."""
    parsed = accepted(split_messages(messages, schemas.EVENT_MESSAGE, value))
    return (
        parsed.filter(_lacks(value).isNull())
        .select("message.*")
        .withColumn("eventSec", football.absolute_second(F.col("eventSec"), F.col("matchPeriod")))
        .withColumn("tagsList", int_list("tagsList"))
    )


def _lacks(value: str) -> Column:
    """Why a parsed message is no event; null if it is one. The text is only looked at again where the second is missing."""
    second = F.col("message.eventSec").isNull() & F.get_json_object(F.col(value), "$.eventSec").isNotNull()
    return F.when(F.col("message.matchId").isNull(), "no matchId").when(second, "eventSec is no number")


def rejected_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that give no event, with the reason, for a dead-letter table; batch or stream."""
    parsed = split_messages(messages, schemas.EVENT_MESSAGE, value)
    reason = F.when(F.col("is_object"), _lacks(value)).otherwise(unreadable(value))
    return parsed.select(*messages.columns, reason.alias("reason")).filter(F.col("reason").isNotNull())


def enrich_events(events: DataFrame, matches: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Add the side of the event's team and an event id; the input may be a stream."""
    sided = enrich_side(events, matches)
    key = football.event_key(F.col("matchId"), F.col("eventSec"), F.struct(*events.columns), unique=unique_ids)
    return sided.withColumn("event_id", key)


def _seen() -> High:
    return High(F.unix_timestamp(F.current_timestamp()))


def _previous() -> dict:
    return {"__last_sec": Previous("eventSec"), "__last_side": Previous("side"), "__seen": _seen()}


def match_statistics(
    events: DataFrame,
    last_events: CarriedState | None = None,
    totals: CarriedState | None = None,
    credit: str = "previous",
    double_count: bool = False,
) -> DataFrame:
    """One row of running statistics per event of a micro-batch, ordered by second.

    Time since the event before counts for that event's side, or for the current one; time that
    runs backwards counts as 0. ``double_count`` doubles possession, as the first version of the
    live job did. The carried states are read and then moved on to the end of this batch.
    """
    flags = football.flags_by_code(F.col("eventName"), F.col("tagsList"))
    counters = football.side_counters(flags, F.col("side"))
    rows = events.select(
        "matchId",
        "event_id",
        "eventSec",
        F.xxhash64("event_id").alias("__order"),
        "side",
        *[c.alias(n) for n, c in counters.items()],
    )
    rows = cut(rows, KEY, ORDER, hot_cuts(rows, KEY, ORDER))

    started = last_events.before(rows) if last_events else None
    timed = running(rows, KEY, ORDER, _previous(), initial=started, already_cut=True, keep_chunks=True)
    passed = F.greatest(F.col("eventSec") - F.col("__last_sec"), F.lit(0.0)) * (2 if double_count else 1)
    holder = F.col("__last_side") if credit == "previous" else F.col("side")
    timed = timed.withColumns(
        {
            f"{side}_possession_time": F.when(holder == side, F.coalesce(passed, F.lit(0.0))).otherwise(F.lit(0.0))
            for side in ("home", "away")
        }
    )

    stats = {n: Total(F.col(n).cast("bigint")) for n in schemas.COUNTER_COLUMNS}
    stats |= {n: Total(n) for n in schemas.POSSESSION_COLUMNS}
    stats["__seen"] = _seen()
    so_far = totals.before(rows) if totals else None
    out = running(timed, KEY, ORDER, stats, initial=so_far, already_cut=True)
    if last_events:
        last_events.after(advance(rows, KEY, ORDER, _previous(), started))
    if totals:
        totals.after(advance(timed, KEY, ORDER, stats, so_far))
    out = out.withColumns(football.differences())
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schemas.MATCH_STATS.fields])


STATISTICS, PREDICTIONS = "statistics", "predictions"  # tables of the live job


def _last_seen() -> tuple[Column, Column]:
    """Where the two states hold the time of a match's last event: the last of their statistics."""
    totals = len(schemas.COUNTER_COLUMNS) + len(schemas.POSSESSION_COLUMNS)
    return F.col(f"__s{len(_previous()) - 1}.v"), F.col(f"__s{totals}.v")


def work_off(
    log: CommitLog,
    batch: DataFrame,
    batch_id: int,
    score: Callable[[DataFrame], DataFrame] | None = None,
    ttl_seconds: int | None = None,
    **options,
) -> None:
    """Write statistics and predictions of a micro-batch and commit both with the states; nothing if that is done already."""
    work = log.begin(batch_id)
    if work is None:
        return
    batch = batch.persist()  # read by the windows and by both states
    try:
        last_events, totals = (work.state(name, KEY, seen, ttl_seconds) for name, seen in zip(("last_events", "totals"), _last_seen()))
        stats = work.write(STATISTICS, match_statistics(batch, last_events, totals, **options), schemas.MATCH_STATS)
        if score is not None:
            work.write(PREDICTIONS, score(stats), schemas.MATCH_PREDICTIONS)
        work.commit()
    finally:
        batch.unpersist()


def read_statistics(log: CommitLog) -> DataFrame:
    """Statistics of all complete micro-batches."""
    return log.read(STATISTICS, schemas.MATCH_STATS)


def read_predictions(log: CommitLog) -> DataFrame:
    """Predictions of all complete micro-batches: the same batches as those of the statistics."""
    return log.read(PREDICTIONS, schemas.MATCH_PREDICTIONS)


def start_match_statistics(
    events: DataFrame,
    path: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start the live job on a stream of enriched events.

    Statistics, and predictions if ``score`` is given, are written below ``path``, a shared folder, and are read with
    ``read_statistics`` and ``read_predictions``. ``ttl_seconds`` forgets matches that are idle for longer.
    """
    log = CommitLog(events.sparkSession, path)

    def process(batch: DataFrame, batch_id: int) -> None:
        work_off(log, batch, batch_id, score, **options)

    writer = events.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
