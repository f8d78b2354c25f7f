"""Live laps: running position statistics per race and driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchflow import schemas
from matchflow.operators.laps import position_statistics
from matchflow.operators.running import High, advance, running
from matchflow.sources.messages import accepted, split_messages
from matchflow.sources.nested import flatten_laps
from matchflow.streaming.commits import CarriedState, CommitLog

KEY, ORDER = ["race_id", "driver"], ["lap"]


def parse_laps(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per race, lap and driver of nested lap messages; the input may be a stream."""
    laps = flatten_laps(accepted(split_messages(messages, schemas.LAPS_DOCUMENT, value)), "message")
    return laps.withColumn("driver", F.col("driver").cast("bigint"))


#: Table of the live job, and its schema.
STATISTICS = "statistics"
LIVE_STATS = T.StructType([T.StructField("race_id", T.StringType()), *schemas.LAP_STATS.fields])


def lap_statistics(laps: DataFrame, state: CarriedState | None = None, ddof: int = 0) -> DataFrame:
    """Statistics of all positions up to each lap of a micro-batch; moves the state on."""
    stats = position_statistics("position", ddof) | {"__seen": High(F.unix_timestamp(F.current_timestamp()))}
    before = state.before(laps) if state else None
    out = running(laps, KEY, ORDER, stats, initial=before)
    if state:
        state.after(advance(laps, KEY, ORDER, stats, before))
    return out.drop("__seen")


def work_off(log: CommitLog, batch: DataFrame, batch_id: int, ddof: int = 0, ttl_seconds: int | None = None) -> None:
    """Write the statistics of a micro-batch and commit them with the state; nothing if that is done already."""
    work = log.begin(batch_id)
    if work is None:
        return
    batch = batch.persist()
    try:
        seen = F.col(f"__s{len(position_statistics('position', ddof))}.v")  # the time is the statistic behind these
        state = work.state("laps", KEY, seen, ttl_seconds)
        work.write(STATISTICS, lap_statistics(batch, state, ddof), LIVE_STATS)
        work.commit()
    finally:
        batch.unpersist()


def read_statistics(log: CommitLog) -> DataFrame:
    """Statistics of all complete micro-batches."""
    return log.read(STATISTICS, LIVE_STATS)


def start_lap_statistics(
    laps: DataFrame, path: str, checkpoint: str, ddof: int = 0, trigger: dict | None = None, ttl_seconds: int | None = None
) -> StreamingQuery:
    """Start the live job on a stream of laps; ``path`` and ``checkpoint`` must be shared folders.

    ``ttl_seconds`` forgets drivers without laps for longer.
    """
    log = CommitLog(laps.sparkSession, path)

    def process(batch: DataFrame, batch_id: int) -> None:
        work_off(log, batch, batch_id, ddof, ttl_seconds)

    writer = laps.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
