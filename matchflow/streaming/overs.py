"""Live cricket: cumulative score per match with gap imputation and late or repeated input dropped.

Everything that needs only one over (runs, wickets, teams, flags, rates) is a native projection.
The part that needs earlier overs is a stateful processor keyed by match. A match has at most
40 overs; the processor takes out repeats while it reads its input row by row, so it holds no
more than that however often a message is repeated. A match has few rows per micro-batch, so it
works on plain rows: frames would cost more per match than the overs themselves. Overs that it does not count leave it in the
same pass, with the reason, and go to a table of their own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from matchflow import schemas
from matchflow.functions import cricket
from matchflow.functions.columns import season_number
from matchflow.operators.overs import document_rows, with_rates
from matchflow.sources.messages import accepted, split_messages, unreadable
from matchflow.streaming.commits import CommitLog

# fixed values: mean runs and wickets per over and inning that fill skipped overs by default
MEAN_RUNS = {1: 7.61, 2: 7.29}
MEAN_WICKETS = {1: 0.36, 2: 0.34}

_STATE = "score1 long, wickets1 long, score2 long, wickets2 long, inning long, over long, last_over1 long, counted1 long, counted2 long"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

CARRIED = [
    "cumulative_score", "cumulative_wickets", "first_inning_total_score", "first_inning_total_wickets",
    "first_inning_last_over",
]
LATE, REPEATED, IDLE = "late", "repeated", "idle"
BITS = 63  # overs of an inning that are remembered one by one
STATISTICS, DROPPED = "statistics", "dropped"  # tables of the live job

# the class is sent to the executors by value, so they need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _nulls_last(values: Iterable) -> list[tuple]:
    return [(v is None, v or 0) for v in values]


def _value(row: Row) -> list[tuple]:
    return _nulls_last((row["over_runs"], row["over_wickets"]))


class OverProcessor(StatefulProcessor):
    """Adds the score carried over from earlier overs to each over of a match.

    Each input row leaves once, in ``dropped`` the reason why it does not count: late (an over or inning behind it has begun)
    or repeated (it has been counted). A match without input for ``ttl_ms`` is forgotten by a timer, which gives one row
    with its totals and the reason idle.
    """

    def __init__(self, columns: list[str], mean_runs: dict, mean_wickets: dict, ttl_ms: int | None = None):
        self.columns = columns
        self.mean_runs = mean_runs
        self.mean_wickets = mean_wickets
        self.ttl_ms = ttl_ms
        self.made = Row(*columns, *CARRIED, "dropped")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("match", _STATE)

    def _out(self, row: Row, reason: str | None, carried: tuple = (None,) * len(CARRIED)) -> Row:
        return self.made(*[row[c] for c in self.columns], *carried, reason)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first: dict[tuple, Row] = {}
        for row in rows:
            # of different copies of an over the one with the most runs, then wickets, counts
            place = (row["inning"], row["over"])
            other = first.get(place)
            if other is None:
                first[place] = row
                continue
            if _value(row) >= _value(other):
                first[place], row = row, other
            yield self._out(row, REPEATED)

        s1, w1, s2, w2, inning, over, last1, c1, c2 = self.state.get() or (0, 0, 0, 0, None, None, None, 0, 0)
        score, wickets, counted = {1: s1, 2: s2}, {1: w1, 2: w2}, {1: c1, 2: c2}
        for place in sorted(first, key=_nulls_last):
            row = first[place]
            now, number = int(row["inning"]), int(row["over"])
            bit = 1 << number if 0 <= number < BITS else 0
            if inning is not None and (now, number) <= (inning, over):
                yield self._out(row, REPEATED if counted[now] & bit or (now, number) == (inning, over) else LATE)
                continue
            if now == inning and number > over + 1:
                skipped = number - over - 1
                score[now] += int(skipped * self.mean_runs[now])
                wickets[now] += int(skipped * self.mean_wickets[now])
            score[now] += int(row["over_runs"])
            wickets[now] += int(row["over_wickets"])
            counted[now] |= bit
            inning, over = now, number
            if now == 1:
                last1 = number
            second = now == 2
            yield self._out(row, None, (score[now], wickets[now], score[1] * second, wickets[1] * second, last1 if second else None))
        if inning is not None:
            self.state.update((score[1], wickets[1], score[2], wickets[2], inning, over, last1, counted[1], counted[2]))
        if self.ttl_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        state = self.state.get()
        if state is None:
            return
        s1, w1, s2, w2, inning, over, last1, _, _ = state
        self.state.clear()
        second = inning == 2
        row = dict.fromkeys(self.columns) | {"match_id": key[0], "inning": inning, "over": over}
        yield self._out(row, IDLE, (s2 if second else s1, w2 if second else w1, s1 * second, w1 * second, last1 if second else None))

    def close(self) -> None:
        pass


def parse_overs(messages: DataFrame, value: str = "value", season_mode: str = "stream") -> DataFrame:
    """One row per over message; the team that bats first and the inning follow from the toss.

    Messages that lack what an over needs are left out and are found by ``rejected_overs``, so that one of them does not
    end the stream.
    """
    parsed = accepted(split_messages(messages, schemas.OVER_DOCUMENT, value))
    documents = parsed.filter(_lacks(season_mode).isNull()).select("message.*")
    return document_rows(documents, inning=None, season_mode=season_mode).drop("players", "winner")


def _lacks(season_mode: str) -> Column:
    """Why a parsed message is no over; null if it is one."""
    season = F.col("message.season")
    no_season = season.isNotNull() & season_number(season, season_mode, strict=False).isNull()
    reason = F.when(no_season, "season cannot be read")
    for name in ("deliveries", "players", "team", "over_number", "match_id"):
        reason = F.when(F.col(f"message.{name}").isNull(), f"no {name}").otherwise(reason)
    return reason


def rejected_overs(messages: DataFrame, value: str = "value", season_mode: str = "stream") -> DataFrame:
    """Messages that give no over, with the reason, for a dead-letter table; batch or stream."""
    parsed = split_messages(messages, schemas.OVER_DOCUMENT, value)
    reason = F.when(F.col("is_object"), _lacks(season_mode)).otherwise(unreadable(value))
    return parsed.select(*messages.columns, reason.alias("reason")).filter(F.col("reason").isNotNull())


def tagged_overs(
    overs: DataFrame,
    mean_runs: dict | None = None,
    mean_wickets: dict | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """All overs of a match with score and wickets so far and the first inning's totals; stream or batch input.

    ``dropped`` is null for the overs that count and else says why one does not (late, repeated); its totals are null. Skipped
    overs add the mean runs and wickets per over, truncated to whole numbers. Overs without a match are left out. With
    ``ttl_ms`` a match that is idle for longer is forgotten and gives a last row, tagged idle.
    """
    overs = overs.filter(F.col("match_id").isNotNull())
    columns = overs.columns
    processor = OverProcessor(columns, mean_runs or MEAN_RUNS, mean_wickets or MEAN_WICKETS, ttl_ms)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in overs.schema.fields]
    schema = ", ".join([*fields, *[f"{name} bigint" for name in CARRIED], "dropped string"])
    time_mode = "ProcessingTime" if ttl_ms else "None"
    return overs.groupBy("match_id").transformWithState(processor, schema, "Append", time_mode)


def carry_overs(overs: DataFrame, **options) -> DataFrame:
    """The overs of ``tagged_overs`` that count."""
    return tagged_overs(overs, **options).filter(F.col("dropped").isNull()).drop("dropped")


def with_statistics(carried: DataFrame, mode: str = "stream", wicket_cap: int | None = cricket.MAX_WICKETS) -> DataFrame:
    """Rates per over of carried totals; shown wickets are capped, carried ones are not."""
    rate = cricket.first_inning_rate(
        mode, F.col("first_inning_total_score"), F.col("first_inning_total_wickets"), F.col("first_inning_last_over")
    )
    carried = carried.withColumn("first_inning_run_rate", F.when(F.col("inning") == 2, rate).otherwise(F.lit(0.0)))
    if wicket_cap is not None:
        carried = carried.withColumn("cumulative_wickets", F.least("cumulative_wickets", F.lit(wicket_cap)))
    return with_rates(carried.drop("first_inning_last_over", "over_runs", "over_wickets"))


def over_statistics(overs: DataFrame, mode: str = "stream", wicket_cap: int | None = cricket.MAX_WICKETS, **options) -> DataFrame:
    """Carried totals and rates of the overs that count."""
    return with_statistics(carry_overs(overs, **options), mode, wicket_cap)


def dropped_overs(tagged: DataFrame) -> DataFrame:
    """Overs that do not count, with the reason, and the totals of matches that were forgotten."""
    return tagged.filter(F.col("dropped").isNotNull()).select("match_id", "inning", "over", "over_runs", "over_wickets", "dropped", *CARRIED[:2])


def start_over_statistics(
    overs: DataFrame,
    path: str,
    checkpoint: str,
    score=None,
    trigger: dict | None = None,
    mode: str = "stream",
    wicket_cap: int | None = cricket.MAX_WICKETS,
    **options,
) -> StreamingQuery:
    """Start the live job on a stream of over rows; ``score`` adds the predicted winner.

    Statistics and dropped overs of a micro-batch are committed together below ``path``; read them with ``read_overs``. With
    ``ttl_ms`` timers need micro-batches without input, which a trigger that ends with its input would never stop to start.
    """
    spark = overs.sparkSession
    idle = options.get("ttl_ms")
    trigger = trigger or ({"processingTime": "10 seconds"} if idle else {"availableNow": True})
    if idle and "processingTime" not in trigger:
        raise ValueError("ttl_ms needs a processingTime trigger")
    spark.conf.set(_PROVIDER, _ROCKSDB)  # the stateful API needs this store
    log = CommitLog(spark, path)

    def process(batch: DataFrame, batch_id: int) -> None:
        work = log.begin(batch_id)
        if work is None:
            return
        batch = batch.persist()  # read for both tables
        try:
            if batch.isEmpty():
                return work.commit()
            stats = with_statistics(batch.filter(F.col("dropped").isNull()).drop("dropped"), mode, wicket_cap)
            work.write(STATISTICS, stats if score is None else score(stats))
            work.write(DROPPED, dropped_overs(batch))
            work.commit()
        finally:
            batch.unpersist()

    writer = tagged_overs(overs, **options).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def read_overs(log: CommitLog, table: str = STATISTICS) -> DataFrame:
    """The complete micro-batches of a table of the live job."""
    return log.read(table)
