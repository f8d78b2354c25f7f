"""What a live job has written: one record per micro-batch for all of its tables and states.

A micro-batch writes each table to a folder of its own; then one record that names the folders is published in a single
step. Readers go by the records, so they meet all tables of a batch or none of them, also while a batch runs again: what an
attempt that failed has left behind is named by no record, and a batch whose record is there is not worked on again.

States of groups lie in hash buckets. A micro-batch reads the buckets that its groups fall into and adds rows for these groups
alone, so what it writes does not grow with the groups that are idle. The record lists, for every bucket, the folders that hold
rows of it, the newest last; a bucket with MAX_FOLDERS of them is written anew as one, without the groups idle for too long.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchflow.sinks.tables import conform

BUCKETS = 64
MAX_FOLDERS = 16
_BUCKET, _BATCH = "__bucket", "__batch"


class CommitLog:
    """Records of the micro-batches of one job, in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def record(self, batch_id: int) -> dict | None:
        """The record of a micro-batch, if it has been published."""
        files, path = self._file(f"{batch_id:012d}.json")
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, batch_id: int, record: dict) -> None:
        """Make a record visible; it is written under a hidden name first."""
        files, draft = self._file(f".{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        if not files.rename(draft, self._file(f"{batch_id:012d}.json")[1]):
            raise RuntimeError(f"the record of micro-batch {batch_id} could not be published")

    def begin(self, batch_id: int) -> MicroBatch | None:
        """Work on a micro-batch; nothing if it is complete already."""
        if self.record(batch_id) is not None:
            return None
        before = self.record(batch_id - 1) if batch_id else None
        if batch_id and before is None:
            raise RuntimeError(f"micro-batch {batch_id} comes without a record of the one before in {self.path}")
        return MicroBatch(self, batch_id, (before or {}).get("states", {}))

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The complete micro-batches of a table, with their number as batch_id; without ``schema`` that of the last batch counts."""
        records = self.spark.read.schema("batch_id bigint, tables map<string,string>").json(f"{self.path}/commits")
        folders = [r[1] for r in records.select("batch_id", F.try_element_at("tables", F.lit(table)).alias("f")).where(F.col("f").isNotNull()).orderBy("batch_id").collect()]
        if schema is None:
            if not folders:
                raise ValueError(f"no micro-batch has written {table} yet, so its schema is not known")
            schema = self.spark.read.parquet(folders[-1]).schema
        if not folders:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())]))
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*folders)


class MicroBatch:
    """Tables and states of one micro-batch, which count together once it is committed."""

    def __init__(self, log: CommitLog, batch_id: int, states: dict):
        self.log, self.batch_id, self.spark = log, batch_id, log.spark
        self.tables: dict[str, str] = {}
        self.states = dict(states)
        self.touched: dict[tuple, list[int]] = {}

    def folder(self, name: str) -> str:
        return f"{self.log.path}/{name}/batch_id={self.batch_id}/{uuid.uuid4().hex}"

    def write(self, table: str, rows: DataFrame, schema: T.StructType | None = None) -> DataFrame:
        """Add the rows to a table, and return them as they have been written."""
        rows = conform(rows, schema) if schema else rows
        self.tables[table] = self.folder(table)
        rows.write.parquet(self.tables[table])
        return self.spark.read.schema(rows.schema).parquet(self.tables[table])

    def state(self, name: str, keys: Sequence[str], seen: Column | None = None, ttl_seconds: int | None = None, buckets: int = BUCKETS) -> CarriedState:
        """The state ``name``, whose groups are forgotten ``ttl_seconds`` after the time ``seen`` (unix seconds)."""
        alive = None if ttl_seconds is None else seen >= F.unix_timestamp(F.current_timestamp()) - ttl_seconds
        return CarriedState(self, name, keys, alive, buckets)

    def commit(self) -> None:
        self.log.publish(self.batch_id, {"batch_id": self.batch_id, "tables": self.tables, "states": self.states})


class CarriedState:
    """One row per group of ``operators.running``'s state, carried from micro-batch to micro-batch."""

    def __init__(self, batch: MicroBatch, name: str, keys: Sequence[str], alive: Column | None = None, buckets: int = BUCKETS):
        self.batch, self.name, self.keys, self.alive = batch, name, list(keys), alive
        self.entry = batch.states.get(name) or {"buckets": buckets, "folders": {}, "schema": None}
        self.touched: list[int] | None = None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.entry["buckets"])).cast("int")

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in self.keys])

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The newest row of every live group in these buckets, or in all; nothing if there is no state yet."""
        chosen = {int(b): f for b, f in self.entry["folders"].items() if buckets is None or int(b) in set(buckets)}
        if self.entry["schema"] is None or not chosen:
            return None
        schema = T.StructType.fromJson(json.loads(self.entry["schema"]))
        stored = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
        rows = None
        for folder in sorted({f for folders in chosen.values() for f in folders}):  # at most a few per bucket
            mine = [b for b, folders in chosen.items() if folder in folders]
            part = self.batch.spark.read.schema(stored).parquet(folder).where(F.col(_BUCKET).isin(mine))
            rows = part if rows is None else rows.unionByName(part)
        others = [c for c in schema.names if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*others), _BATCH).alias("__row")).select(*self.keys, "__row.*")
        return newest if self.alive is None else newest.where(self.alive)

    def before(self, rows: DataFrame) -> DataFrame | None:
        """The state of the groups that ``rows`` belong to."""
        if self.entry["schema"] is None:
            return None
        known = self.batch.touched  # states with the same keys share their buckets
        place = (*self.keys, self.entry["buckets"])
        if place not in known:
            known[place] = [r[0] for r in rows.select(self._bucket()).distinct().collect()]
        self.touched = known[place]
        old = self.read(self.touched)
        if old is None:
            return None
        groups = rows.select(*self.keys).distinct()
        return old.join(groups, self._same(old, groups), "left_semi")

    def after(self, state: DataFrame) -> None:
        """Add the new state of the groups that ``before`` was asked for."""
        full = [b for b in self.touched or () if len(self.entry["folders"].get(str(b), [])) >= MAX_FOLDERS]
        schema = state.schema
        old = self.read(full) if full else None
        if old is not None:
            state = state.unionByName(old.join(state, self._same(old, state), "left_anti"))
        folder = self.batch.folder(f"states/{self.name}")
        stored = state.withColumns({_BATCH: F.lit(self.batch.batch_id).cast("bigint"), _BUCKET: self._bucket()})
        stored.repartition(F.col(_BUCKET)).sortWithinPartitions(_BUCKET).write.parquet(folder)  # sorted, so that reads skip what they can
        if self.touched is None:  # the first rows of this state
            written = self.batch.spark.read.schema(stored.schema).parquet(folder)
            self.touched = [r[0] for r in written.select(_BUCKET).distinct().collect()]
        folders = dict(self.entry["folders"])
        for b in self.touched:
            folders[str(b)] = [folder] if b in full else [*folders.get(str(b), []), folder]
        self.entry = {"buckets": self.entry["buckets"], "folders": folders, "schema": schema.json()}
        self.batch.states[self.name] = self.entry
