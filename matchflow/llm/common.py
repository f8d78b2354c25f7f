"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_kept: dict[str, object] = {}


def once_per_worker(call: str, make: Callable[[], object]):
    """What ``make`` returns, made once per Python worker and call; that of another call is let go."""
    let_go(call)
    if call not in _kept:
        _kept[call] = make()
    return _kept[call]


def let_go(call: str | None = None) -> None:
    """Free what this worker keeps for other calls than ``call``, also where it refers to itself; workers outlive their stages."""
    if _kept and call not in _kept:
        _kept.clear()
        gc.collect()


def map_columns(df: DataFrame, columns: Sequence[str], work: Callable[[Iterator[list[list]]], Iterable[dict]], schema: str) -> DataFrame:
    """Run ``work`` on each partition; it gets lists of Python values per column, batch by batch.

    Batches are limited by bytes besides rows, so that very long texts do not pile up in a worker.
    ``work`` yields dictionaries of columns.
    """
    arrow = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from (pa.RecordBatch.from_pydict(out, schema=arrow) for out in work(part for batch in batches for part in small(batch)))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return df.select(*columns).mapInArrow(run, schema)


def small(batch: pa.RecordBatch) -> Iterator[list[list]]:
    """Slices of a batch with about BATCH_BYTES at most (one row at least), as Python lists."""
    step = max(1, int(batch.num_rows * BATCH_BYTES / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        yield [c.to_pylist() for c in part.columns]


def crc_fold(column: str | Column, folds: int) -> Column:
    """crc32 of the decimal text, modulo ``folds``; null for null."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % folds


def python_crc_fold(value: int, folds: int) -> int:
    return zlib.crc32(str(value).encode()) % folds
