"""Session set-up and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and single-node runs; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("matchflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Set the number of shuffle partitions for jobs over ``input_bytes`` of files.

    Adaptive execution merges partitions that turn out small, but never splits one for a window
    or an aggregate, so the number has to be large enough from the start: about one partition per
    ``partition_bytes`` of compressed input, and never fewer than there are cores.
    """
    wanted = max(-(-input_bytes // partition_bytes), spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back on a temporary folder: on a cluster a machine-local
    folder would be lost with its executor, so a missing setting is an error there.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="matchflow-")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is ever reused or removed."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: short lineage, fixed content."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
