"""Session set-up shared by the jobs, the tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
ADAPTIVE = "spark.sql.adaptive.enabled"
BROADCAST_THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
# In how many parts files are read, at least.
FILE_PARTITIONS = "spark.sql.files.minPartitionNum"
# Whether lists are gathered in a hash table (a small one, then by sorting) or by sorting alone.
OBJECT_HASH = "spark.sql.execution.useObjectHashAggregateExec"
# Lets adaptive execution merge small partitions of what is cached, too.
MERGE_CACHED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"

# Largest row count this library ever hints for a broadcast.  The sides it is
# used for have a handful of narrow columns, so this stays within tens of MB.
BROADCAST_ROWS = 1_000_000


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library relies on.

    ``settings`` override or add Spark properties; the ones given on
    ``spark-submit`` stay in force unless named here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(MERGE_CACHED, "true")
        # Rank rounds are checkpointed: keep the files small, and drop those of
        # rounds nobody refers to any more.
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.checkpoint.compress", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone: trip times are wall-clock values without a zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; fall back only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="velorank-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """URI of a new folder, below the checkpoint folder all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """Run a block of eager steps with one SQL setting changed."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def broadcast_if_small(df: DataFrame, rows_at_most: int | None = None) -> DataFrame:
    """Hint a broadcast only for a side whose row count is known to be bounded.

    ``rows_at_most`` is the bound the caller can prove.  Without one the rows
    are counted, and the count itself stops just past the limit.  A larger side
    is returned unhinted, so Spark shuffles it and splits hot keys at run time.
    """
    if rows_at_most is None:
        rows_at_most = df.limit(BROADCAST_ROWS + 1).count()
    return F.broadcast(df) if rows_at_most <= BROADCAST_ROWS else df
