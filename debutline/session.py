"""Session set-up and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "debutline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # hot join keys are split at run time, also when that costs one more shuffle
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # models that are fitted side by side take turns
        "spark.scheduler.mode": "FAIR",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A folder of our own is made only for a local master, where one machine is the whole cluster.
    """
    named = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getConf().get(SHARED_DIR_KEY)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="debutline-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_writing: dict[SparkSession, tuple[int, str | None]] = {}
_writing_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run in here go when it ends; Spark keeps them until its driver collects garbage. Threads may be in here side by side."""
    with _writing_lock:
        inside, before = _writing.get(spark, (0, spark.conf.get(CLEANUP_KEY, None)))
        _writing[spark] = inside + 1, before
        spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        with _writing_lock:
            inside, before = _writing.pop(spark)
            if inside > 1:
                _writing[spark] = inside - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP_KEY)
            else:
                spark.conf.set(CLEANUP_KEY, before)


def cut_lineage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back, so that retries start from files. The shuffles behind it are needed no longer.

    Who gives a `path` of `scratch_path` can `discard` it later.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Drop folders of the shared folder that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows, by keys if there are any, to a few tasks a core. For rows of few bytes and much work each, of which Spark would give millions to one task."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)
