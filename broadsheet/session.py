"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


# Scratch folders handed out, for ``clear_scratch``, and those of the innermost ``passing_scratch`` of a thread.
_WRITTEN: list[str] = []
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)
# Scratch folders of applications whose session names none.
_OWN_ROOT: dict[str, str] = {}


def get_session(app: str = "broadsheet", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with the adaptive settings the operators are planned for.

    Partition counts are left to adaptive execution: start from many shuffle
    partitions and let it coalesce small ones and split skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a skewed anti or semi join even when the split costs a shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and landed tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, laptops) a temporary folder is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _OWN_ROOT:
        _OWN_ROOT[application] = tempfile.mkdtemp(prefix="broadsheet-")
    return _OWN_ROOT[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    passing = _PASSING.get()
    (_WRITTEN if passing is None else passing).append(path)
    return path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Costly rows are then made once, and losing an executor later costs a read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete on leaving, by an error too, what this thread wrote to scratch inside, but for settled tables that are kept.

    Gives the function that keeps one. Nothing lazy may leave that reads the others.
    What other threads write meanwhile is theirs.
    """
    outer, kept = _PASSING.get(), set()
    token = _PASSING.set([])

    def keep(settled: DataFrame) -> DataFrame:
        kept.add(settled._scratch_path)
        return settled

    try:
        yield keep
    finally:
        written = _PASSING.get() or []
        _PASSING.reset(token)
        for path in written:
            if path not in kept:
                remove(spark, path)
        (_WRITTEN if outer is None else outer).extend(sorted(kept))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can write to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written under the scratch folder so far."""
    while _WRITTEN:
        remove(spark, _WRITTEN.pop())
