"""Session helpers: a local session for tests and benches, the checkpoint folder,
and how an operator writes a table that is read more than once.

On a cluster the checkpoint folder must be a shared path given by the cluster in
``spark.checkpoint.dir``; only a local session without one gets a fresh folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextvars import ContextVar
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Largest cell-level table broadcast to the executors (bytes in memory, about). Industry
# cells are countries x two-digit codes (x years): tens of thousands of rows in real panels,
# a few MB. A larger table goes through a shuffle join (AQE splits skewed partitions there).
DEFAULT_BROADCAST_BYTES = 64 << 20
BROADCAST_BYTES_CONF = "firmdyn.broadcast.maxBytes"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "firmdyn", driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local[N] session configured like the cluster one (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only where it is unset.

    A cluster must name a shared folder in ``spark.checkpoint.dir``; a local
    session without one (tests, benches) gets a new temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset: name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="firmdyn-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def run_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, inside the shared checkpoint
    folder; it and the application's own checkpoint folder are deleted when the JVM ends."""
    sc = spark.sparkContext
    own = ensure_checkpoint_dir(spark)
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None) or own
    path = f"{base.rstrip('/')}/firmdyn-{sc.applicationId}"
    if path not in _RUN_FOLDERS:
        conf = sc._jsc.hadoopConfiguration()
        for folder in (path, own):
            hadoop = sc._jvm.org.apache.hadoop.fs.Path(folder)
            fs = hadoop.getFileSystem(conf)
            fs.mkdirs(hadoop)
            fs.deleteOnExit(hadoop)
        _RUN_FOLDERS.add(path)
    return path


_RUN_FOLDERS: set[str] = set()


class RunTables:
    """The tables that ``stash`` writes while this is open (``with RunTables(spark) as tables``),
    in the caller's thread and in threads that run in a copy of its context.

    ``drop`` deletes a table once its last reader is done; leaving the block deletes what is
    left of them unless ``keep`` was called, and after an error in any case."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.kept = spark, {}, False

    def add(self, table: DataFrame, path: str) -> None:
        self.paths[path] = table

    def drop(self, *tables: DataFrame | None) -> None:
        for path, table in list(self.paths.items()):
            if any(table is t for t in tables):
                self._delete(path)

    def keep(self) -> None:
        self.kept = True

    def close(self) -> None:
        for path in list(self.paths):
            self._delete(path)

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop, True)
        self.paths.pop(path, None)

    def __enter__(self) -> RunTables:
        self._token = _OPEN_TABLES.set(self)
        return self

    def __exit__(self, failed, *_) -> None:
        _OPEN_TABLES.reset(self._token)
        if failed is not None or not self.kept:
            self.close()


_OPEN_TABLES: ContextVar[RunTables | None] = ContextVar("firmdyn_tables", default=None)


def stash(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as parquet under ``run_folder`` and read it back: cuts the lineage,
    survives lost executors, and later readers prune columns and push filters."""
    return stash_observed(df, *partition_by)[0]


def stash_observed(df: DataFrame, *partition_by: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stash`` that also returns ``metrics`` (always ``rows``) of the written rows."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    obs = Observation(f"firmdyn_{uuid.uuid4().hex}")
    named = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in metrics.items()]
    df.observe(obs, *named).write.partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if (tables := _OPEN_TABLES.get()) is not None:
        tables.add(table, path)
    return table, obs.get


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once under ``run_folder``; for tables that are read more than once or
    whose size decides the next plan."""
    return stash(df)


def materialize_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` that also returns aggregate ``metrics`` over the written rows
    (always ``rows``), gathered by the same job through ``observe``. The observation
    sits in the job's result stage, whose accumulator updates Spark applies once per
    partition, so retried tasks do not count twice."""
    return stash_observed(df, **metrics)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: eight per column, and its texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, StringType)]
    return reduce(add, texts, F.lit(8 * len(df.columns))).cast("long")


def broadcast_limit(spark: SparkSession) -> int:
    value = spark.conf.get(BROADCAST_BYTES_CONF, None)
    return int(value) if value else DEFAULT_BROADCAST_BYTES


def checked_broadcast(df: DataFrame, max_bytes: int | None = None, observed: dict | None = None,
                      **metrics: Column) -> tuple[DataFrame, int]:
    """Materialise ``df``, measure it in the same job, and mark it for broadcast only
    if it takes at most ``max_bytes`` (default: ``firmdyn.broadcast.maxBytes`` or 64 MB).
    Returns the table and its row count; beyond the limit the caller's join stays a
    shuffle join with the same result. ``metrics`` are added to ``observed``."""
    limit = broadcast_limit(df.sparkSession) if max_bytes is None else max_bytes
    table, seen = materialize_observed(df, bytes=F.sum(row_bytes(df)), **metrics)
    if observed is not None:
        observed.update(seen)
    small = (seen["bytes"] or 0) <= limit
    return (F.broadcast(table) if small else table), int(seen["rows"])
