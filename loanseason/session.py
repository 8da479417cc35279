"""Session helpers: checkpoint folder, materialisation, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows a lookup table may have and still be sent to every executor. Lookup rows
# here are a handful of numbers and a short key, so this is a few tens of MB.
BROADCAST_ROW_LIMIT = 500_000


def local_session(cores: int | str = 8, app: str = "loanseason", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    n = str(cores)
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8" if n == "*" else n)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, may fall back to a fresh folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="loanseason-")
    context.setCheckpointDir(fresh)
    return fresh


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps intermediate tables."""
    return f"{shared_folder(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the application's scratch folder."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; frames that rest on them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, cut the lineage, and survive the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Write to a new table below the shared folder and read it back.

    Unlike a checkpoint the result is columnar and carries its true size, which lets
    the planner choose join sides by itself. ``measures`` are aggregates taken while the
    rows are written, so they cost no further pass.
    """
    path = scratch_path(df.sparkSession, name)
    seen = Observation()
    counted = df.observe(seen, F.count("*").alias("rows"), *[m.alias(n) for n, m in measures.items()])
    counted.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get
