"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that a running session can still take over.
RUNTIME = {
    # The JIT compiler skips methods of more than 8,000 bytes. Wide projections fused into one stage pass
    # that and would run interpreted; above the limit Spark generates one smaller class per operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Sessions of a hot user collapse inside each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
DEFAULTS = {
    **RUNTIME,
    "spark.sql.session.timeZone": "UTC",
    # State for windows and sessions lives off-heap, so it may outgrow the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.streaming.stopGracefullyOnShutdown": "true",
}


_OWN: list[str] = []


def build_session(app: str = "editengine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Put the results' time zone, and the settings its owner left open, into an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for checkpoints, streams and written tables.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Local sessions without that
    setting share one folder of the process, which goes when it ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="editengine-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        base = _OWN[0]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows out of a table in the shared folder: computed once, the same for every later reader."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
