"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything is a runtime SQL setting, so it can be applied to a session that
# somebody else created as well.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above this size; wide projections run much
    # faster split into several methods than as one interpreted loop.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Session windows of one key are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "lumenmart", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; clusters bring their own."""
    n = os.cpu_count() or 8 if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_fallback_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, read from the session.

    Only a local session may do without the setting or name a folder of the
    machine: on a cluster such a folder would be invisible to other machines.
    A local session without the setting gets one temporary folder, which goes
    when the process ends.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _fallback_root:
        _fallback_root[app] = tempfile.mkdtemp(prefix="lumenmart-")
        atexit.register(shutil.rmtree, _fallback_root[app], ignore_errors=True)
    return _fallback_root[app]


def shared_dir(spark: SparkSession, name: str) -> str:
    """The name of a fresh folder below ``shared_root``."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
