"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan in this package relies on. They can all be changed on a live
# session, so they are also applied to sessions that somebody else started.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Of a key that a JSON object repeats, the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split hot join partition is worth the extra shuffle it may cause downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_local_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a running session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the package settings.

    Keyword names use ``__`` for the dots of a Spark setting, e.g. ``spark__driver__memory="8g"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine, because there the driver
    and the executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if "base" not in _local_scratch:
            _local_scratch["base"] = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, _local_scratch["base"], ignore_errors=True)
        base = _local_scratch["base"]
    return f"{base.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"
