"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings the semantics depend on (not tuning): UTC day arithmetic and the
# ANSI casts the adapters are written against.
_SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Tuning for scale; every value can be overridden by the cluster config.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "playlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    conf.update(_SEMANTIC_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_semantics(spark)
    return spark


def pin_semantics(spark: SparkSession) -> None:
    """Set the settings the results depend on, on an existing session."""
    for k, v in _SEMANTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


_LOCAL_BASE: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; a checkpoint directory
    set on the context is honoured too.  Only a local master, as in tests, may
    do without: it gets a temporary folder that goes when the process ends.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL_BASE.get(sc.applicationId)
        if base is None:
            base = _LOCAL_BASE[sc.applicationId] = tempfile.mkdtemp(prefix="playlens-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base.rstrip("/") + "/rdd")
    return base.rstrip("/") + "/" + name
