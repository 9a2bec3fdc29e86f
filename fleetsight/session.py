"""Session helpers: a sensible local/test session and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "fleetsight", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # re-running one period replaces only the partitions it touches
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # checkpoint files of collected frames are removed with them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    defaults.update(conf)
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, allow_local_default: bool = False) -> str:
    """The shared folder for lineage cuts, as named by the cluster in ``spark.checkpoint.dir``.

    On a cluster the setting must come from the deployment. Only tests and local runs may ask for
    a private default (``allow_local_default=True``), which is created once per session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not allow_local_default or not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="fleetsight-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def session_like(spark: SparkSession, **conf: str) -> SparkSession:
    """Another session with the caller's settings and those of ``conf``; the caller's stay as they are."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in conf.items():
        own.conf.set(key, value)
    return own


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession, allow_local_default=True)
    return df.checkpoint(eager=eager)
