"""Session construction and lineage cutting.

Jobs read ``spark.checkpoint.dir`` from the session (a shared folder on a
cluster).  Only when it is unset -- local runs and tests -- do we create a
scratch folder of our own.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults sized for the target scale; local runs override shuffle partitions.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "lodgeflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_ROOT: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables: the one
    that the session names.  Only where it names none, in local runs and
    tests, one scratch folder is made for the process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and "
                           "intermediate tables must survive the loss of any one machine")
    if not _OWN_ROOT:
        _OWN_ROOT.append(tempfile.mkdtemp(prefix="lodgeflow-ckpt-"))
    return _OWN_ROOT[0]
