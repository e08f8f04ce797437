"""Session helpers.

On a cluster the session comes from the platform; ``local_session`` exists for
tests and the bench.  Nothing here overrides a setting the cluster already has.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every query in the library relies on.  Applied only when unset.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidepool") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply library defaults that the session does not already set."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it.  Where it is unset only a local session, whose tasks
    run on the driver's machine, gets a temporary folder; elsewhere that would
    be a folder the executors cannot see, and it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d and re.match(r"local(\[|$)", sc.master):
        d = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    if not d:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per session.

    Needed where the package is not installed on the executors.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tidepool_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tidepool-src-"), "tidepool.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(out)  # Spark serves the file to the executors
    sc._tidepool_shipped = True
