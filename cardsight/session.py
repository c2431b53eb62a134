"""Session construction and shared scratch locations.

Scratch output (sinks that are re-read, checkpoints that cut lineage) always
goes under the folder the cluster names in ``spark.checkpoint.dir``: that
folder is shared by all executors, so a lost executor cannot lose the data.
Only on one machine (a ``local`` master, as in tests) do we pick our own when
the setting is absent; on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "cardsight",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with UTC time, ANSI and AQE switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Spark checkpoints into a per-application subfolder of it; tables that must
    outlive one application (runs, models, trials) live in the folder itself.
    A folder of our own is chosen only on one machine, when the session names none.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = sc.getCheckpointDir()
        if current:
            return os.path.dirname(current.rstrip("/"))
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # One machine only: its own folder is shared by all of its tasks.
        configured = tempfile.mkdtemp(prefix="cardsight-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def materialize(df):
    """``df.checkpoint()`` into the shared folder, making sure it is set: cuts
    the lineage, and the written data survives the loss of any executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint root for sink output."""
    root = checkpoint_root(spark)
    return os.path.join(root, "cardsight-out", f"{label}-{uuid.uuid4().hex}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    Python tasks import it by name; on a cluster only the driver has it on its
    path, whatever folder the job was started from.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cardsight-py-")), "cardsight.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
