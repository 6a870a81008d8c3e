"""Session defaults and the shared scratch folder.

Every job that cuts lineage or keeps sink state writes below the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is missing
*and* the master is local (tests, laptops) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library expects. Time zone is pinned so that
# date/hour bucketing and formatting do not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of dictionary snapshots and snapshot counts are deleted
    # once no DataFrame refers to them (a stream refreshing its dictionary
    # every 5 minutes would otherwise keep every copy).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "logwise",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster, leave ``shuffle_partitions`` unset and let AQE coalesce from
    the cluster default; locally it is sized to the core count.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process (not so for ``local-cluster``)."""
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``). If unset, a folder is
    created only for local masters; a cluster without the setting is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        root = tempfile.mkdtemp(prefix="logwise-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    else:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/logwise/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``logwise`` importable in executor Python workers.

    Pandas UDFs and ``mapInPandas`` functions refer to helpers of this package
    by name; executors need the package on their path. It is zipped once per
    application and handed to ``addPyFile``, which serves it to every
    executor (the same as ``--py-files`` at submit time).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    # addPyFile serves the file from the driver; only its build is local
    out_dir = tempfile.mkdtemp(prefix="logwise-pyfiles-")
    target = os.path.join(out_dir, "logwise.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
