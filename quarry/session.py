"""Session and shared-storage helpers.

Everything here reads settings from the active session first. Local
defaults (``local[*]``, UTC, a scratch checkpoint folder) are applied only
when the setting is absent, which is the case in tests and on a laptop;
on a cluster the operator of the cluster owns these settings.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make plans scale: AQE re-plans joins and partition counts
# from runtime statistics, splits skewed join partitions and coalesces
# small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app_name: str = "quarry", warehouse_dir: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC).

    Managed tables go to a fresh warehouse folder per process unless one is
    given: the in-memory catalog forgets tables between sessions while their
    folders would stay, and a rerun would collide with them.
    """
    warehouse_dir = warehouse_dir or tempfile.mkdtemp(prefix="quarry-warehouse-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", warehouse_dir)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a folder on shared storage
    and is used as is. Only when nothing is configured on a ``local[...]``
    master (tests, a laptop) is a fresh local folder created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not _one_process(master):
            # a driver-local folder is invisible to executors on other machines
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def _one_process(master: str) -> bool:
    """``local`` and ``local[...]``: executors share the driver's disk (a ``local-cluster`` need not)."""
    return master == "local" or master.startswith("local[")


def session_path(spark: SparkSession, name: str) -> str:
    """The path of a named output of this session under the shared checkpoint
    folder: the same on every call, so a rerun replaces its output."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-scratch/{spark.sparkContext.applicationId}/{name}"


def clear_session_storage(spark: SparkSession) -> None:
    """Remove what the session's queries have written: its folder under the
    checkpoint folder and its tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_path(spark, ""))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if spark.catalog.databaseExists("quarry_work"):
        for t in spark.catalog.listTables("quarry_work"):
            if not t.isTemporary and t.name.endswith(_session_suffix(spark)):
                spark.sql(f"DROP TABLE IF EXISTS `quarry_work`.`{t.name}`")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used by sink round trips so that written files land on storage every
    executor can read, never on a machine-local temporary folder.
    """
    root = ensure_checkpoint_dir(spark)
    # The SparkContext may hold the path with a scheme and a uuid suffix.
    root = root.rstrip("/")
    return f"{root}/quarry-scratch/{name}-{uuid.uuid4().hex[:12]}"


def workspace_db(spark: SparkSession, name: str = "quarry_work") -> str:
    """Create (if needed) the database used for managed tables and return it.

    On a cluster ``spark.sql.warehouse.dir`` has to name shared storage; its
    default is a folder of the driver's machine and is refused."""
    sc = spark.sparkContext
    if not _one_process(sc.master) and not sc.getConf().contains("spark.sql.warehouse.dir"):
        raise RuntimeError("set spark.sql.warehouse.dir to a folder on shared storage")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return name


def _session_suffix(spark: SparkSession) -> str:
    return re.sub(r"\W", "_", spark.sparkContext.applicationId.lower())


def session_table(spark: SparkSession, stem: str, db: str | None = None) -> str:
    """The fully qualified name of a table of this session: the same on every
    call (a rerun replaces the table), different in every session (a table
    folder that another session left is never in the way)."""
    return f"`{db or workspace_db(spark)}`.`{stem}_{_session_suffix(spark)}`"
