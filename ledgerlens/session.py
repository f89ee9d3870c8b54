"""Spark session settings used by the library, the tests and the benchmark.

Library code never hard-codes a master, a partition count or a path: on a
cluster the session comes from the platform and only the settings below that
are still unset get a default.  Tests and the benchmark build a local session
through :func:`local_session`.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every query in the package relies on.  UTC matters for the epoch
# casts of the replay sources and for ``date_trunc``; AQE re-plans joins and
# coalesces shuffle partitions from runtime sizes and splits skewed partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_shipped: set[str] = set()


def session_key(spark: SparkSession) -> str:
    """A key that identifies the running application (classic or Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return f"session-{spark.conf.get('spark.app.name', '')}-{id(spark)}"


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerlens`` importable in executors' Python workers (once per app).

    Pandas UDFs defined in the package are pickled by reference, so workers
    must be able to import it.  The package is zipped on the driver and
    distributed with ``addPyFile``, as ``--py-files`` would on a cluster.
    """
    app = session_key(spark)
    if app in _shipped:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="ledgerlens-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "ledgerlens"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="ledgerlens")
    try:
        spark.sparkContext.addPyFile(archive)
    except Exception:  # noqa: BLE001 - Spark Connect: ship as a session artifact
        spark.addArtifacts(archive, pyfile=True)
    _shipped.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`REQUIRED_CONF` to an existing session and ship the package (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir``; on a cluster that setting names a
    shared file system.  Only when it is unset (local tests) a fresh folder
    under the system temp dir is taken and recorded in the session; any other
    master raises, as executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[[^,\]]*(,[^\]]*)?\])?$", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001 - Spark Connect reads spark.checkpoint.dir itself
        pass
    return root


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (never used by library code)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Small local files: a 4 MB open cost would pack a 10 MB table into three
        # splits and leave cores idle.  (On a cluster the 128 MB default split
        # size governs and this setting has no effect.)
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        # Remove reliable checkpoint files once their DataFrames are garbage.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def recommended_conf(input_bytes: float, executors: int, cores_per_executor: int,
                     executor_memory_gb: float = 16.0) -> dict[str, str]:
    """Partition sizing for a cluster run (not applied automatically).

    * scan splits of 256 MB: ~400k tasks for 100 TB, each well inside an
      executor core's share of memory after parquet decompression;
    * shuffle partitions so that a partition holds ~200 MB of the (partially
      aggregated) shuffle when a third of the input reaches the exchange, at
      least twice the core count, and a multiple of it;
    * AQE coalesces small partitions towards 128 MB and splits partitions more
      than 5x the median (and above 512 MB) -- the hot-key case.
    """
    cores = max(1, executors * cores_per_executor)
    per_core_mem = executor_memory_gb * (1 << 30) / max(1, cores_per_executor)
    target = min(200 * (1 << 20), per_core_mem / 4)
    shuffle = max(2 * cores, int(input_bytes / 3 / target))
    shuffle = ((shuffle + cores - 1) // cores) * cores
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * (1 << 20)),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * (1 << 20)),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * (1 << 20)),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * (1 << 20)),
        "spark.sql.session.timeZone": "UTC",
    }
