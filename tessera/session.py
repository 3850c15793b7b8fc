"""Session helpers: a local session for tests/bench and the shared scratch folder.

The library never creates machine-local scratch space on a cluster: every
materialised intermediate goes below the folder the session names in
``spark.checkpoint.dir``. Only when that setting is absent (local tests) is
one created here.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "tessera", shuffle_partitions: int | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """A ``local[cores]`` session with AQE on and the UI off (tests and bench)."""
    parts = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        # Unset on a local master (tests): make a private folder for this process.
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, for written intermediates.

    They lie in one folder per application, which the driver's JVM deletes when it ends.
    """
    sc = spark.sparkContext
    root = os.path.join(ensure_checkpoint_dir(spark), f"tables-{sc.applicationId}")
    if root not in _SCRATCH:
        folder = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _SCRATCH.add(root)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


_SCRATCH: set[str] = set()
_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable on every executor (once per SparkContext) via ``addPyFile``.

    Arrow UDFs and ``mapInPandas`` functions reference this package's modules;
    on a cluster the executors receive it as a zip through Spark's file server.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="tessera-pkg-")  # driver-side staging of the artifact only
    archive = shutil.make_archive(os.path.join(staging, "tessera"), "zip", os.path.dirname(pkg_dir), "tessera")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
