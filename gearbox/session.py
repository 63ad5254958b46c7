"""Session helpers.

Library code never creates or stops a session; these helpers are for tests,
``bench.py`` and command-line use.  ``shared_dir`` is the single place that
decides where intermediate tables and checkpoints go: the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that is unset on a *local*
master (tests, laptops) do we create our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "gearbox",
                  shuffle_partitions: int = 8, driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs.  On a cluster, use the cluster's own session."""
    builder = SparkSession.builder.master(master or "local[*]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads the checkpoint directory the session already has (set by the
    cluster through ``spark.checkpoint.dir`` or ``setCheckpointDir``).  If it
    is unset and the master is local, a private folder is created and
    registered; on a non-local master an unset directory is an error, because
    a machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: set it to a folder every executor "
            "can reach (HDFS, S3, a shared mount) before running gearbox jobs")
    local = tempfile.mkdtemp(prefix="gearbox-ckpt-")
    folder = sc._jvm.org.apache.hadoop.fs.Path(f"file://{local}")
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(folder)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SCRATCH: dict[str, tuple] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for an intermediate table.

    Results are read lazily, so a table stays until ``release_scratch``; what is left is
    deleted by the driver's JVM when it ends, whether or not the session was stopped before."""
    base = f"{shared_dir(spark).rstrip('/')}/gearbox-tables"
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = paths(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.mkdirs(paths(base)):  # deleteOnExit takes folders that exist
        files.deleteOnExit(paths(base))
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH[path] = files, paths(path)
    return path


def release_scratch(*paths: str) -> None:
    """Delete these intermediate tables (default: all of this process); what was derived
    from them must have been written or collected."""
    for path in paths or list(_SCRATCH):
        files, folder = _SCRATCH.pop(path)
        files.delete(folder, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, as
    ``--py-files`` would: tasks then import it wherever the driver was started."""
    app, package = spark.sparkContext.applicationId, os.path.dirname(os.path.abspath(__file__))
    if app in _SHIPPED or not os.path.isdir(package):  # a package inside a zip was shipped with the application
        return
    name = os.path.basename(package)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-code-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in sorted(os.walk(package)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
