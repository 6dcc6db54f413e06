"""Session helpers: a tuned SparkSession and the shared scratch folder.

Everything here is plain PySpark configuration. The library never assumes a
machine-local folder on a cluster: scratch output (streaming checkpoints,
materialised stages, sink folders) lives under ``spark.checkpoint.dir``,
which a cluster points at shared storage.  Only when that setting is absent
and the master is ``local[...]`` (unit tests, a laptop) do we create one
ourselves; any other master must set it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# SQL settings the operators rely on.  They are only applied when the user
# has not set them already, so a cluster's own tuning always wins.
SQL_DEFAULTS = {
    # runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn a join into a broadcast once the real size is known
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # every timestamp we emit is computed in UTC
    "spark.sql.session.timeZone": "UTC",
    # Arrow batches for pandas UDFs, of Spark's 10,000 rows where the session sets none
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "riverbend",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` defaults to the environment's; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_scratch(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply ``SQL_DEFAULTS`` to an existing session where unset."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block; what was set before, or unset, comes back."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def ensure_scratch(spark: SparkSession) -> str:
    """Return the shared scratch root, creating a local one only if unset.

    ``spark.checkpoint.dir`` is a static setting (fixed when the session
    starts).  When it is absent and the master is ``local[...]`` (tests, a
    laptop) the root becomes the SparkContext checkpoint folder, set here to
    a fresh local folder that is deleted at exit.  On any other master a
    machine-local folder would lose the parts other executors write, so the
    setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not is_local_master(master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master!r}")
        folder = tempfile.mkdtemp(prefix="riverbend-scratch-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
        root = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def is_local_master(master: str) -> bool:
    """True for masters whose executors share this machine's folders and JVM."""
    return master == "local" or master.startswith("local[")


def join_root(root: str, name: str) -> str:
    """``name`` under ``root``; the root keeps its scheme, ``file:`` too (a
    bare path would resolve against the cluster's default file system)."""
    return root.rstrip("/") + "/" + name


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder path under the shared scratch root.

    Each streaming query and each materialised stage takes its own folder:
    a rerun against an old checkpoint would read nothing.  The folder is
    deleted when the session's JVM ends, or earlier by ``release``.
    """
    path = join_root(ensure_scratch(spark), f"{purpose}-{uuid.uuid4().hex}")
    fs, jpath = _hadoop_path(spark, path)
    fs.deleteOnExit(jpath)
    return path


def ship_package(spark: SparkSession) -> str:
    """Send this package's code to the executors, for workers that don't have
    it on their path: a zip of its modules, added to the session's Python
    files (what ``--py-files`` does at submission).  Returns the zip's name."""
    import os
    import zipfile

    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="riverbend-code-")  # on the driver, which serves it to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "riverbend.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for where, folders, names in os.walk(package):
            folders[:] = sorted(f for f in folders if f != "__pycache__")
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    return os.path.basename(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other trouble raises."""
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(jpath)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return fs.getFileStatus(jpath).isFile()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders directly under ``path`` (none if it is absent)."""
    fs, jpath = _hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return [str(s.getPath().toString()) for s in fs.listStatus(jpath) if s.isDirectory()]


def save(df, purpose: str = "stage") -> tuple:
    """Write ``df`` once as a parquet table under the scratch root; returns
    the table read back and its path (for ``release``)."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete saved tables that nothing will read any more."""
    for path in paths:
        fs, jpath = _hadoop_path(spark, path)
        fs.delete(jpath, True)


def materialize(df, purpose: str = "stage"):
    """Compute ``df`` once and cut its lineage: it is written as a parquet
    table under ``spark.checkpoint.dir`` (shared storage on a cluster) and
    read back, so later stages read the saved rows and a lost executor does
    not re-run the inputs.  One job (``DataFrame.checkpoint`` would compute
    the plan twice unless it was cached first).  Use it for intermediate
    results that several branches read."""
    return save(df, purpose)[0]
