"""SparkSession helpers: one place for the settings every job relies on."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "riskframe", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one with our defaults if needed."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session (the cluster's shared
    location). Only when it is unset (local runs, tests) a private temporary
    folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="riskframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system Spark reaches it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def table_files(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(path, modification time, bytes) of every file of a table: tells whether it was rewritten."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getModificationTime(), f.getLen()))
    return tuple(sorted(out))


def local_dir_or(path: str) -> str:
    if path.startswith("file:") or "://" in path:
        return path
    os.makedirs(path, exist_ok=True)
    return path


def materialize(df):
    """Cut lineage for a table that several branches of a plan read.

    Reliable checkpoint into the shared checkpoint folder: later stages read
    the written blocks instead of recomputing the upstream scans and shuffles,
    and a lost executor does not force recomputation from the sources.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """`df` written as Parquet below the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `riskframe` importable in Python workers (what --py-files does).

    The package is zipped once per application into the shared checkpoint
    folder and added with `addPyFile`, so Arrow-batch tasks (`mapInPandas`)
    can unpickle functions defined in it on any executor.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target = scratch_path(spark, "pyfiles")
    local_dir = tempfile.mkdtemp(prefix="riskframe-pkg-")
    archive = shutil.make_archive(os.path.join(local_dir, "riskframe"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    dest = archive
    if "://" not in target or target.startswith("file:"):
        os.makedirs(target.replace("file:", ""), exist_ok=True)
        dest = os.path.join(target.replace("file:", ""), "riskframe.zip")
        shutil.copyfile(archive, dest)
    sc.addPyFile(dest)
    _SHIPPED.add(app)
