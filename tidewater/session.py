"""Session settings and the shared scratch location.

Everything here acts on a SparkSession the caller already owns; nothing
creates a cluster.  The only session we build ourselves is the local one used
by tests and the bench (``local_session``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  UTC matters most: the wire
# formats carry wall-clock text in UTC and every timestamp column is
# TIMESTAMP_NTZ, so the session zone must not shift them.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One key may hold a third of the rows: let AQE split it.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a shared session: keep theirs
            pass
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewater`` importable in Python workers (once per context).

    Functions run by ``mapInArrow`` refer to this package's modules; workers
    on other machines (or started from another directory) cannot import it
    unless it is installed there.  The package is zipped and added with
    ``addPyFile``, which Spark distributes to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    # written to the shared scratch folder through the Hadoop file system
    # (local, HDFS or object store alike), then distributed by Spark
    data = buf.getvalue()
    import hashlib
    path = f"{scratch_root(spark)}/tidewater/pkg/tidewater-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        out = fs.create(hpath, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def local_session(cpus: int | str = "*", app: str = "tidewater") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        # small local inputs: aim AQE at several tasks rather than one
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(4 * 1024 * 1024))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names storage every executor can reach, and all
    intermediate tables, topics and lake folders go below it.  Only when it is
    unset (tests, the local bench) do we pick a fresh local folder and make it
    the context's checkpoint folder so later calls agree.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            root = None
    if not root:
        root = _LOCAL_ROOTS.get(sc.applicationId)
    if not root and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tidewater-", dir="/tmp")
        _LOCAL_ROOTS[sc.applicationId] = root
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # core conf: refused at runtime on Spark 4
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    tail = "/".join(parts)
    if unique:
        tail = f"{tail}-{uuid.uuid4().hex[:12]}"
    return f"{scratch_root(spark)}/tidewater/{tail}"


def frozen(df, path: str):
    """Write ``df`` to ``path`` and read it back: a copy that an executor loss
    cannot change, whose stored size the planner knows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
