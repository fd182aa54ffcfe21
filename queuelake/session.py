"""Session helpers: a test/bench session and the shared working folder.

The library never sets cluster-wide options on a session it did not create.
Shared state (queue logs written by queries, stream checkpoints, archives)
lives below ``spark.checkpoint.dir``; only when that is unset *and* the
session runs in local mode (tests, bench) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None, app: str = "queuelake") -> SparkSession:
    """A local session for the bench and tools: ``4 x cores`` shuffle
    partitions, which Spark coalesces as usual.  On a cluster, size
    ``spark.sql.shuffle.partitions`` and the advisory partition size for the
    data."""
    if shuffle_partitions is None:
        n = (os.cpu_count() or 8) if str(cpus) == "*" else int(cpus)
        shuffle_partitions = 4 * int(n)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def _checkpoint_root(spark: SparkSession) -> str | None:
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext
        return None


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder below the cluster's shared checkpoint directory.

    ``unique=True`` appends a fresh id so concurrent runs never collide.
    """
    root = _checkpoint_root(spark)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
            )
        root = tempfile.mkdtemp(prefix="queuelake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    path = os.path.join(root, "queuelake", *parts)
    if unique:
        path = os.path.join(path, uuid.uuid4().hex)
    return path


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STORE = "spark.sql.streaming.stateStore.rocksdb"


def _beside(spark: SparkSession, partitions: int | str | None = None) -> SparkSession:
    """A new session with ``spark``'s time zone and shuffle partitions."""
    beside = spark.newSession()
    beside.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    beside.conf.set("spark.sql.shuffle.partitions", partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    return beside


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session beside ``spark`` whose state store is RocksDB, with its time zone
    and ``partitions`` shuffle partitions (its own, if not given): ``spark``'s
    options are not touched.  State is kept per shuffle partition, in a number
    that a checkpoint never changes: size it for the cluster's cores."""
    beside = _beside(spark, partitions)
    beside.conf.set(_PROVIDER, ROCKSDB)
    # a commit uploads the batch's changes, not whole files, and a row put is not
    # looked up before, just to keep a count of rows
    beside.conf.set(f"{_STORE}.changelogCheckpointing.enabled", "true")
    beside.conf.set(f"{_STORE}.trackTotalNumberOfRows", "false")
    return beside


# Fixed value: what opening a file counts when files are put together for a task.
# Spark's 4 MB, of 16 to 128 MB for a task, are a task for 4 to 32 small files.
FILE_OPEN_COST = "16k"


def listing_session(spark: SparkSession, tasks: int | None = None) -> SparkSession:
    """A session beside ``spark`` for queues of small files.  It lists folders in
    ``tasks`` tasks (as many as shuffle partitions, if not given); Spark's own limit
    is 10,000: a task for every folder or file, at each listing.  It reads many
    small files in a task, at least one task per core all the same."""
    beside = _beside(spark)
    beside.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks or spark.conf.get("spark.sql.shuffle.partitions"))
    beside.conf.set("spark.sql.files.openCostInBytes", FILE_OPEN_COST)
    # a cache of up to 250 MB in the driver, which no later listing looks into
    beside.conf.set("spark.sql.hive.filesourcePartitionFileCacheSize", "0")
    return beside


def require_rocksdb(spark: SparkSession) -> None:
    """Map state and timers need RocksDB; say so before the stream starts."""
    if spark.conf.get(_PROVIDER, None) != ROCKSDB:
        raise ValueError(f"set {_PROVIDER} to {ROCKSDB}, or read the stream with session.stateful_session(spark)")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``.

    Python data sources, ``mapInArrow`` splitters and stateful functions are
    unpickled in Python workers.  The package's own code is pickled by value,
    and the package is also zipped once per application and added with
    ``addPyFile`` (Spark serves it to every executor, like ``--py-files``).
    """
    import sys
    import zipfile

    # Classes and functions of this package are pickled by value: Python
    # processes that never run a task (e.g. the planner of a streaming Python
    # data source) do not see ``addPyFile`` includes.
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__.rsplit(".", 1)[0]])
    except Exception:
        pass
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        app = spark.conf.get("spark.app.id", "connect")
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="queuelake-pyfiles-"), "queuelake.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    try:
        spark.sparkContext.addPyFile(zpath)
    except Exception:  # Spark Connect
        spark.addArtifacts(zpath, pyfile=True)
    _SHIPPED.add(app)
