"""Session construction and shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every scarp session wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Snapshot the state store often, as the reference jobs do; cheap replay on restart.
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
}

LOCAL_CONF = {
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


def build_session(master: str | None = None, app: str = "scarp",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with scarp's defaults.

    ``master=None`` leaves the master to spark-submit (cluster use); a
    ``local[...]`` master also pins the driver to the loopback interface.
    """
    b = SparkSession.builder.appName(app)
    settings = dict(DEFAULT_CONF)
    if master is not None:
        b = b.master(master)
        if master.startswith("local"):
            settings.update(LOCAL_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is always read from
    the session; without it a cluster run is refused. Only with a local master
    (unit tests, ad-hoc runs) a local folder is created and registered with the
    context (the setting itself is fixed at start-up and cannot be changed later).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - connect sessions have no context
        pass
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="scarp-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint root (never machine-local on a cluster)."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([checkpoint_root(spark)] + leaf)


def is_local_path(spark: SparkSession, path: str) -> bool:
    """Whether the session's Hadoop settings put ``path`` on the local file system (a path without scheme follows ``fs.defaultFS``)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and continue from there.

    Used where one large intermediate feeds several branches (rows and their
    carry tables): without it every branch would recompute the whole upstream
    plan. Reliable checkpoints survive executor loss; never machine-local.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


# Shuffle partitions per core: a few waves of tasks. The driver tracks map tasks times reducers, so more partitions
# cost more than larger ones do; AQE splits the skewed ones.
SHUFFLE_WAVES = 4


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
               streaming: bool = False) -> dict[str, str]:
    """Settings sized for a given input volume (pass to ``build_session(conf=...)``).

    Scan splits of ``target_partition_bytes``. Shuffle partitions: enough for partitions of
    ``target_partition_bytes``, at least two and at most ``SHUFFLE_WAVES``
    waves of tasks. A stream keeps one state store per partition and restarts
    with the number it began with: ``streaming`` gives one wave.
    """
    cores = max(1, int(total_cores))
    wanted = -(-int(input_bytes) // int(target_partition_bytes))
    parts = cores if streaming else max(2 * cores, min(SHUFFLE_WAVES * cores, wanted))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
