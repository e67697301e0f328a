"""Session helpers: UTC everywhere, AQE on, a shared scratch/checkpoint folder.

The library never picks a machine-local folder on a cluster: scratch space for
streaming checkpoints and lineage cuts comes from ``spark.checkpoint.dir``
(the cluster's shared folder). Only a local-mode session without that setting
(tests, the bench) gets a private folder under the system temp dir.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_TZ = "UTC"

# Defaults that matter for correctness (UTC) or scale (AQE, skew join,
# coalescing). Applied only where the user has not set them.
_DEFAULTS = {
    "spark.sql.session.timeZone": SESSION_TZ,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "crowdpulse", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (D14) and switch AQE on if unset."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_TZ:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TZ)
    for k, v in _DEFAULTS.items():
        if k == "spark.sql.session.timeZone":
            continue
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_LOCAL_ROOTS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode session
    where it is unset gets a private folder (tests, bench).
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - conf not readable on some clients
            root = None
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder for checkpoints")
        key = id(sc)
        if key not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="crowdpulse-ckpt-")
        root = _LOCAL_ROOTS[key]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name inside the shared checkpoint root; Spark's writers make the folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside give their shuffle files back as they end, and not when the driver's garbage collection happens to find
    them, which may be long after the next job has filled the disks with its own. For jobs that write what they compute: a
    DataFrame that is run once more makes its shuffles anew."""
    held = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, held)
