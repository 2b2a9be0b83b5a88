"""Session construction and the shared work folder.

Library code never builds a session on its own; callers (tests, bench, the
pipeline CLI) pass one in. ``local_session`` is for tests and local runs.
"""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Configuration a production deployment should also set (cluster values are
# the deployer's call; these are the knobs the plans rely on).
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast a join side only when its measured size is below the adaptive bound;
    # larger sides fall back to a shuffled join. Before anything is measured Spark goes by the
    # size of files, and rows that pass through the driver take a hundred times that of compressed,
    # repetitive columns: only the smallest tables may be judged so.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A hot target or acquirer is split even where the split costs a shuffle more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Deals that lie by acquirer for one join stay there for the join by acquirer and year.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dealhouse") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the session-level settings the plans depend on (idempotent)."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], Any]]) -> list[Any]:
    """Run steps that do not depend on each other at once: tasks of one fill the cores that another leaves idle.

    Returns what each gave, in their order; the first error is raised when all have ended."""
    if len(steps) < 2:
        return [step() for step in steps]
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def shared_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Read from the session's ``spark.checkpoint.dir``. A session that runs in one
    process (``local[n]``, as in tests) and has none gets a private folder; on a
    cluster executors could not see such a folder, so that raises instead.
    """
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or (jdir.get() if jdir.isDefined() else None)
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "no shared folder: set spark.checkpoint.dir to a path that the driver and all executors can reach")
        root = tempfile.mkdtemp(prefix="dealhouse-ckpt-")
    if jdir.isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root."""
    return f"{shared_root(spark)}/dealhouse-scratch/{label}-{uuid.uuid4().hex[:12]}"
