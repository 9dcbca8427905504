"""Session and shared-folder helpers.

Library functions never create a session; they take DataFrames and read the
session from them. ``local_session`` is for tests and the benchmark only.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "curbline") -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    parts = str(cores if cores != "*" else os.cpu_count() or 8)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.default.parallelism", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot does not JIT-compile methods over 8000 bytes of bytecode;
        # above that, fall back from whole-stage codegen instead of running
        # a huge generated method interpreted
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set *and* the master is ``local`` or ``local[...]`` (tests,
    the benchmark) a fresh folder is created, registered as the checkpoint dir
    so that later calls agree, and removed when the process ends; on a cluster
    (or a client that does not know its master) a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect client
        sc = None
    found = (sc.getCheckpointDir() if sc is not None else None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "") or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors; "
                "a machine-local folder is only used for local[...] sessions")
        found = tempfile.mkdtemp(prefix="curbline-ckpt-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        if sc is not None:
            sc.setCheckpointDir(found)
            found = sc.getCheckpointDir() or found
        else:
            try:
                spark.conf.set("spark.checkpoint.dir", found)
            except Exception:  # noqa: BLE001 - static on some deployments
                pass
    return found.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, total_cores: int,
                   partition_bytes: int = 256 * 1024 * 1024,
                   shuffle_ratio: float = 0.05) -> dict[str, str]:
    """Session settings sized for one run over ``input_bytes`` of events.

    * Scan splits of ``partition_bytes`` (100 TB -> ~400k map tasks).
    * The big shuffle is the per-address pre-aggregate, a small fraction
      (``shuffle_ratio``) of the input: the initial shuffle width is that
      volume over ``partition_bytes``, at least 2 tasks per core; AQE
      coalesces small partitions and splits skewed ones.
    * Generated methods stay JIT-compilable (HotSpot's 8000-byte limit).
    """
    shuffle_bytes = int(input_bytes * shuffle_ratio)
    width = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set runtime SQL settings on an existing session."""
    for k, v in settings.items():
        spark.conf.set(k, v)


def submit_settings() -> dict[str, str]:
    """Settings for ``spark-submit --conf`` that let a long run ride out lost
    executors (they cannot be changed on a running session).

    Decommissioned executors hand their shuffle and cached blocks to the
    others before leaving, so finished map output is not recomputed; fetch
    and task retries are raised for a 1000-executor cluster.
    """
    return {
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
        "spark.task.maxFailures": "8",
        "spark.stage.maxConsecutiveAttempts": "8",
        "spark.shuffle.io.maxRetries": "10",
        "spark.shuffle.io.retryWait": "10s",
    }
