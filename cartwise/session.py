"""Session helpers: a local session for tests/bench and cluster-safe checkpointing."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins/partition counts from runtime
# shuffle statistics; skew-join splits hot keys on the streamed side.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files of operators (pair sets, hierarchy levels) are removed once
    # the driver no longer references them, so the shared folder does not fill up
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cartwise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, registering it with the context.

    ``spark.checkpoint.dir`` must name a shared folder; it is read from the session. Only where it is unset
    in a one-process session (``local`` or ``local[n]``, not ``local-cluster``) a private scratch folder
    stands in for it (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="cartwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions_for(nbytes: int, least: int = 1, target_bytes: int = 256 << 20, most: int | None = None) -> int:
    """Shuffle partitions for ``nbytes`` of input at about ``target_bytes`` each, ``least`` at least.

    100 TB at 256 MB gives about 400,000. ``most`` bounds the number where the scheduler asks for it; partitions get
    larger then, and AQE still splits skewed ones. AQE coalesces small ones at run time.
    """
    wanted = max(least, -(-nbytes // target_bytes))
    return min(wanted, most) if most else wanted
