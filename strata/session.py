"""Where scratch data lives: the shared folder named by ``spark.checkpoint.dir``.

On a cluster that folder is on shared storage (HDFS, S3A, ...), so anything
written there survives the loss of an executor. A local temporary folder is
only created when the session has no checkpoint folder at all (tests, local
runs), and is then registered as the session's checkpoint folder.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a local one only when none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext access (e.g. Spark Connect)
            root = None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS, S3A, ...): "
                "scratch data must survive the loss of an executor")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder under the checkpoint root (nothing is created yet)."""
    return f"{checkpoint_root(spark)}/strata/{tag}-{uuid.uuid4().hex[:12]}"


def jvm_context(spark: SparkSession):
    """The session's SparkContext, needed for file-system listings and JDBC
    statements from the driver; a Spark Connect session has none."""
    try:
        sc = spark.sparkContext
        sc._jvm  # noqa: B018 -- touch the gateway
        return sc
    except Exception as exc:
        raise RuntimeError(
            "this operation lists files or runs JDBC statements on the driver and needs a "
            "classic Spark session (not Spark Connect)") from exc


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own with the caller's SQL settings and then ``settings``.

    It shares the caller's context, catalog and storage; the caller's session
    is left as it is, also while other threads use it.
    """
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


# Input bytes per reducer of a whole-row dedup: AQE's default target size.
# The shuffled rows (binary rows, at most one per distinct row per task) can
# be about twice the size of their CSV text, so a reducer starts at or below
# ~128 MiB; AQE merges neighbours that turn out smaller.
DEDUP_INPUT_BYTES_PER_PARTITION = 64 * 1024 * 1024


def shuffle_partitions_for(
    spark: SparkSession,
    input_bytes: int,
    bytes_per_partition: int = DEDUP_INPUT_BYTES_PER_PARTITION,
) -> int:
    """Reducer count for a shuffle over ``input_bytes`` of input.

    Never below the session's own ``spark.sql.shuffle.partitions`` (AQE
    coalesces the surplus when the data turns out smaller).
    """
    try:
        current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    except ValueError:  # e.g. "auto" in some distributions: size from the input alone
        current = 1
    wanted = math.ceil(max(input_bytes, 0) / bytes_per_partition)
    return max(current, wanted)
