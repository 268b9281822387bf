"""Session construction and the shared folder for materialised intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution (runtime re-planning,
# partition coalescing, skew splitting), UTC dates, ANSI arithmetic.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Call-site capture on every DataFrame API call (only enriches error
    # messages) costs a JVM round trip per call while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "wardlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's recommended settings
    (settings given to ``spark-submit`` take precedence).

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    input (≈ input bytes / 128 MiB); AQE coalesces the small ones at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    # Under spark-submit, SparkConf() holds the submitted --conf values: the
    # library's defaults only fill in what the user did not set.
    submitted = SparkConf()
    for k, v in BASE_CONF.items():
        if not submitted.contains(k):
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a session on this
    machine alone (``local[...]``, as in tests) gets a folder of its own; on a
    cluster that would be a different disk for every executor, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wardlens-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    sub = name or uuid.uuid4().hex
    return "/".join([root.rstrip("/"), "wardlens", sub])
