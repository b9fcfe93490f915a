"""Session helpers: the shared work folder.

Intermediate tables (migration versions, CSV exports made by checks) go under
the folder the cluster names in ``spark.checkpoint.dir``, which is shared by
all executors. Only when that setting is absent (a local test session) do we
make and register one of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    found = sc.getCheckpointDir() if sc is not None else None
    if not found:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and sc is not None:
            found = sc.getConf().get("spark.checkpoint.dir", None)
        if not found:
            master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
            if not master.startswith("local"):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set: name a folder every executor can reach "
                    "(it holds table versions, exports and stream checkpoints)"
                )
            # Local (test) sessions only: nothing configured, so take a private folder.
            found = tempfile.mkdtemp(prefix="keyferry-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(found)
            found = sc.getCheckpointDir() or found
    return found.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new, never used folder under the shared work folder."""
    return f"{shared_dir(spark)}/keyferry/{tag}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared work folder through Hadoop's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
