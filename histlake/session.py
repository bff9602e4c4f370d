"""Session settings the operators rely on.

* one time zone (UTC) so timestamp equality joins behave the same everywhere;
* case-insensitive column resolution (staging files may spell a column with a
  capital letter);
* adaptive query execution, including skew-join splitting and runtime
  broadcast conversion, so join strategies follow measured sizes.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings applied to every session built here.  Values are only *defaults*:
# anything the cluster already set wins (see ``build_session``).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable-checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def _given() -> dict[str, str]:
    """What was set at submit time or in the running session, which stays as it is."""
    if running := SparkSession.getActiveSession():
        return dict(running.sparkContext.getConf().getAll())
    if "PYSPARK_GATEWAY_PORT" not in os.environ:  # a plain Python process: no JVM yet, nothing submitted
        return {}
    SparkContext._ensure_initialized()
    return dict(SparkConf().getAll())


def build_session(master: str | None = None, app: str = "histlake",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Get or create a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs and tests; on
    a cluster leave them ``None`` so the submit-time configuration is used.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    asked = dict(conf or {})
    if shuffle_partitions:
        asked.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    given = _given()
    for k, v in ({k: v for k, v in DEFAULT_CONF.items() if k not in given} | asked).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings the operators depend on (runtime-modifiable ones)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.caseSensitive", "false")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared storage).  Only
    when it is unset *and* the master is local - local runs and tests - a
    fresh local folder is created and registered on the session, so every
    later call agrees.  On a cluster an unset value is an error: a folder on
    the driver's disk is not visible to executors.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        existing = sc.getCheckpointDir()
        if existing:
            return existing
        if not re.match(r"local($|\[)", sc.master or ""):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) "
                               "for checkpoints and intermediate tables")
        root = tempfile.mkdtemp(prefix="histlake-ckpt-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
        return root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for the few local-only checks in tests)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "apply_defaults", "checkpoint_root", "scratch_dir",
           "DEFAULT_CONF", "local_path"]
