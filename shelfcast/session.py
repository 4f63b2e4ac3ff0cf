"""Session construction and shared settings."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the package relies on: UTC wall clock, ANSI arithmetic,
# adaptive execution (partition coalescing + skew-join splitting at runtime).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Starting points for a large cluster (100 TB class inputs). AQE coalesces the
# many initial shuffle partitions down to ~advisory-size partitions at run
# time, splits skewed join partitions, and re-plans joins with runtime sizes.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelfcast", extra: dict | None = None,
                profile: str = "local") -> SparkSession:
    """Return (or create) a session with the package's core settings.

    On a cluster, ``master`` is left unset and the launcher decides, and
    ``profile='cluster'`` adds the large-scale settings above; tests and the
    bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # Runtime-settable SQL confs are re-applied in case the session already existed.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and k != "spark.sql.warehouse.dir":
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``shelfcast`` importable in the Python workers (pandas functions).

    The package is zipped once per session and added with ``addPyFile`` (the
    driver serves it to every executor). The archive goes to the shared
    checkpoint folder when that is a local/NFS path, otherwise to a driver
    temp file (code only, never data). Deployments that install the package
    or pass it with ``--py-files`` can set ``spark.shelfcast.shipped=true``.
    """
    if spark.conf.get("spark.shelfcast.shipped", "false") == "true":
        return
    import shutil
    from urllib.parse import urlparse
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    ckpt = ensure_checkpoint_dir(spark)
    if urlparse(ckpt).scheme in ("", "file"):
        base_dir = os.path.join(urlparse(ckpt).path or ckpt, "pyfiles")
    else:
        base_dir = tempfile.mkdtemp(prefix="shelfcast-pyfiles-")
    os.makedirs(base_dir, exist_ok=True)
    archive = shutil.make_archive(os.path.join(base_dir, f"shelfcast-{os.getpid()}"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="shelfcast")
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.shelfcast.shipped", "true")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is only filled in here when unset
    (local runs and tests), with a fresh scratch directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never machine-local on a cluster)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with a single write job (a reliable RDD checkpoint would
    compute the plan twice), so later passes re-read files instead of
    recomputing, and a lost executor never forces recomputation of
    nondeterministic steps."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, "materialized", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.parquet(path)
