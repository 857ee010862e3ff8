"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every plan relies on.  The session time zone must be UTC
# so that dates derived from timestamps agree with the reference (naive UTC).
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tickloom", checkpoint_dir: str | None = None) -> SparkSession:
    """Local/test session.  On a cluster the session comes from spark-submit,
    with ``spark.checkpoint.dir`` set to a shared folder."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for k, v in RUNTIME_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings on a session we did not build (e.g. the driver's)."""
    for k, v in RUNTIME_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must exist (a machine-local folder is not visible
    to other executors).  Only a local-mode session without it gets a private
    temporary folder, as in tests.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="tickloom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder for one written table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(spark: SparkSession, df):
    """Cut the lineage of ``df``: write it once to the shared checkpoint folder
    (reliable, survives executor loss) and read from there afterwards.  Used
    before iterative algorithms that would otherwise recompute the plan."""
    shared_dir(spark)
    return df.checkpoint(eager=True)
