"""Session helpers: building a session for scripts/tests and finding the
shared work folder that materialised tables and checkpoints go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "martforge",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local scripts, tests and the benchmark.

    On a cluster the session comes from the platform; this only sets what a
    job needs to be planned well (AQE with skew handling, UTC, no UI).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or int(os.environ.get("MF_SHUFFLE_PARTITIONS", cpus))))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folder of the tables that only their own job reads.
INTERMEDIATE = "intermediate"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always honoured. Only a local master may leave it
    unset (tests): then a private folder is created and registered, so that
    ``DataFrame.checkpoint()`` and our written tables have a home. On a cluster
    such a folder would be one machine's, so the lack of a setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="martforge-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh versioned folder under the shared checkpoint root.

    Tables are never overwritten in place: every run writes a new version
    and hands its path on, so a reader never sees a half-written table.
    """
    return f"{checkpoint_root(spark)}/martforge/{label}/{uuid.uuid4().hex}"


def materialize(df, label: str):
    """Write ``df`` as a Parquet table in a fresh folder under the shared
    checkpoint root and return a DataFrame over the written files.

    This cuts the lineage like ``checkpoint()`` but keeps the data columnar:
    later readers get column pruning and filter push-down, and a lost
    executor re-reads the files instead of recomputing the plan.
    """
    path = new_work_dir(df.sparkSession, f"{INTERMEDIATE}/{label}")
    df.write.mode("overwrite").parquet(path)
    # The schema is known: reading with it skips the footer-inference job.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_concurrently(tasks: dict, max_workers: int = 4) -> dict:
    """Run independent Spark actions (e.g. writes of unrelated tables) as
    concurrent jobs from driver threads and return their results by name.

    Small or skewed jobs leave executors idle; independent jobs submitted
    together share the cluster instead of queueing behind one another.
    """
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def purge_work_dirs(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete intermediate tables (``materialize``) older than
    ``older_than_hours``; returns how many were removed. Outputs, stores,
    landing folders and stream checkpoints are never touched.

    Readers of a version hold lazy plans over its files, so only versions
    no running job can still read should be purged -- hence the age limit.
    Uses the Hadoop file-system API, so it works on any shared store.
    """
    import time as _time
    sc = spark.sparkContext
    jvm = sc._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/martforge/{INTERMEDIATE}")
    fs = base.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return 0
    cutoff = (_time.time() - older_than_hours * 3600) * 1000
    removed = 0
    for label in fs.listStatus(base):
        for version in fs.listStatus(label.getPath()):
            if version.isDirectory() and version.getModificationTime() < cutoff:
                fs.delete(version.getPath(), True)
                removed += 1
    return removed
