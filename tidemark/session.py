"""Session helpers for tests, the bench and local runs.

On a cluster the session is supplied by the caller; these helpers only fill in
settings that are unset, so cluster-wide values always win.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: str | int = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session for tests and the bench (UI off, small shuffle count)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Hosts known to share a ``file:`` checkpoint folder, by application and folder.
_SHARED: dict[tuple[str, str], set[str]] = {}


def _hosts(spark: SparkSession) -> set[str]:
    return {e.host() for e in spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()}


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Do all machines see the same ``file:`` folder?  Tried with a few rows whenever a host has joined.

    Each core writes two files and the driver commits them: what a machine wrote
    to a disk of its own is missing afterwards.  A trial that fails counts as no.
    """
    sc = spark.sparkContext
    try:
        hosts, known = _hosts(spark), _SHARED.setdefault((sc.applicationId, folder), set())
        if known and hosts <= known:
            return True
        n, path = 2 * sc.defaultParallelism, f"{folder.rstrip('/')}/tidemark-probe-{uuid.uuid4().hex[:12]}"
        track_staged(spark, path)
        spark.range(0, n, 1, n).write.parquet(path)
        if spark.read.schema("id long").parquet(path).count() != n:
            return False
    except Exception:
        return False
    known |= hosts
    return True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; a
    ``file:`` folder is first tried on all machines, unless it is declared as shared.
    Only local runs (tests) get a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        mounted = spark.conf.get("spark.tidemark.sharedFileSystem", "false") == "true"
        if current.startswith("file:") and not sc.master.startswith("local") and not mounted and not _is_shared(spark, current):
            raise RuntimeError(
                f"spark.checkpoint.dir is {current}, a folder of one machine; if every machine mounts it, "
                "set spark.tidemark.sharedFileSystem=true"
            )
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/ABFS) "
            "that every executor can read; tidemark never checkpoints to a machine-local folder on a cluster"
        )
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def stage_parquet(df, tag: str = "stage"):
    """Write ``df`` once as parquet under the checkpoint folder and read it back.

    One job computes and writes (``Dataset.checkpoint`` computes the plan twice
    unless cached); the result has no lineage, and the files sit on the
    cluster's shared checkpoint storage, so an executor loss cannot change
    them.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tidemark-{tag}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    track_staged(spark, path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path under the checkpoint folder for what isn't a table; it goes with the staged tables."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-{tag}-{uuid.uuid4().hex[:12]}"
    track_staged(spark, path)
    return path


_STAGED: dict[str, list[str]] = {}
#: Staged tables whose write has ended.
_WRITTEN: dict[str, set[str]] = {}
_TABLES: dict[str, list[str]] = {}
_ON_CLEANUP: list = []


def track_staged(spark: SparkSession, path: str) -> None:
    """Remember a staged folder: ``cleanup_staged`` deletes it, at the latest when Python ends."""
    if not _STAGED:
        atexit.register(_cleanup_at_exit)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)


def on_cleanup(forget) -> None:
    """Call ``forget(paths)`` whenever staged folders are deleted."""
    _ON_CLEANUP.append(forget)


def _cleanup_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            cleanup_staged(spark)


def _has_catalog(spark: SparkSession, root: str) -> bool:
    """Can external tables be made here?  Tried on an empty table, so no data job runs for the answer."""
    name = f"tidemark_probe_{uuid.uuid4().hex[:12]}"
    try:
        spark.sql(f"CREATE TABLE {name} (x INT) USING parquet LOCATION '{root}/{name}'")
        spark.sql(f"DROP TABLE {name}")
    except AnalysisException:
        return False
    return True


def stage_bucketed(df, tag: str, key: str, buckets: int):
    """Stage ``df`` as an external table bucketed and sorted by ``key``.

    Tables staged with the same key and bucket count join and aggregate on
    that key without a shuffle (bucketed scans), so a chain of left joins on
    customer_id reuses one partitioning.  Rows are dealt by the key first, so
    there is one file a bucket.  Files sit under the checkpoint folder like every
    staged table.  Without a catalog the table is plain parquet; an error of the
    job itself is raised.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"tidemark_{uuid.uuid4().hex[:12]}_{tag}".replace("-", "_")
    path = f"{root}/{name}"
    if not _has_catalog(spark, root):
        return stage_parquet(df, tag)
    track_staged(spark, path)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    df.repartition(buckets, key).write.option("path", path).bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return spark.table(name)


def forget_lost(spark: SparkSession) -> int:
    """If staged tables are gone (the checkpoint folder was cleared), forget every run of the application.

    All runs, since the staged ranks and prefix sums carry no run's name.  What
    is still there stays until ``cleanup_staged``.  One listing a folder; returns
    the number of tables lost.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    app = spark.sparkContext.applicationId
    written, there = _WRITTEN.get(app, set()), set()
    for folder in {p.rpartition("/")[0] for p in written}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            there |= {f"{folder}/{status.getPath().getName()}" for status in fs.listStatus(path)}
    if lost := written - there:
        for forget in _ON_CLEANUP:
            forget(_STAGED.get(app, []))
        _drop_staged(spark, lost)
    return len(lost)


def _drop_staged(spark: SparkSession, paths) -> None:
    """Staged folders are no longer known, and their tables go from the catalog."""
    app, paths = spark.sparkContext.applicationId, set(paths)
    _STAGED[app] = [p for p in _STAGED.get(app, []) if p not in paths]
    _WRITTEN.get(app, set()).difference_update(paths)
    names = {p.rpartition("/")[2] for p in paths}
    for t in [t for t in _TABLES.get(app, []) if t in names]:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        _TABLES[app].remove(t)


def cleanup_staged(spark: SparkSession, tag: str | None = None) -> int:
    """Delete the tables this application staged (all, or those whose tag contains ``tag``).

    Uses the Hadoop FileSystem API, so it works on any shared storage.  Call
    when the results that read them have been written; returns the number of
    folders removed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    app = spark.sparkContext.applicationId
    mine = _STAGED.get(app, [])
    paths = [p for p in mine if tag is None or f"tidemark-{tag}" in p or f"_{tag}" in p.rsplit("/", 1)[-1]]
    _drop_staged(spark, paths)
    for forget in _ON_CLEANUP:
        forget(paths)
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    return len(paths)
