"""Session construction and lineage cutting.

Checkpoints go to the directory named by ``spark.checkpoint.dir`` (a shared
folder on a cluster).  Only when that setting is absent *and* the master is
local do we create a scratch directory ourselves (tests, local runs).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(app: str = "dealscope", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, creating a scratch one only
    for local masters when the cluster did not name one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return named
    if not re.match(r"local(\[|$)", sc.master):       # not local-cluster: its executors share no memory
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    path = tempfile.mkdtemp(prefix="dealscope-ckpt-")
    sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, reliable: bool = True) -> DataFrame:
    """Cut lineage of a DataFrame that several jobs reuse.

    ``reliable=True`` writes a checkpoint to the shared checkpoint folder, so a
    lost executor does not force recomputation from the raw scans.  With
    ``reliable=False`` the frame is only cached (recomputable from lineage).
    """
    if reliable:
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


_SCRATCH: dict[str, list[str]] = {}


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: a lineage cut that
    later reads prune by column.  The folder lasts until :func:`drop_scratch` or the end of the
    :func:`scratch` block that it was written in."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    keep_track(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_track(spark: SparkSession, path: str) -> None:
    """Note a scratch folder for deletion."""
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)


def drop_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch folders of this application (from the ``since``-th on).  Results that read
    from them must have been consumed."""
    paths = _SCRATCH.get(spark.sparkContext.applicationId, [])
    while len(paths) > since:
        drop_path(spark, paths.pop())


def drop_path(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is written to scratch inside the block when it ends, also on errors: consume results inside."""
    since = len(_SCRATCH.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        drop_scratch(spark, since)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``dealscope`` importable in Python workers (Pandas UDFs) by adding a
    zip of the package with ``addPyFile``; Spark's file server distributes it,
    as ``--py-files`` would.  Done once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="dealscope-pyfiles-"), "dealscope.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
