"""Session settings, and the shared scratch folder of a session."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Per thread, the scratch tables of the innermost ``passing_scratch``.
_SCRATCH = threading.local()


def build_session(app: str = "riftlog", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs expect. On a cluster, ``master``,
    memory and the number of shuffle partitions come from the submit command."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. Only where
    that is unset and all tasks run in this process, as in tests, a folder of our own
    is made and named; on a cluster the executors could not share it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="riftlog-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark).rstrip('/')}/riftlog/{label}-{uuid.uuid4().hex}"
    paths = getattr(_SCRATCH, "paths", None)
    if paths is not None:
        paths.append(path)
    return path


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, so that later
    jobs neither recompute it nor depend on the executors that made it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


@contextmanager
def passing_scratch(spark: SparkSession):
    """Tables settled inside are removed when the block ends: for batches of a stream,
    whose results are written by then."""
    outer = getattr(_SCRATCH, "paths", None)
    _SCRATCH.paths = paths = []
    try:
        yield
    finally:
        _SCRATCH.paths = outer
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settle_last(spark: SparkSession, build: Callable[[], DataFrame], label: str = "stage") -> DataFrame:
    """``settle`` of what ``build`` gives; the tables settled on the way to it are removed once it
    is written."""
    path = scratch_path(spark, label)
    with passing_scratch(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(jobs: Sequence[Callable], at_once: int = 5) -> list:
    """Run independent Spark jobs at the same time, so that one fills the slots the
    others leave free; results in the order of ``jobs``."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
