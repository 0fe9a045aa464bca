"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Folders staged in the scope that is open, to be freed at its end.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def build_session(app: str = "orebed", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Sizes (executors, shuffle partitions) stay with the cluster's own
    configuration; pass them in ``conf`` to override.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="orebed-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Free the tables staged within when the scope ends.

    Results read them, so write results before the end. Scopes may be nested; each frees
    its own. Without a scope staged tables stay until the shared folder is cleaned.
    """
    folders: list[str] = []
    token = _STAGED.set(folders)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def freeing(function: Callable) -> Callable:
    """A job, its session the first argument, that frees what it staged and did not ``keep`` when it returns."""

    @wraps(function)
    def job(spark: SparkSession, *args, **options):
        with staging(spark):
            return function(spark, *args, **options)

    return job


def stage(df: DataFrame, keep: bool = False, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    ``options`` are those of the Parquet writer. With ``keep`` it outlives the scope that is open, as what a job returns has to.

    Cuts the lineage, is computed once, survives the loss of executors, and
    gives later joins the true size of the table, which ``checkpoint()``
    does not.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/orebed-{uuid.uuid4().hex}"
    folders = _STAGED.get()
    if folders is not None and not keep:
        folders.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
