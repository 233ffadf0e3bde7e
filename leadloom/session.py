"""Session settings, the shared working folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "leadloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators rely on.

    Broadcasts are left to Spark's own size checks, and skewed joins to adaptive execution.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is used in local mode only.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="leadloom-"))
    return context.getCheckpointDir()


MADE_PATHS: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, also noted in ``MADE_PATHS``."""
    path = f"{shared_dir(spark).rstrip('/')}/leadloom-{name}-{uuid.uuid4().hex}"
    MADE_PATHS.append(path)
    return path


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete paths that :func:`fresh_path` gave; only once nothing reads them any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in MADE_PATHS:
            MADE_PATHS.remove(path)


def folder_numbers(spark: SparkSession, path: str) -> list[int]:
    """The folders in ``path`` whose names are numbers, in ascending order; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    return sorted(int(name) for name in found if name.isdigit())


def publish_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Rename the written folder ``source`` to ``target`` in one step; False, and no change, if ``target`` is there already.

    Of writers that race for one target one is told True. A marker in the folder tells whose it is, since some file
    systems answer a lost race with a copy inside the target; the copy is hidden and is deleted again.
    """
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    old, new, mark = place(source), place(target), f"_writer-{uuid.uuid4().hex}"
    files = old.getFileSystem(settings)
    files.create(place(old, mark)).close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), settings).rename(old, new, options)
    except Py4JJavaError:
        if not files.exists(new):
            raise
    if files.exists(place(new, mark)):
        return True
    files.delete(place(new, old.getName()), True)
    files.delete(old, True)
    return False


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder, with these options of the writer, and read it from there on.

    Later steps then depend on files alone, so they survive the loss of an executor. Columnar files let each step read
    only its own columns, and their sizes let Spark choose joins.
    """
    path = fresh_path(df.sparkSession, "step")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
