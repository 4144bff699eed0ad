"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# The shuffle files of a write are deleted when it ends, not when the driver's memory is next swept (Spark 4.1 or later).
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# A 20 s clip is close to 1 MB, so stages that move audio use small Arrow batches and small splits.
AUDIO_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.files.maxPartitionBytes": str(32 << 20),
}


def build_session(
    app: str = "clipcurate",
    master: str | None = None,
    audio: bool = False,
    **settings: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(AUDIO_SETTINGS if audio else {}), **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for as long as a step is planned and run; those of the caller come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session. Only a local master may fall back to a temp folder."""
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="clipcurate-")
    return _local_roots[app]


# Spark and Hadoop write a different number of slashes after this scheme.
FILE_SCHEME = "^file:/+"


def absolute_root(spark: SparkSession, path: str) -> str:
    """A folder as the file system knows it, encoded as in a URI; local folders without their scheme."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub(FILE_SCHEME, "/", system.makeQualified(folder).toUri().toString()).rstrip("/")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def _hadoop(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, name: str) -> None:
    path, system = _hadoop(spark, name)
    system.delete(path, True)


def folder_exists(spark: SparkSession, name: str) -> bool:
    path, system = _hadoop(spark, name)
    return system.exists(path)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a complete folder in the place of another one, which is deleted."""
    (old, system), (new, _) = _hadoop(spark, target), _hadoop(spark, source)
    system.delete(old, True)
    if not system.rename(new, old):
        raise OSError(f"{source} could not be moved to {target}")


def release_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete scratch tables of this driver, all or those named, once no result that reads them is needed."""
    for name in list(_scratch) if paths is None else paths:
        delete_folder(spark, name)
        if name in _scratch:
            _scratch.remove(name)


def written(df: DataFrame, label: str, used: list[str] | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back, which cuts its lineage safely."""
    path = scratch_path(df.sparkSession, label)
    if used is not None:
        used.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_archives: dict[tuple[str, str], tempfile.TemporaryDirectory] = {}


def ship_code(spark: SparkSession, package: str = "clipcurate") -> None:
    """Give executors this package, once per application, where the cluster does not have it installed."""
    context = spark.sparkContext
    key = (context.applicationId, package)
    if key in _archives:
        return
    _archives[key] = tempfile.TemporaryDirectory(prefix="clipcurate-code-")
    root = Path(__file__).resolve().parent.parent
    base = str(Path(_archives[key].name) / package)
    context.addPyFile(shutil.make_archive(base, "zip", root, package))
