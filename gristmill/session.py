"""Session factory and the shared-folder helpers every multi-stage operator uses."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "gristmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` (dots as ``__``) wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only in local mode, where driver and executors are one process, an unset folder is
    replaced by a temporary one; on a cluster an unset folder is an error.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "gristmill-shared")
        spark.sparkContext.setCheckpointDir(found)
    return spark.conf.get("spark.checkpoint.dir", None) or found


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/gristmill/{name}-{uuid.uuid4().hex}"


_staged: dict[str, list[str]] = {}


def _drop_at_exit(spark: SparkSession, app: str) -> None:
    """Removes what is staged when the driver ends, as nothing can read it then."""
    local = [p.removeprefix("file://").removeprefix("file:") for p in _staged.get(app, []) if "://" not in p.removeprefix("file://")]
    try:
        drop_staged(spark)
    except Exception:  # noqa: BLE001  the session is gone: local folders can still be removed
        for path in local:
            shutil.rmtree(path, ignore_errors=True)


def _app(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def drop_staged(spark: SparkSession) -> None:
    """Removes the session's staged tables. Only once every result that reads them has been written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _staged.pop(_app(spark), []):
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def stage(df: DataFrame, name: str, folders: list[str] | None = None) -> DataFrame:
    """Writes ``df`` as parquet in the shared folder and reads it back; ``folders``: one folder for each value of these columns.

    Cuts the lineage like ``checkpoint()`` does, survives lost executors, and unlike a
    checkpoint stays columnar, so that later readers read only the columns they need.
    """
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*folders or []).parquet(path)
    if _app(df.sparkSession) not in _staged:
        _staged[_app(df.sparkSession)] = []
        atexit.register(_drop_at_exit, df.sparkSession, _app(df.sparkSession))
    _staged[_app(df.sparkSession)].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer partitions than the cluster has cores, dealt to all cores: for small files before costly work per row.

    For plans without a shuffle only, as counting partitions would run one. A large table has partitions enough
    and is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes the package importable in the session's Python workers, once per session."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package, shared = Path(__file__).resolve().parent, new_path(spark, "package")
    folder = Path(shared.removeprefix("file://").removeprefix("file:")) if "://" not in shared.removeprefix("file://") else Path(tempfile.mkdtemp())
    folder.mkdir(parents=True, exist_ok=True)  # the driver serves the archive to the executors, wherever it lies
    spark.sparkContext.addPyFile(shutil.make_archive(str(folder / package.name), "zip", package.parent, package.name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
