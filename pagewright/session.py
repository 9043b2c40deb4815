"""Session helpers shared by all operators: tables, shared work folder, materialised cuts in a lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: list[str] = []
_SHIPPED: set[str] = set()


def build_session(app: str = "pagewright", master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own session."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Gives the package to the executors' Python, once an application; without effect on results where they have it already."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # not when it was itself imported from an archive
        place = tempfile.mkdtemp(prefix="pagewright-")  # on the driver, from where Spark hands it out
        _OWN_DIRS.append(place)
        sc.addPyFile(shutil.make_archive(f"{place}/pagewright", "zip", root.parent, root.name))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (``local``, as in tests) a temporary one is made; it is removed at exit. A
    cluster without a shared folder is an error: what one machine keeps for itself is lost with it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(named)
        return named
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local["):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        own = tempfile.mkdtemp(prefix="pagewright-")
        _OWN_DIRS.append(own)
        sc.setCheckpointDir(own)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so later reads neither recompute it nor lose it with an executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_cuts(spark: SparkSession) -> bool:
    """Removes this application's own sub-folder of the shared folder, once its results are written. Frames made from cuts can't be read after
    that. (``spark.cleaner.referenceTracking.cleanCheckpoints`` removes single cuts as soon as nothing refers to them.)"""
    sc = spark.sparkContext
    place = sc._jsc.sc().getCheckpointDir()
    if place.isEmpty():
        return False
    path = sc._jvm.org.apache.hadoop.fs.Path(place.get())
    return bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))


@atexit.register
def _remove_own_dirs() -> None:
    for d in _OWN_DIRS:
        if os.path.isdir(d):
            shutil.rmtree(d, ignore_errors=True)
