"""Session factory and the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings every job of this engine relies on; a caller's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Rows a side may have before it is no longer broadcast; checked by counting, see bounded().
BROADCAST_ROWS = 100_000


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that Python workers find it wherever a job was started.

    Does nothing where the package was itself sent as an archive (--py-files).
    """
    app = spark.sparkContext.applicationId
    root = os.path.dirname(os.path.abspath(__file__))
    if app in _SHIPPED or not os.path.isdir(root):
        return
    _SHIPPED.add(app)
    handle, path = tempfile.mkstemp(prefix="tidelog-", suffix=".zip")  # on the driver, which serves it to the executors
    with zipfile.ZipFile(os.fdopen(handle, "wb"), "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    # A stream's planner, a Python process beside the driver, isn't given the files that were added.
    held = spark.sparkContext.environment
    held["PYTHONPATH"] = os.pathsep.join(filter(None, [path, held.get("PYTHONPATH")]))
    atexit.register(lambda: os.path.exists(path) and os.remove(path))


_SHIPPED: set[str] = set()


def session(app: str = "tidelog", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with DEFAULTS; keyword names use __ for dots (spark__sql__ansi__enabled="false")."""
    builder = SparkSession.builder.appName(app).master(f"local[{cores}]")
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder named by spark.checkpoint.dir, which every executor can read.

    Only where that setting is absent (a local session, as in tests) is a folder of this machine chosen. What an
    application wrote there is deleted when its driver's JVM ends.
    """
    ship(spark)
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            own = tempfile.mkdtemp(prefix="tidelog-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            root = "file://" + own
        folder = f"{root.rstrip('/')}/tidelog/{app}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _FOLDERS[app] = folder
    return f"{_FOLDERS[app]}/{purpose}-{uuid.uuid4().hex}"


_FOLDERS: dict[str, str] = {}


def all_kept(*frames: tuple[DataFrame, str]) -> list[DataFrame]:
    """kept() for several independent frames at once, so that one's tail doesn't leave cores idle."""
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(lambda x: kept(*x), frames))


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here and a lost executor costs nothing."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over as many tasks as there are cores, where its scan has fewer: small inputs with costly rows.

    A scan of many splits, as any large input has, is left as it is and costs no shuffle.
    """
    ship(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it was counted to have at most `rows` rows, else df as it is.

    The count stops after rows + 1, so it costs no more than that for a large side.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
