"""Session helpers: builder for local use, shared folder, written cut points."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: dict[str, str] = {}
_FOLDERS: set[str] = set()


def build(app: str = "wirelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on (UTC, AQE, Arrow)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for cut points: ``spark.checkpoint.dir``; a private one on a local master only."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIR:
        _LOCAL_DIR[app] = tempfile.mkdtemp(prefix="wirelake-")
        atexit.register(shutil.rmtree, _LOCAL_DIR[app], ignore_errors=True)
    return "file://" + _LOCAL_DIR[app]


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def run_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/wirelake-{spark.sparkContext.applicationId}"
    if path not in _FOLDERS:
        fs, p = _files(spark, path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _FOLDERS.add(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files every executor can reach, so a lost executor
    costs a re-read and never a recomputation of the steps before.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a cut point that nothing will read again."""
    path = getattr(df, "_written_to", None)
    if path:
        fs, p = _files(df.sparkSession, path)
        fs.delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
