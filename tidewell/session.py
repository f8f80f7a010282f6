"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings every plan here relies on; all may be changed while a session runs.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans rely on to a session that is already there, and give its workers this package."""
    for k, v in RUNTIME.items():
        spark.conf.set(k, v)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless their PYTHONPATH has it already."""
    root = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(":") or getattr(context, "_tidewell_shipped", False):
        return
    d = tempfile.mkdtemp(prefix="tidewell-package-")  # of the driver, which serves it to the executors
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    at = os.path.join(d, "tidewell.zip")
    with zipfile.ZipFile(at, "w") as z:
        for f in sorted(Path(__file__).resolve().parent.rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(at)
    context._tidewell_shipped = True


def build(app: str = "tidewell", cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.ui.enabled", "false")
    for k, v in {**RUNTIME, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def scratch(spark: SparkSession) -> str:
    """The folder all executors share, as `spark.checkpoint.dir` names it.

    Where the session names none, a temporary folder is made and set, but only on a single machine, as in tests: on a
    cluster a folder of the driver would be none that executors share, so that is an error.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        have = spark.sparkContext.getCheckpointDir()
        if have:
            return have.rstrip("/")
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        given = "file://" + tempfile.mkdtemp(prefix="tidewell-")
        spark.sparkContext.setCheckpointDir(given)
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch(spark)}/tidewell-{what}-{uuid.uuid4().hex[:12]}"


def _file(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file of settings, on whatever file system the path names; null if there is none."""
    at, fs = _file(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file as a whole: a temporary name, then a rename over the old one."""
    at, fs = _file(spark, path)
    part, _ = _file(spark, f"{path}.{uuid.uuid4().hex[:8]}")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark._jvm.java.lang.reflect.Array.newInstance(overwrite.getClass(), 1)
    options[0] = overwrite
    context.rename(part, at, options)


def settle(df: DataFrame, what: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a result to the shared folder and read it back.

    It cuts the lineage with files that outlive any executor, and keeps a result that several plans need from being computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, what)
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
