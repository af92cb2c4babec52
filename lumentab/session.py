"""Session helpers shared by operators, tests and the benchmark."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "lumentab", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; fall back only where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lumentab-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and drop its lineage."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand a zip of the package to the application, once, for executors on which it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="lumentab-code-"))
    staged = folder / "code"
    shutil.copytree(package, staged / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(folder / package.name), "zip", staged))
    _shipped.add(sc.applicationId)
