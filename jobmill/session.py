"""Session helpers: a local session for tests and benches, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ARCHIVE = "jobmill.zip"


def local_session(cpus: int | str = "*", app: str = "jobmill") -> SparkSession:
    """A local session with the settings the operators expect (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Let Python workers import the library, wherever the driver found it.

    The package's sources go to the workers once per Spark application.
    """
    context = spark.sparkContext
    if ARCHIVE in context._python_includes:
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="jobmill-ship-"), ARCHIVE)
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(home.rglob("*.py")):
            out.write(source, source.relative_to(home.parent))
    context.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder, one for the whole application.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = LOCAL_FOLDERS.get(context.applicationId)
        if folder is None:
            folder = tempfile.mkdtemp(prefix="jobmill-shared-")
            LOCAL_FOLDERS[context.applicationId] = folder
    return folder.rstrip("/")


LOCAL_FOLDERS: dict[str, str] = {}


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` in reliable storage, so a lost executor costs no rework."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
