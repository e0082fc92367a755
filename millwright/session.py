"""Session building and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Marks what this driver process stages.
RUN = uuid.uuid4().hex[:12]


def build_session(app: str = "millwright", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; a cluster's own settings win where given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may go without the setting (tests, a laptop): there a temporary folder is
    visible to every task. Anywhere else a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="millwright-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder, whose name tells the run it belongs to."""
    return f"{shared_folder(spark)}/millwright/{purpose}-{RUN}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def file_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def create_file(spark: SparkSession, path: str, text: str = "") -> None:
    """A new small file; an error where one of that name exists, so of two writers one fails."""
    files, place = _file_system(spark, path)
    out = files.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds; none where there is no folder."""
    files, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that this library wrote, once nothing reads it."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete all that this run staged; frames that read it cannot be used afterwards. Stored models stay."""
    place = f"{shared_folder(spark)}/millwright"
    for name in names_in(spark, place):
        if f"-{RUN}-" in name:
            remove(spark, f"{place}/{name}")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table under the shared folder and read it back.

    For frames that several jobs read with different columns, such as the input of a fit: the
    columnar files are pruned per job and survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
