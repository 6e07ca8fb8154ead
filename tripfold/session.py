"""Session defaults the package is tuned for."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Month replacement relies on static overwrite, see sources.store.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a session on one machine may fall back to a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tripfold-")
    return _local_folders[context.applicationId]


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For a result that several branches of one report consume: the branches scan only
    the columns they need, and a lost executor costs a re-read, not a recomputation."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
