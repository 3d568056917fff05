"""Session settings and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day tags and epoch seconds are defined in UTC, whatever zone the machine has."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def single_machine(spark: SparkSession) -> bool:
    """Whether driver and tasks share one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path that every executor can reach.

    It lies below `spark.checkpoint.dir`. Only a single-machine session may run without that
    setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not single_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        base = _local_folders.get(app) or tempfile.mkdtemp(prefix="placelens-")
        _local_folders[app] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where several branches read one derived table: it is computed once, survives lost
    executors, and its readers see real file sizes instead of estimates.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can reach it; one that is not there is no error."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def remove_written(spark: SparkSession) -> None:
    """Delete what `written` has left in the shared folder. Call it when a job's results are complete."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        delete_folder(spark, path)
