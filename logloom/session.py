"""Session for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Application id -> temporary folder of a local session; the setting itself cannot change at run time.
_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "logloom", memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).

    Only a local master, where driver and executors are one process, falls back
    to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="logloom-")
    return _LOCAL_FOLDERS[context.applicationId]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Used where a result feeds several later steps: it survives lost executors,
    is not computed again, and later reads are columnar and pruned. The folder
    is named after the application, so it can be removed when that has ended.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def small_enough(df: DataFrame, limit: int = 200_000) -> bool:
    """Whether ``df`` has at most ``limit`` rows: the check before any broadcast.

    Reads no more than ``limit + 1`` rows, and only their number reaches the driver.
    """
    return df.limit(limit + 1).count() <= limit
