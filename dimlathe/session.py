"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does three jobs here: it splits hot join keys, splits or merges partitions
# before partitioned writes, and turns a shuffle join into a broadcast join once a side is measured.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Plans here have many column expressions; not recording each one's call site spares driver time.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "dimlathe", **extra: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may run without it: then a temporary folder is made, and removed at exit.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = _local_roots.get(context.applicationId)
    if root is None:
        root = tempfile.mkdtemp(prefix="dimlathe-")
        _local_roots[context.applicationId] = root
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the shared folder and grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/dimlathe/{app}/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop path object and its file system, for listings and existence tests."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = file_system(spark, path)
    return files.exists(hadoop_path)


def release_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote through ``scratch_path``.

    Call it after the final tables are written: frames that still read scratch tables break.
    """
    hadoop_path, files = file_system(spark, f"{scratch_root(spark)}/dimlathe/{spark.sparkContext.applicationId}")
    files.delete(hadoop_path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, fixes row-to-partition assignment and survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
