"""Session helpers: where shared intermediate tables go and how lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only in local mode where the session names no shared folder, as in tests.
LOCAL_FALLBACK = "/tmp/checkpoints/thalweg"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{LOCAL_FALLBACK}"
        spark.sparkContext.setCheckpointDir(root)
    if "://" not in root:  # a bare path belongs to the default file system
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        root = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
        if root.startswith("file:/") and not root.startswith("file://"):
            root = "file://" + root.removeprefix("file:")
    return root.rstrip("/")


_RUN = uuid.uuid4().hex
_made: dict[str, SparkSession] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; it goes when the driver's Python ends in good order."""
    run = f"{shared_root(spark)}/thalweg/{_RUN}"
    if run not in _made:
        _made[run] = spark
    return f"{run}/{name}-{uuid.uuid4().hex}"


@atexit.register
def _clean() -> None:
    for path, spark in _made.items():
        try:
            if path.startswith("file://"):
                shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
            else:
                drop_path(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone; what is left is only scratch
            pass


def stage_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that a lost executor costs one stage at most."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over as many partitions as shuffles have, by keys if given: adaptive execution puts few bytes in one task, however long their kernels take."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a path through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: from the driver's path where they share it, and on a cluster from a zip that Spark sends along."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    have = context.environment.get("PYTHONPATH", "").split(":")
    if root not in have:
        context.environment["PYTHONPATH"] = ":".join([root, *[x for x in have if x]])
    if not context.master.startswith("local") and context.applicationId not in _shipped:
        # executors fetch the file from here when their first task begins, late ones much later; a name is served once an application
        folder = os.path.realpath(tempfile.mkdtemp())
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(os.path.join(folder, f"thalweg-{_RUN}"), "zip", root, "thalweg"))
        _shipped.add(context.applicationId)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", app: str = "thalweg") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
