"""SparkSession factory and cluster-safe checkpointing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of marts / PageRank rounds are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "kestrel") -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests
    pass ``local[8]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python
    workers can import it wherever the driver was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_kestrel_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(top):      # not already running from a zip sent with --py-files
        target = os.path.join(tempfile.mkdtemp(prefix="kestrel-pkg-"), "kestrel.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(top)))
        sc.addPyFile(target)
    sc._kestrel_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting (tests) gets a folder of its own;
    on a cluster the setting is required, as no machine-local folder would be
    seen by every executor.
    """
    sc = spark.sparkContext
    ship_package(spark)
    current = sc.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            configured = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    if not getattr(sc, "_kestrel_cleans", False):
        # whoever made the session: checkpoints go once nothing refers to them, the application's own folder at its end
        sc._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        path = sc._jvm.org.apache.hadoop.fs.Path(current)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
        sc._kestrel_cleans = True
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, removed when the application ends."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder of `scratch_dir` that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder and go on from there.

    The shuffle files that it came from are deleted once it is written: nothing reads them again.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return cut_lineage(df.select("*"))      # a new statement: the setting counts when a statement is made
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint), and truncates the
    plan of iterative operators such as PageRank.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Rows that are worth a task of their own in work that passes over them many times, and rows of a task at most.
FEW_ROWS, MANY_ROWS = 4096, 50_000


def spread(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """Deal ``df``, of about so many rows, by ``key`` to as many tasks as there are cores, and more if these would be large.

    What adaptive execution leaves is laid out for one pass over its bytes, often in a single partition; training
    computes for minutes over few bytes.  A table of up to ``FEW_ROWS`` rows is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, -(-rows // FEW_ROWS)), -(-rows // MANY_ROWS))
    return df.repartition(tasks, *key) if tasks > 1 else df
