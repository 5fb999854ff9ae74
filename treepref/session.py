"""Session construction and shared I/O helpers.

The library never creates hidden sessions inside operators: every operator takes
DataFrames (or a session plus a table directory) and returns a lazy DataFrame.
This module only builds a session for tests, bench and the CLI-free examples.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "treepref") -> SparkSession:
    """Session tuned for the pipelines: AQE on (coalesce + skew join), UI off.

    Under ``spark-submit`` or in a running session the cluster's own settings
    stay: a value is only filled in where it is unset.
    """
    running = SparkSession.getActiveSession()
    if running is not None and master is None and shuffle_partitions is None:
        return running
    given = dict(SparkConf().getAll())
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.app.name": app,
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Compressed text shuffles after a partial aggregate are small, but the
        # per-row text work after them is heavy: a 1 MB floor would fold them
        # into one task.  The floor only binds on small shuffles; on large
        # inputs the advisory size and the parallelism decide.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if "spark.master" not in given or master:
        conf |= {"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus}
    b = SparkSession.builder
    for k, v in conf.items():
        if k not in given:
            b = b.config(k, v)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names this folder.  Only a local master, whose one process sees
    every file, gets a folder of its own; elsewhere an unset folder is an error,
    since executors do not see each other's disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get(spark.sparkContext.applicationId)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="treepref-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


#: Checkpoint folders made here, by application (local masters only).
_LOCAL: dict[str, str] = {}
#: Applications whose workers have this package.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not share the driver's path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="treepref-"), "treepref.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_path`` once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write an intermediate that later steps read several times as a parquet
    table in the shared checkpoint folder and read it back.

    This cuts the lineage (the table survives the loss of the executors that
    made it), computes and plans the intermediate once (an eager RDD
    checkpoint would compute it twice), and gives the optimizer real sizes and
    column pruning on the read-back.  Pass ``path`` (from ``scratch_path``) to
    drop the table later."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a task gets of a table whose rows become many (:func:`dealt`).
ROWS_PER_TASK = 10_000


def dealt(df: DataFrame, key: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt by ``key`` over tasks of about ``rows`` rows each, one task a core at least.

    For a narrow table whose rows become many, or cost much, in the same stage: AQE would
    fold its few bytes into one task, however many rows they stand for, and does not fold
    partitions whose number is given."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows))
    return df.repartition(n, key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
