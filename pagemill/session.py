"""Session helpers.

Library code never builds its own session: it takes the caller's.
``local_session`` is for tests, the bench and the driver entry point only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pagemill") -> SparkSession:
    # local Python workers import the package from its source folder (on a
    # cluster it is shipped with --py-files or installed on the executors)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root] + paths)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # pages can be tens of KB each: keep Arrow batches to the Python
        # workers bounded in bytes, not only in rows
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without one there is no folder that all executors see, so this fails.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="pagemill-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, written: list | None = None) -> DataFrame:
    """Materialise ``df`` as a parquet table in the checkpoint folder and read it back.

    Survives executor loss (the files are in the cluster's shared checkpoint
    folder) and cuts lineage. Unlike an eager ``checkpoint()``, which runs the
    plan once to count and again to write, the plan runs once; reads of the
    table are columnar and pruned.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagemill-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if written is not None:
        written.append(path)
    return spark.read.parquet(path)


def drop_tables(spark: SparkSession, paths: list) -> None:
    """Delete intermediate tables written by ``cut_lineage`` once nothing reads them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def default_parallelism(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers of an existing session import this package.

    Python functions carry ``SparkContext.environment`` to the workers and
    the worker's PYTHONPATH is merged from it, so adding the package root
    here works for sessions built elsewhere (e.g. by a driver harness). On a
    cluster the package is installed or shipped with --py-files instead and
    the extra path entry is harmless.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join(paths + [root])
