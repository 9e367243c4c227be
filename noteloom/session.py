"""Session settings and the shared work folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans in this package count on. All of them are SQL settings
# that can be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot episode's partition even where the next operator could have reused
    # the join's partitioning: one more shuffle beats one straggler.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Records grouped by batch are joined to notes by batch and position where they lie. A
    # batch is a handful of rows, so the coarser key makes no large partitions.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # Rows that a Python worker is handed at a time hold whole notes and answers: parsed, they take
    # several times their length, in every worker of an executor at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


RUN_FOLDER = "noteloom.run.folder"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("noteloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine, and it is
    then named in the session so that later calls use the same one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="noteloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    folder = spark.conf.get(RUN_FOLDER, None) or work_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def one_run(spark: SparkSession) -> Iterator[str]:
    """Everything that is stored within goes to one folder, which is removed at the end.

    Stored tables hold note texts; results that are to stay belong elsewhere.
    """
    before = spark.conf.get(RUN_FOLDER, None)
    folder = f"{work_folder(spark)}/run-{uuid.uuid4().hex}"
    spark.conf.set(RUN_FOLDER, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(RUN_FOLDER)
        else:
            spark.conf.set(RUN_FOLDER, before)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the work folder and read it back.

    Cuts the lineage, survives lost executors, fixes values that a recomputation could
    change, and gives the planner the size of the files for its next broadcast decision.
    That size is a compressed one: text takes several times as much memory.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
