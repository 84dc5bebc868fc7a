"""Session settings, the shared scratch folder and the table loader."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on; all can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Session setting that names the folder of the innermost ``owned_scratch`` block.
_OWNED = "spark.tablework.scratch"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablework")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` when the cluster names one.

    Only a session without that setting (a local test) gets a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # Spark appends a unique folder of its own below the one it was given
        return current.rstrip("/").rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="tablework-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, inside the folder of ``owned_scratch`` when there is one."""
    owned = spark.conf.get(_OWNED, None)
    if owned:
        return f"{owned}/{name}-{uuid.uuid4().hex}"
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return f"{shared_dir(spark)}/tablework/{name}-{uuid.uuid4().hex}"


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate results written inside the block; it is dropped when the block ends.

    Results have to be written or collected inside the block: plans made there read from the folder. Blocks may be
    nested.
    """
    before, root = spark.conf.get(_OWNED, None), scratch_path(spark, "owned")
    spark.conf.set(_OWNED, root)
    try:
        yield root
    finally:
        if before:
            spark.conf.set(_OWNED, before)
        else:
            spark.conf.unset(_OWNED)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
