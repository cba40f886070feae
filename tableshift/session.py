"""Settings the engine relies on, and the shared folder it works in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffle partitions are only an upper bound under adaptive execution, which merges small ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # Sessions of one key meet inside a task first, so a hot key sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Streams keep their state on disk, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(builder: SparkSession.Builder, **overrides: str) -> SparkSession.Builder:
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder


def sized_for(total_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a volume of data: enough shuffle partitions that each stays near 128 MiB.

    Adaptive execution merges partitions that turn out small, and splits skewed ones, but never adds any.
    """
    return {"spark.sql.shuffle.partitions": str(max(200, -(-total_bytes // partition_bytes))),
            "spark.sql.files.maxPartitionBytes": str(partition_bytes)}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")
    folder = tempfile.mkdtemp(prefix="tableshift-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps its working files."""
    return f"{shared_folder(spark)}/tableshift/{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in this application's folder."""
    return f"{run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def clear_run_folder(spark: SparkSession) -> bool:
    """Delete this application's working files, once nothing reads them any more. Stores with their own root stay."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few numbers that one task may take, and the number of tasks that is never worth going below.
NARROW_ROWS, FEWEST_TASKS = 1 << 18, 16


def sized(df: DataFrame, rows: int) -> DataFrame:
    """A frame of narrow rows in no more tasks than ``rows``, the most rows it can be made of, need.

    A short table is then not written as a nearly empty file per shuffle partition, also where adaptive execution may not merge them.
    A long one keeps all its tasks.
    """
    return df.coalesce(max(FEWEST_TASKS, -(-rows // NARROW_ROWS)))


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: a lost executor loses nothing, and the plan starts afresh.

    A written table is used because a checkpointed frame keeps the constraints of the plan it came from, which grow
    with every round of a loop.
    """
    return counted_step(df, path)[0]


def counted_step(df: DataFrame, path: str | None = None) -> tuple[DataFrame, int]:
    """``cut_lineage`` that also returns the number of rows, counted while they are written."""
    path = path or work_folder(df.sparkSession, "step")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]
