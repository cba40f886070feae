"""Streams. Each job takes a streaming frame, so any source works; progress lives in the shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableshift.operators.mutate import first_per_key
from tableshift.session import cut_lineage, work_folder


def read_files(spark: SparkSession, folder: str, schema: T.StructType, name: str = "*.parquet",
               files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream: those of ``folder`` that match ``name``, or those in the one folder of that name.

    Fails if nothing is there, since a stream over nothing would end well with no rows.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder, name)
    found = list(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or [])
    if not found:
        raise FileNotFoundError(f"nothing matches {name} in {folder}")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if all(f.isDirectory() for f in found):
        return reader.option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append-mode stream over what is there now and return the result as a batch frame."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain(stream: DataFrame, purpose: str = "stream") -> DataFrame:
    folder = work_folder(stream.sparkSession, purpose)
    return run_to_parquet(stream, f"{folder}/out", f"{folder}/checkpoint")


def with_open(closed: DataFrame, whole: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a finished stream has closed, and of a batch over the same rows what it left open (windows or sessions, by ``keys``)."""
    # Written first: with session windows below it, a join's pushed-down filters change how sessions merge.
    return closed.unionByName(cut_lineage(whole).join(closed.select(*keys), list(keys), "left_anti"))


class ChangeLogSync:
    """Upserts a stream of row changes into a copy, as a log of per-batch changes over a base.

    A batch is reduced to the newest change per key and overwrites its own folder, so a batch that is delivered again
    changes nothing, and no trigger rewrites the whole copy. Reading resolves the newest change per key. Every
    ``compact_every`` batches the base and log become a new base, after which only later batches are listed and read.
    """

    def __init__(self, spark: SparkSession, keys: Sequence[str], version: str, deleted: str, schema: T.StructType,
                 root: str | None = None, compact_every: int = 64):
        self.compact_every = compact_every
        self.spark, self.keys, self.version, self.deleted, self.schema = spark, list(keys), version, deleted, schema
        self.root = (root or work_folder(spark, "changelog")).rstrip("/")

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        self._newest(batch).write.mode("overwrite").parquet(f"{self.root}/changes/batch={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            self.compact()

    def start(self, stream: DataFrame, every: str | None = None):
        """Run once over what is there (triggered), or keep running at an interval (continuous)."""
        writer = (stream.writeStream.foreachBatch(self.write_batch)
                  .option("checkpointLocation", f"{self.root}/checkpoint"))
        writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
        return writer.start()

    def _newest(self, rows: DataFrame) -> DataFrame:
        return first_per_key(rows, self.keys, [self.version], last=True)

    def _finished(self, part: str, label: str) -> list[int]:
        """Numbers of the completely written ``label=n`` folders, by their success marks."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.root}/{part}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        marks = files.globStatus(hadoop.Path(folder, f"{label}=*/_SUCCESS")) or []
        return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)

    def _resolved(self) -> DataFrame:
        """The newest change per key, deletions included."""
        bases, batches = self._finished("base", "through"), self._finished("changes", "batch")
        base = self.spark.read.schema(self.schema).parquet(f"{self.root}/base/through={bases[-1]}") if bases else None
        later = [f"{self.root}/changes/batch={b}" for b in batches if not bases or b > bases[-1]]
        if not later:
            return self.spark.createDataFrame([], self.schema) if base is None else base
        fresh = self._newest(self.spark.read.schema(self.schema).parquet(*later))
        if base is None:
            return fresh
        # Only base rows with a later change meet the log; the rest passes through beside it.
        touched = fresh.select(*self.keys)
        met = base.join(touched, self.keys, "left_semi").unionByName(fresh)
        return base.join(touched, self.keys, "left_anti").unionByName(self._newest(met))

    def current(self) -> DataFrame:
        """The copy's rows now; deleted rows are gone."""
        return self._resolved().filter(~F.coalesce(F.expr(self.deleted), F.lit(False)))

    def compact(self) -> None:
        """Write a new base that covers every batch so far. Deletions stay in it, so a late older change cannot undo one."""
        batches = self._finished("changes", "batch")
        if batches and batches[-1:] != self._finished("base", "through")[-1:]:
            self._resolved().write.mode("overwrite").parquet(f"{self.root}/base/through={batches[-1]}")


def without_resends(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Each delivery once, however often it is sent within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def writes_per_window(stream: DataFrame, time: str, width: str, delay: str, by: Sequence[str] = ()) -> DataFrame:
    """(window_start, …by, writes) per tumbling window; in append mode a window is final once the delay has passed."""
    return (stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("writes"))
            .select(F.col("w.start").alias("window_start"), *by, "writes"))


def write_sessions(stream: DataFrame, keys: Sequence[str], time: str, quiet: str, delay: str) -> DataFrame:
    """(…keys, session_start, session_end, writes): bursts of writes separated by a quiet period."""
    return (stream.withWatermark(time, delay).groupBy(*keys, F.session_window(time, quiet).alias("w"))
            .agg(F.count(F.lit(1)).alias("writes"))
            .select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "writes"))
