import os

from pyspark.sql import functions as F

from tableshift import session
from tableshift.streaming import jobs


def test_settings_follow_the_volume():
    assert session.sized_for(0)["spark.sql.shuffle.partitions"] == "200"
    assert session.sized_for(10 << 40)["spark.sql.shuffle.partitions"] == "81920"
    assert session.sized_for(100 << 40)["spark.sql.shuffle.partitions"] == "819200"


def test_streams_run_on_the_disk_state_store(spark, tmp_path, rows):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.range(5).withColumn("ts", F.timestamp_seconds(F.col("id") + 1)).write.parquet(str(tmp_path / "in"))
    spark.conf.set(key, session.SETTINGS[key])
    try:
        stream = jobs.read_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
        assert rows(jobs.drain(jobs.without_resends(stream.union(stream), ["id"], "ts", "1 hour")), "id") == [(i,) for i in range(5)]
    finally:
        spark.conf.unset(key)


def test_working_files_stay_in_one_folder(spark):
    df, count = session.counted_step(spark.range(7))
    assert count == 7 and df.count() == 7
    folder = session.run_folder(spark)
    assert spark.sparkContext.applicationId in folder and session.work_folder(spark, "x").startswith(folder)
    assert os.path.isdir(folder.removeprefix("file:"))


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_folder(spark) == named.rstrip("/")
