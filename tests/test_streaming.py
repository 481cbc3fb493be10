import datetime as dt

from thalweg.streaming.status import claim_batches, counted, latest, transitions

SCHEMA = "aoi_id long, status string, ts timestamp"


def at(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


ROWS = [(1, "READY", at(1)), (1, "FP_PROCESSING", at(2)), (1, "WS_DONE", at(3)), (1, "FP_DONE", at(3, 30)), (2, "FP_DONE", at(1)), (2, "READY", at(1, 5))]


def test_latest_and_counts_of_a_table(spark):
    changes = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted((r.aoi_id, r.status) for r in latest(changes).collect()) == [(1, "FP_DONE"), (2, "READY")]
    assert {(r.status, r.n) for r in counted(changes).filter("hour(start) = 1").collect()} == {("READY", 2), ("FP_DONE", 1)}


def test_transitions_of_a_stream_keep_state_across_batches(spark, tmp_path):
    source = f"{tmp_path}/in"
    for k in range(0, len(ROWS), 2):
        spark.createDataFrame(ROWS[k : k + 2], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    q = transitions(stream).writeStream.format("memory").queryName("moves").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.aoi_id, r.before, r.status): r.valid for r in spark.sql("SELECT * FROM moves").collect()}
    assert got == {(1, None, "READY"): True, (1, "READY", "FP_PROCESSING"): True, (1, "FP_PROCESSING", "WS_DONE"): False, (1, "FP_PROCESSING", "FP_DONE"): True, (2, None, "FP_DONE"): False, (2, None, "READY"): True}


def test_ready_units_are_claimed(spark, tmp_path):
    source, seen = f"{tmp_path}/in", []
    spark.createDataFrame(ROWS, SCHEMA).coalesce(1).write.parquet(source)
    q = claim_batches(spark.readStream.schema(SCHEMA).parquet(source), lambda d: seen.extend(r.aoi_id for r in d.collect()), f"{tmp_path}/c")
    q.processAllAvailable()
    q.stop()
    assert seen == [2]
