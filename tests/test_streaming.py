from pyspark.sql import functions as F

from conftest import rows
from cohortline.operators import querylog as ql
from cohortline.sources import stand_in as s
from cohortline.streaming.rollup import minute_rollup


def test_stream_emits_closed_minutes_as_the_batch_does(spark, views, tmp_path):
    log = ql.structured_log(ql.extract_logs(views.query_logs()), s.CLIENTS)
    path = str(tmp_path / "in")
    log.orderBy("timestamp").coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(log.schema).parquet(path)
    query = (
        minute_rollup(stream).writeStream.format("memory").queryName("minutes").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    )
    query.processAllAvailable()
    query.stop()
    got = spark.table("minutes")
    batch = minute_rollup(spark.read.parquet(path))
    assert got.count() > 0
    assert set(map(repr, rows(got))) <= set(map(repr, rows(batch)))
    missing = batch.join(got, ["minute", "dbid"], "left_anti")
    newest = log.agg(F.max("timestamp")).first()[0]
    late = missing.where(F.col("minute") + F.expr("INTERVAL 11 MINUTES") <= F.lit(newest))
    assert late.count() == 0


def test_rollup_agrees_with_the_minute_statistics(views):
    log = ql.structured_log(ql.extract_logs(views.query_logs()), s.CLIENTS)
    columns = ["minute", "dbid", "submitted_queries", "completed_queries", "submitted_millis", "completed_memory_bytes",
               "stacktrace_lines", "error_message_characters", "imputed_match_lines", "total_submit_errors"]
    assert rows(minute_rollup(log), *columns) == rows(ql.minute_stats(log), *columns)
