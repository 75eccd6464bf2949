"""Stateful streams: repeats, restarts, late rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.streaming import pipeline
from tests.conftest import rows

SHAPE = "platform string, report_type string, ingested_at string, raw_data string"


def _add(spark, base, data):
    spark.createDataFrame(data, SHAPE).coalesce(1).write.mode("append").parquet(f"{base}/in")


def _run(spark, base, transform):
    stream = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = pipeline.start_files(transform(stream), f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination()
    return query


def _row(day, x, clicks=1, kind="ad_daily"):
    return "facebook", kind, f"2026-01-{day:02d}T10:00:00", f'{{"spend": "{x}", "clicks": "{clicks}"}}'


def test_repeats_are_dropped_in_one_batch_in_later_ones_and_after_a_restart(spark, tmp_path):
    base, hot = str(tmp_path), _row(1, 1)
    _add(spark, base, [hot] * 500 + [_row(1, 2), _row(2, 1), (None, None, None, None), (None, None, None, None)])
    distinct = lambda s: pipeline.distinct_messages(s, "5 days")
    _run(spark, base, distinct)
    _add(spark, base, [hot, _row(3, 9)])
    _add(spark, base, [_row(1, 2), _row(3, 9), _row(30, 1)])
    _run(spark, base, distinct)
    got = spark.read.schema(SHAPE).parquet(f"{base}/out")
    assert rows(got) == sorted([hot, _row(1, 2), _row(2, 1), _row(3, 9), _row(30, 1)])
    assert pipeline.undated(spark.read.schema(SHAPE).parquet(f"{base}/in")).count() == 2


def test_state_is_let_go_behind_the_watermark(spark, tmp_path):
    base = str(tmp_path)
    for day in (1, 10, 20, 28):
        _add(spark, base, [_row(day, x) for x in range(50)])
    query = _run(spark, base, lambda s: pipeline.distinct_messages(s, "2 days"))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 50


def test_closed_windows_equal_the_batch_and_late_rows_are_counted(spark, tmp_path):
    base = str(tmp_path)
    first = [_row(d, d, d) for d in (1, 1, 2, 3, 9)] + [_row(2, "bad", "x")]
    _add(spark, base, first)
    windows = lambda s: pipeline.windowed_sums(s, "1 day", "2 days")
    assert pipeline.late_rows(_run(spark, base, windows)) == 0
    _add(spark, base, [_row(1, 100), _row(8, 8, 8)])
    assert pipeline.late_rows(_run(spark, base, windows)) == 1
    got = spark.read.parquet(f"{base}/out").select(F.dayofmonth("window_start"), "records", F.col("spend").cast("double"), "clicks")
    assert rows(got) == [(1, 2, 2.0, 2), (2, 2, 2.0, 2), (3, 1, 3.0, 3)]


def test_an_empty_stream(spark, tmp_path):
    base = str(tmp_path)
    _add(spark, base, [])
    _run(spark, base, lambda s: pipeline.distinct_messages(s))
    assert spark.read.schema(SHAPE).parquet(f"{base}/out").count() == 0
