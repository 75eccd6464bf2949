"""Merge on write, incremental roll-ups, histories, interval joins and clustering on small tables."""

from __future__ import annotations

import datetime
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adloom.operators import history, intervals, rollup, sketches
from adloom.plans import incremental
from adloom.session import SHUFFLE_CLEANUP
from adloom.sinks import files, merge, warehouse
from tests.conftest import plan, rows

D, TS = datetime.date, datetime.datetime
FACT, FLAT = "fact_fb_ad_daily", "fad_ad_daily_report"
METRICS = ["spend", "clicks"]


def _fact(spark, data):
    """(day, account, ad, spend, clicks, hour of landing)."""
    typed = [(d, a, i, Decimal(s), c, TS(2026, 5, 1, h)) for d, a, i, s, c, h in data]
    shape = "date_start date, account_id string, ad_id string, spend decimal(18,2), clicks int, updated_at timestamp"
    return spark.createDataFrame(typed, shape)


def _same(spark, root, table):
    """The merged table equals the one re-ranked from all loads."""
    merged, ranked = merge.read_merged(spark, root, table), warehouse.read_current(spark, root, table)
    assert merged.columns == ranked.columns
    assert rows(merged) == rows(ranked)
    return merged


def _files(spark, root, table):
    return {r.ym: set(r.f) for r in merge.months_of(spark, root, table).read().groupBy("ym").agg(F.collect_set("_metadata.file_path").alias("f")).collect()}


JAN, FEB, MAR = D(2026, 1, 5), D(2026, 2, 5), D(2026, 3, 5)
LOADS = [
    [(JAN, "1", "a", 1, 1, 1), (JAN, "1", "b", 2, 2, 1), (FEB, "1", "a", 3, 3, 1), (MAR, "2", "c", 4, 4, 1)],
    [(FEB, "1", "a", 30, 3, 2), (FEB, "1", "n", 5, 5, 2)],
    [(JAN, "1", "a", 10, 1, 0), (FEB, "1", "n", 50, 5, 3), (FEB, "1", "n", 51, 5, 3)],
]


def _append(spark, root, i, data):
    warehouse.append(_fact(spark, data), root, FACT, f"load-{i}")
    return merge.merge_load(spark, root, FACT, f"load-{i}")


def test_merged_table_equals_the_ranked_loads_and_leaves_other_months_alone(spark, tmp_path):
    root = str(tmp_path)
    assert merge.read_merged(spark, root, FACT).count() == 0
    assert _append(spark, root, 1, LOADS[0]) == ["202601", "202602", "202603"]
    _same(spark, root, FACT)
    before = _files(spark, root, FACT)
    assert _append(spark, root, 2, LOADS[1]) == ["202602"]
    after = _files(spark, root, FACT)
    assert {m for m in before if before[m] == after[m]} == {"202601", "202603"}
    _append(spark, root, 3, LOADS[2])
    merged = _same(spark, root, FACT)
    got = {(r.date_start, r.ad_id): r.spend for r in merged.collect()}
    assert got[JAN, "a"] == 1 and got[FEB, "n"] == 51  # an older version loses, of equal ones the greater values win
    part = merge.read_merged(spark, root, FACT, FEB, FEB)
    assert part.count() == 2 and "PartitionFilters: [isnotnull(ym" in plan(part) and "Exchange" not in plan(part)


def test_loads_merge_in_any_order_and_again(spark, tmp_path):
    root = str(tmp_path)
    for i in (3, 1, 2):
        _append(spark, root, i, LOADS[i - 1])
    _same(spark, root, FACT)
    _append(spark, root, 2, [(MAR, "2", "c", 9, 9, 9)])  # appended anew: its February rows are gone
    got = {(r.date_start, r.ad_id): r.spend for r in _same(spark, root, FACT).collect()}
    assert got[FEB, "a"] == 3 and got[MAR, "c"] == 9
    assert _append(spark, root, 2, []) == ["202603"]
    assert _same(spark, root, FACT).where("ad_id = 'c'").first().spend == 4
    assert _append(spark, root, 4, []) == []


def test_a_month_that_loses_all_rows_goes(spark, tmp_path):
    root = str(tmp_path)
    _append(spark, root, 1, LOADS[0][:1])
    _append(spark, root, 1, LOADS[0][3:])
    assert set(_files(spark, root, FACT)) == {"202603"}
    _same(spark, root, FACT)


def test_a_merge_that_dies_before_it_replaces_months_is_finished_later(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _append(spark, root, 1, LOADS[0])
    with monkeypatch.context() as patch:
        patch.setattr(merge.Months, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            _append(spark, root, 2, LOADS[1])
    assert {r.ad_id for r in merge.read_merged(spark, root, FACT).collect()} == {"a", "b", "c"}
    _append(spark, root, 3, LOADS[2])
    _same(spark, root, FACT)


def test_dimensions_and_tables_without_version_merge_too(spark, tmp_path):
    root = str(tmp_path)
    for i, names in enumerate([[("1", "x"), ("2", "y")], [("2", "z")]]):
        data = [(*n, TS(2026, 1, i + 1)) for n in names]
        warehouse.append(spark.createDataFrame(data, "account_id string, account_name string, updated_at timestamp"), root, "dim_account", f"load-{i}")
        assert merge.merge_load(spark, root, "dim_account", f"load-{i}") == [merge.WHOLE]
    assert [r[:2] for r in rows(_same(spark, root, "dim_account"))] == [("1", "x"), ("2", "z")]


def test_one_key_with_many_versions_is_cut_before_the_shuffle(spark, tmp_path):
    hot = spark.range(60_000).select(
        F.lit(JAN).alias("date_start"), F.lit("1").alias("account_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("ad_id"), F.col("id").cast("int").alias("clicks"),
        (F.lit(TS(2026, 1, 1)) + F.make_dt_interval(secs=F.col("id"))).alias("updated_at"),
    )
    warehouse.append(hot, str(tmp_path), FACT, "load-1")
    merge.merge_load(spark, str(tmp_path), FACT, "load-1")
    merged = merge.read_merged(spark, str(tmp_path), FACT)
    assert merged.count() == 40_001 and merged.where("ad_id = 'hot'").first().clicks == 59_997


# --- incremental roll-ups ---


def _flat(spark, data):
    shape = "id string, adset_id string, campaign_id string, account_id string, date_start date, spend decimal(18,2), clicks int"
    df = spark.createDataFrame([(i, s, c, a, d, Decimal(x), n) for i, s, c, a, d, x, n in data], shape)
    return df.withColumn("date_stop", F.col("date_start"))


FLAT_LOADS = [
    [("a", "s1", "c1", "1", JAN, 1, 1), ("b", "s1", "c1", "1", JAN, 2, 2), ("c", "s2", "c1", "1", FEB, 3, 3), ("d", "s3", "c2", "2", FEB, 4, None)],
    [("b", "s1", "c1", "1", JAN, 20, 7), ("e", "s2", "c1", "1", JAN, 5, 5), ("b", "s1", "c1", "1", JAN, 20, 7)],
    [("c", "s2", "c1", "1", FEB, 30, 3)],
]


def _levels_equal(spark, root):
    current = warehouse.read_current(spark, root, FLAT)
    full = rollup.daily_levels(current.withColumn("records", F.lit(1)), ["records", *METRICS])
    assert rows(incremental.read_levels(spark, root, FLAT, METRICS)) == rows(full)


def _merge_flat(spark, root, i, data):
    warehouse.append(_flat(spark, data), root, FLAT, f"load-{i}")
    return incremental.merge_load(spark, root, FLAT, f"load-{i}", METRICS)


def test_incremental_levels_equal_a_full_sum(spark, tmp_path):
    root = str(tmp_path)
    for i, data in enumerate(FLAT_LOADS):
        _merge_flat(spark, root, i, data)
        _levels_equal(spark, root)
    assert _merge_flat(spark, root, 2, FLAT_LOADS[2]) == ["202602"]  # again: nothing counts twice
    _levels_equal(spark, root)
    _merge_flat(spark, root, 2, [])  # appended anew without rows
    _levels_equal(spark, root)
    assert _merge_flat(spark, root, 9, []) == []


def _shuffled(spark):
    """Shuffle files that lie on the disk."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and f.endswith(".data")}


def test_writes_of_a_merge_leave_no_shuffles(spark, tmp_path, monkeypatch):
    root, left = str(tmp_path), []
    finest, stage = rollup.levels_of_finest, merge.Months.stage

    def gone(before):
        for _ in range(50):
            if not _shuffled(spark) - before:
                return True
            time.sleep(0.2)
        return False

    def staged(self, *x):
        before = _shuffled(spark)
        stage(self, *x)
        left.append(gone(before))

    def levels(*x):
        left.append(gone(begun))
        return finest(*x)

    warehouse.append(_flat(spark, FLAT_LOADS[0]), root, FLAT, "load-0")
    monkeypatch.setattr(merge.Months, "stage", staged)
    monkeypatch.setattr(rollup, "levels_of_finest", levels)
    monkeypatch.setattr(merge, "_touched", lambda df: ["202601", "202602"])  # its small shuffle is not a write's
    begun = _shuffled(spark)
    incremental.merge_load(spark, root, FLAT, "load-0", METRICS)
    assert left == [True, True, True]
    assert not os.listdir(f"{root}/levels/{FLAT}/differences")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_only_the_months_of_a_load_are_read(spark, tmp_path):
    root = str(tmp_path)
    _merge_flat(spark, root, 0, FLAT_LOADS[0])
    warehouse.append(_flat(spark, FLAT_LOADS[1]), root, FLAT, "load-1")
    signed = merge.changes(spark, root, FLAT, "load-1")
    assert sorted((r.sign, r.id) for r in signed.collect()) == [(-1, "b"), (1, "b"), (1, "e")]
    assert "PartitionFilters: [isnotnull(ym" in plan(signed) and "202601" in plan(signed)


@pytest.mark.parametrize("dies", ["stage", "fact", "publish"])
def test_a_run_that_dies_counts_nothing_twice(spark, tmp_path, monkeypatch, dies):
    root = str(tmp_path)
    _merge_flat(spark, root, 0, FLAT_LOADS[0])
    warehouse.append(_flat(spark, FLAT_LOADS[1]), root, FLAT, "load-1")
    lost = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with monkeypatch.context() as patch:
        if dies == "fact":
            patch.setattr(merge, "merge_load", lost)
        else:
            whole = getattr(merge.Months, dies)
            patch.setattr(merge.Months, dies, lambda self, *x: lost() if "/levels/" in self.path else whole(self, *x))
        with pytest.raises(RuntimeError):
            incremental.merge_load(spark, root, FLAT, "load-1", METRICS)
    incremental.merge_load(spark, root, FLAT, "load-1", METRICS)
    _levels_equal(spark, root)
    _merge_flat(spark, root, 2, FLAT_LOADS[2])
    _levels_equal(spark, root)


# --- histories ---


def test_a_campaign_renamed_twice_reports_each_day_under_its_own_name(spark):
    day = lambda n: D(2026, 1, 1) + datetime.timedelta(days=n)
    data = [("k", "A", day(0), 1), ("k", "A", day(1), 1), ("k", "B", day(40), 1), ("k", "A", day(41), 1), ("k", "B", day(41), 2), ("k", "A", day(90), 1),
            ("k", None, day(95), 1), ("k", None, day(96), 1), ("j", "X", day(3), None), (None, "n", day(0), 1), ("k", "n", None, 1)]
    seen = spark.createDataFrame(data, "k string, name string, date_start date, updated_at int")
    found = history.validity(seen, "k", ["name"])
    assert rows(found) == rows(spark.createDataFrame([
        ("j", "X", day(3), None, True), ("k", "A", day(0), day(40), False), ("k", "A", day(90), day(95), False),
        ("k", "B", day(40), day(90), False), ("k", None, day(95), None, True)], found.schema))
    facts = spark.createDataFrame([("k", day(n), n) for n in (-1, 0, 39, 40, 89, 90, 94, 95, 400)] + [("x", day(1), 5), (None, day(1), 6), ("k", None, 7)], "k string, date_start date, n int")
    got = history.as_of(facts, found, "k")
    assert {r.n: r.name for r in got.collect()} == {-1: None, 0: "A", 39: "A", 40: "B", 89: "B", 90: "A", 94: "A", 95: None, 400: None, 5: None, 6: None, 7: None}
    assert {r.n: r.valid_from for r in got.collect()}[400] == day(95)
    assert got.count() == facts.count() and "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert history.as_of(facts, found.limit(0), "k").count() == facts.count()
    assert history.as_of(facts.limit(0), found, "k").count() == 0
    assert history.validity(seen.limit(0), "k", ["name"]).count() == 0


def test_history_of_a_key_with_a_third_of_all_rows(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 7 % 2).alias("name"),
        F.date_add(F.lit(D(2026, 1, 1)), (F.col("id") % 10).cast("int")).alias("date_start"), F.col("id").alias("updated_at"),
    )
    found = history.validity(df, "k", ["name"])
    assert "WindowGroupLimit" in plan(found)
    assert history.as_of(df, found.withColumnRenamed("name", "then"), "k").count() == 60_000


# --- interval joins ---


def test_overlaps_equal_a_nested_loop(spark):
    day = lambda n: None if n is None else D(2026, 1, 1) + datetime.timedelta(days=n)
    data = [(i, i % 3, (i * 37) % 200 - 50, (i * 37) % 200 - 50 + (i * 13) % 60) for i in range(90)]
    data += [(100, 0, 5, 4), (101, None, 0, 300), (102, 1, None, 9), (103, 1, 9, None), (104, 2, -400, 900), (105, 2, 7, 7)]
    df = spark.createDataFrame([(i, g, day(s), day(e)) for i, g, s, e in data], "id int, g int, s date, e date")
    fine = [r for r in data if None not in r and r[2] <= r[3]]
    expected = sorted((a[0], b[0], day(max(a[2], b[2])), day(min(a[3], b[3]))) for a in fine for b in fine
                      if a[0] < b[0] and a[1] == b[1] and max(a[2], b[2]) <= min(a[3], b[3]))
    for width in (1, 7, 45, 5000):
        got = intervals.overlapping_pairs(df, "id", ["g"], "s", "e", width)
        assert rows(got.select("a", "b", "overlap_start", "overlap_end")) == expected
        assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    ungrouped = intervals.overlapping_pairs(df.where("g IS NOT NULL"), "id", [], "s", "e", 30)
    assert ungrouped.count() == sum(a[0] < b[0] and max(a[2], b[2]) <= min(a[3], b[3]) for a in fine for b in fine if None not in (a[1], b[1]))
    assert intervals.overlapping_pairs(df.limit(0), "id", ["g"], "s", "e", 30).count() == 0


# --- clustering ---


def test_clustering_narrows_both_columns(spark, tmp_path):
    df = spark.range(40_000).select((F.col("id") * 7919 % 1000).alias("k"), F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 997).cast("int")).alias("d"), F.col("id").alias("v"))
    files.write_clustered(df, f"{tmp_path}/z", ["k", "d"], 16)
    boxes = files.file_boxes(spark, f"{tmp_path}/z", ["k", "d"])
    assert sum(r.records for r in boxes.collect()) == 40_000
    hits = lambda c: boxes.where(c).count()
    assert hits("low_k <= 100 AND high_k >= 50") <= 8 and hits("low_d <= date'2020-03-01' AND high_d >= date'2020-02-01'") <= 8
    assert rows(spark.read.parquet(f"{tmp_path}/z")) == rows(df)


def test_clustering_of_equal_null_and_no_rows(spark, tmp_path):
    same = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 5).alias("k"), F.lit(D(2020, 1, 1)).alias("d"))
    files.write_clustered(same, f"{tmp_path}/same", ["k", "d"], 8)
    boxes = files.file_boxes(spark, f"{tmp_path}/same", ["k", "d"]).collect()
    assert sum(r.records for r in boxes) == 20_000 and max(r.records for r in boxes) < 10_000
    files.write_clustered(same.limit(0), f"{tmp_path}/none", ["k", "d"], 8)
    assert spark.read.schema(same.schema).parquet(f"{tmp_path}/none").count() == 0
    assert spark.range(1).select(files.interleaved([F.lit(3), F.lit(0)], 2).alias("a"), files.interleaved([F.lit(0), F.lit(3)], 2).alias("b")).first() == (10, 5)


# --- sketches ---


def test_united_sketches_count_a_person_once(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("ad"), F.when(F.col("id") % 100 > 0, F.col("id") % 5000).alias("person")
    )
    daily = sketches.reach_sketches(df, ["ad"], "person")
    whole = sketches.estimated(sketches.united(daily, [])).first().reach
    exact = df.select("person").where("person IS NOT NULL").distinct().count()
    assert abs(whole - exact) <= exact * sketches.relative_error()
    assert sketches.estimated(daily).where("ad = 0").first().reach > 0
    assert sketches.estimated(sketches.reach_sketches(df.where("person IS NULL"), ["ad"], "person")).where("reach <> 0").count() == 0
    assert sketches.reach_sketches(df.limit(0), ["ad"], "person").count() == 0
