"""Each lake file once into bronze: growing lakes, damage, replays and runs that die."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import types as T

from adloom.sources import intake
from tests.conftest import rows

SCHEMA = T.StructType().add("id", "string").add("spend", "string")


def land(root, minute, name, text):
    folder = root / "ads" / "2026" / "01" / "02" / "03" / minute
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture
def lake_dir(tmp_path):
    land(tmp_path / "lake", "00", "array.json", '[{"id": "1", "spend": "5"},\n {"id": "2"}]')
    land(tmp_path / "lake", "05", "lines.json", '{"id": "3"}\n\n{"id": "4", "spend": "x"}\n')
    return tmp_path / "lake"


def taken(spark, base):
    return rows(intake.read_bronze(spark, base, "ads", SCHEMA))


def counts(spark, base):
    found = intake.files_taken(spark, base).collect()
    return {os.path.basename(r["path"]): (r["version"], r["records"], r["damaged"]) for r in found}


def test_two_runs_over_a_growing_lake_give_each_record_once(spark, lake_dir, tmp_path):
    base = str(tmp_path / "base")
    intake.run_intake(spark, str(lake_dir), "ads", base, SCHEMA)
    assert taken(spark, base) == [("1", "5"), ("2", None), ("3", None), ("4", "x")]
    # A late file of an old minute, and one that repeats a record: both are the lake's, so both count.
    land(lake_dir, "00", "late.json", '{"id": "9"}')
    land(lake_dir, "10", "again.txt", '[{"id": "1", "spend": "5"}]')
    os.utime(lake_dir / "ads/2026/01/02/03/00/late.json", (1_500_000_000, 1_500_000_000))
    for _ in range(2):
        intake.run_intake(spark, str(lake_dir), "ads", base, SCHEMA, max_files=1)
    assert taken(spark, base) == [("1", "5"), ("1", "5"), ("2", None), ("3", None), ("4", "x"), ("9", None)]
    assert counts(spark, base) == {"array.json": (0, 2, 0), "lines.json": (0, 2, 0), "late.json": (0, 1, 0), "again.txt": (0, 1, 0)}
    origin = intake.read_bronze(spark, base, "ads", SCHEMA, origin=True)
    assert origin.select("load").distinct().count() == 3


def test_damage_is_kept_and_a_replay_replaces_the_file(spark, lake_dir, tmp_path):
    base = str(tmp_path / "base")
    land(lake_dir, "10", "broken.json", '{"id": "7"}\n{"id": \n{"id": "8"}')
    land(lake_dir, "10", "mixed.json", '[{"id": "5"}, null]')
    land(lake_dir, "10", "number.json", '[{"id": "6"}, 6]')
    land(lake_dir, "10", "empty.json", " \n")
    intake.run_intake(spark, str(lake_dir), "ads", base, SCHEMA)
    assert [r[0] for r in taken(spark, base)] == ["1", "2", "3", "4", "5", "7", "8"]
    found = counts(spark, base)
    assert (found["broken.json"], found["mixed.json"], found["empty.json"]) == ((0, 2, 1), (0, 1, 1), (0, 0, 0))
    # An array with anything but objects cannot be told apart: it is one damaged unit, kept whole.
    assert found["number.json"] == (0, 0, 1)
    damaged = rows(intake.read_damaged(spark, base, "ads", SCHEMA))
    assert [unit for _, unit in damaged] == ['[{"id": ]', '[{"id": "5"}, null]', '[{"id": "6"}, 6]']

    path = next(r["path"] for r in intake.files_taken(spark, base).collect() if r["path"].endswith("broken.json"))
    land(lake_dir, "10", "broken.json", '{"id": "7"}\n{"id": "70"}\n{"id": "8"}')
    intake.run_intake(spark, str(lake_dir), "ads", base, SCHEMA)
    assert counts(spark, base)["broken.json"] == (0, 2, 1)
    for version in (1, 2):
        intake.replay(spark, str(lake_dir), "ads", base, path, SCHEMA)
        assert counts(spark, base)["broken.json"] == (version, 3, 0)
        assert [r[0] for r in taken(spark, base)] == ["1", "2", "3", "4", "5", "7", "70", "8"]
    assert intake.read_damaged(spark, base, "ads", SCHEMA).count() == 2
    with pytest.raises(ValueError):
        intake.replay(spark, str(lake_dir), "ads", base, path + "x", SCHEMA)


def test_a_load_without_ledger_is_not_read(spark, lake_dir, tmp_path):
    base = str(tmp_path / "base")
    intake.run_intake(spark, str(lake_dir), "ads", base, SCHEMA)
    # As if a second run had died between its bronze rows and its ledger.
    shutil.copytree(f"{base}/bronze/load=intake-000000000", f"{base}/bronze/load=intake-000000001")
    assert len(taken(spark, base)) == 4
    land(lake_dir, "10", "next.json", '{"id": "9"}')
    intake.run_intake(spark, str(lake_dir), "ads", base, SCHEMA)
    assert [r[0] for r in taken(spark, base)] == ["1", "2", "3", "4", "9"]


def test_missing_table_and_clashing_columns(spark, tmp_path):
    base = str(tmp_path / "base")
    intake.run_intake(spark, str(tmp_path / "lake"), "ads", base, SCHEMA)
    assert taken(spark, base) == [] and intake.ledger(spark, base).count() == 0
    with pytest.raises(ValueError):
        intake.run_intake(spark, str(tmp_path / "lake"), "ads", base, T.StructType().add("load", "string"))
