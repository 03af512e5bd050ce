"""Versioned tables: replacing keys, files opened, commits of two writers, interrupted commits."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradewake.operators import incremental
from tradewake.sources import day_table
from tradewake.sources.day_table import Conflict, DayTable, Replaced

SCHEMA = "k string, d date, v int"


def day(n):
    return date(2024, 1, n)


@pytest.fixture
def table(spark, tmp_path):
    made = DayTable(spark, str(tmp_path / "table"), "d", "k", ("k",))

    def fill(*data):
        made.replace_all(spark.createDataFrame(list(data), SCHEMA))
        return made
    return fill


@pytest.fixture
def frame(spark):
    return lambda *data: spark.createDataFrame(list(data), SCHEMA)


def read(rows, table):
    return rows(table.read(), "k", "d", "v")


def test_watermark_comes_from_the_manifest_alone(spark, table, tmp_path):
    made = table(("a", day(1), 1), ("b", day(9), 1), ("c", None, 1))
    for name in (tmp_path / "table" / "data").rglob("*.parquet"):
        name.write_bytes(b"no parquet at all")
    assert made.days() == ("2024-01-01", "2024-01-09") and made.loaded_to() == "2024-01-09"
    assert DayTable(spark, str(tmp_path / "missing"), "d", "k").loaded_to() is None


def test_same_delta_twice_changes_nothing(table, frame, rows):
    made = table(("a", day(1), 1), ("b", day(2), 1))
    delta = frame(("b", day(2), 7), ("c", day(3), 1))
    for _ in range(2):
        assert made.replace_keys(delta).rows == 2
        assert read(rows, made) == [("a", day(1), 1), ("b", day(2), 7), ("c", day(3), 1)]


def test_moved_key_leaves_its_old_day(table, frame, rows):
    made = table(("a", day(1), 1), ("b", day(1), 1), ("c", day(2), 1))
    made.replace_keys(frame(("a", day(5), 2), ("c", day(5), 2)))
    assert read(rows, made) == [("a", day(5), 2), ("b", day(1), 1), ("c", day(5), 2)]
    made.replace_keys(frame(("a", day(6), 3)))
    assert read(rows, made) == [("a", day(6), 3), ("b", day(1), 1), ("c", day(5), 2)]


def test_rows_without_a_day_or_a_key(table, frame, rows):
    made = table(("a", None, 1), ("b", day(1), 1), (None, day(1), 1))
    made.replace_keys(frame(("a", day(1), 2), ("c", None, 3), (None, day(2), 4)))
    assert read(rows, made) == [(None, day(1), 1), (None, day(2), 4), ("a", day(1), 2),
                                ("b", day(1), 1), ("c", None, 3)]


def test_empty_deltas_and_empty_tables(table, frame, rows):
    made = table(("a", day(1), 1))
    assert made.replace_keys(frame()) == Replaced(0, 0)
    assert made.manifest().number == 1
    empty = table()
    assert read(rows, empty) == [] and empty.days() == (None, None) and empty.loaded_to() is None
    empty.replace_keys(frame(("a", day(2), 1)))
    assert read(rows, empty) == [("a", day(2), 1)]


def test_delta_read_from_the_table_it_changes(table, frame, rows):
    made = table(("a", day(1), 1), ("b", day(2), 1))
    source = frame(("b", day(2), 5), ("c", day(3), 1))
    delta = incremental.delta_lookback(source, made.loaded_to(), "d", 0) \
        .join(made.read().select("k").distinct(), "k", "left").select("k", "d", "v")
    made.replace_keys(delta)
    assert read(rows, made) == [("a", day(1), 1), ("b", day(2), 5), ("c", day(3), 1)]


@pytest.fixture
def long_table(spark, tmp_path, monkeypatch):
    """Twenty days in files of some days each, ids in no order of days, many index files."""
    monkeypatch.setattr(day_table, "INDEX_ROWS", 500)
    monkeypatch.setattr(day_table, "MOST_SMALL_FILES", 1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    made = DayTable(spark, str(tmp_path / "facts"), "d", "k", ("k",))
    made.replace_all(spark.range(0, 20_000, 1, 4).selectExpr(
        "concat('K-', lpad(id * 7919 % 20000, 8, '0')) k",
        "date_add(date'2024-01-01', cast(id / 1000 as int)) d", "cast(id as int) v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return made


def test_files_hold_ranges_of_days(long_table):
    manifest = long_table.manifest()
    assert len(manifest.data) == 8 and sum(f.rows for f in manifest.data) == 20_000
    ends = [(f.first, f.last) for f in manifest.data]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert len(manifest.index) == 40
    spans = [(f.least, f.greatest) for f in manifest.index]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_new_keys_open_no_old_file(spark, long_table, frame):
    """Data files may all be unreadable, and index files outside the delta's hashes too."""
    manifest = long_table.manifest()
    delta = frame(("K-00030000", day(25), 1), ("K-00030001", day(25), 1))
    bits = {r[0] for r in delta.select(day_table._leading(day_table._hash("k"))).collect()}
    near = {f.name for f in manifest.index
            if any(f.least >> day_table.SHIFT <= b <= f.greatest >> day_table.SHIFT for b in bits)}
    assert len(near) <= 4
    for kind, kept in (("data", set()), ("index", near)):
        for name in Path(long_table.path, kind).rglob("*.parquet"):
            if f"{name.parent.name}/{name.name}" not in kept:
                name.write_bytes(b"no parquet at all")
    assert long_table.replace_keys(delta) == Replaced(2, 0)
    assert long_table.read(after="2024-01-20").count() == 2


def test_old_copies_cost_only_the_files_of_their_days(long_table, frame):
    old = long_table.manifest()
    moved = long_table.read().filter("d = date'2024-01-03'").select("k").first()[0]
    replaced = long_table.replace_keys(frame((moved, day(25), -1)))
    assert replaced.rows == 1 and 1 <= replaced.files <= 2
    assert len({f.name for f in old.data} & {f.name for f in long_table.manifest().data}) == 8 - replaced.files
    found = long_table.read()
    assert found.count() == 20_000 and found.filter(F.col("k") == moved).first()["v"] == -1


def test_small_files_are_gathered(table, frame, rows, monkeypatch):
    monkeypatch.setattr(day_table, "MOST_SMALL_FILES", 3)
    made = table(("a", day(1), 1))
    for n in range(2, 9):
        made.replace_keys(frame((f"k{n}", day(n), n)))
        assert len(made.manifest().data) <= 4 and len(made.manifest().index) <= 4
    made.replace_keys(frame(("k3", day(9), 0)))
    assert read(rows, made) == sorted([("a", day(1), 1), ("k3", day(9), 0),
                                       *((f"k{n}", day(n), n) for n in range(2, 9) if n != 3)])


def test_second_writer_is_refused(table, frame, rows, monkeypatch):
    made = table(("a", day(1), 1))
    write = DayTable._small_index

    def slowly(self, *args):
        with monkeypatch.context() as patch:
            patch.setattr(DayTable, "_small_index", write)
            self.replace_keys(frame(("other", day(2), 1)))
        return write(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(DayTable, "_small_index", slowly)
        with pytest.raises(Conflict):
            made.replace_keys(frame(("mine", day(2), 1)))
    assert read(rows, made) == [("a", day(1), 1), ("other", day(2), 1)]


@pytest.mark.parametrize("fails_in", ["_write_data", "_small_index", "_commit"])
def test_cut_off_commit_shows_nothing(table, frame, rows, monkeypatch, fails_in):
    made = table(("a", day(1), 1), ("b", day(2), 1))
    delta = frame(("a", day(5), 2), ("c", day(5), 2))

    def dies(*_args, **_more):
        raise KeyboardInterrupt("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(DayTable, fails_in, dies)
        with pytest.raises(KeyboardInterrupt):
            made.replace_keys(delta)
    assert read(rows, made) == [("a", day(1), 1), ("b", day(2), 1)]
    made.replace_keys(delta)
    assert read(rows, made) == [("a", day(5), 2), ("b", day(2), 1), ("c", day(5), 2)]


def test_readers_keep_their_version_over_a_commit(table, frame, rows):
    made = table(("a", day(1), 1), ("b", day(2), 1))
    before = made.read()
    made.replace_keys(frame(("a", day(3), 2)))
    assert rows(before, "k", "v") == [("a", 1), ("b", 1)]
    assert rows(made.read(), "k", "v") == [("a", 2), ("b", 1)]


def test_old_versions_are_deleted(table, frame, tmp_path):
    made = table(("a", day(1), 1))
    for n in range(6):
        made.replace_all(frame(("a", day(1), n)))
    kept = day_table.KEPT_VERSIONS
    assert len(list((tmp_path / "table" / "_versions").glob("0*"))) == kept
    assert len(list((tmp_path / "table" / "data").iterdir())) == kept
    assert made.changes(1) is None and made.manifest(1) is None


def test_drop_day_and_append(table, frame, rows):
    made = table(("a", day(1), 1), ("b", day(2), 1), ("c", None, 1))
    made.drop_day("2024-01-02")
    assert read(rows, made) == [("a", day(1), 1), ("c", None, 1)]
    made.append(frame(("b", day(2), 5)))
    assert made.replace_keys(frame(("b", day(4), 6))).rows == 1
    assert read(rows, made) == [("a", day(1), 1), ("b", day(4), 6), ("c", None, 1)]


def test_an_unindexed_table_refuses_to_replace_keys(spark, frame, tmp_path):
    made = DayTable(spark, str(tmp_path / "plain"), "d", "k")
    made.replace_all(frame(("a", day(1), 1)))
    assert made.manifest().index == ()
    with pytest.raises(ValueError, match="no index"):
        made.replace_keys(frame(("a", day(2), 1)))


def test_changes_are_rows_that_differ(table, frame, rows, monkeypatch):
    made = table(("a", day(1), 1), ("b", day(2), 1), ("c", None, 1))
    made.replace_keys(frame(("a", day(1), 1), ("b", day(3), 2)))
    assert rows(made.changes(1), "k", "d", "v", "change") == [
        ("b", day(2), 1, -1), ("b", day(3), 2, 1)]
    monkeypatch.setattr(day_table, "MOST_SMALL_FILES", 0)
    made.replace_keys(frame(("b", day(3), 2)))
    assert made.changes(2).count() == 0


def test_rows_are_looked_up_and_left_out(long_table, spark, rows):
    wanted = long_table.read().filter("v IN (5, 7000, 19999)").select("k")
    assert rows(long_table.rows_with("k", wanted), "v") == [(19999,), (5,), (7000,)]
    nothing = long_table.read().limit(0)
    assert long_table.replace_keys(nothing, wanted).rows == 0
    assert long_table.read().count() == 19_997
    assert long_table.rows_with("k", wanted).count() == 0
    with pytest.raises(ValueError, match="no index"):
        long_table.rows_with("v", wanted)


def test_many_looked_up_keys_do_not_go_to_the_driver(spark, table, rows, monkeypatch):
    """Of 600,000 keys, 37 MB as rows, a broadcast's table takes twice its budget and more."""
    made = table(("K-0000000007", day(1), 1), ("K-0000900000", day(1), 1), (None, day(2), 1))
    many = spark.range(0, 600_000, 1, 8).selectExpr("concat('K-', lpad(string(id), 10, '0')) k")
    seen = []

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    def noted(frame, name, store=day_table.stored):
        seen.append((name, plan(frame)))
        return store(frame, name)

    found = made.rows_with("k", many)
    assert "Broadcast" not in plan(found) and rows(found, "k", "v") == [("K-0000000007", 1)]
    monkeypatch.setattr(day_table, "stored", noted)
    made.replace_keys(made.read().limit(0), many)
    assert [name for name, _ in seen] == ["left"] and "Broadcast" not in seen[0][1]
    assert read(rows, made) == [(None, day(2), 1), ("K-0000900000", day(1), 1)]


def test_days_are_replaced(table, frame, rows):
    made = table(("a", day(1), 1), ("b", day(2), 1), ("c", None, 1))
    made.replace_days(frame(("x", day(2), 2), ("y", None, 2)), {"2024-01-02", None})
    assert read(rows, made) == [("a", day(1), 1), ("x", day(2), 2), ("y", None, 2)]
    assert rows(made.read_days({None}), "k") == [("y",)]
