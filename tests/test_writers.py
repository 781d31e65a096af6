"""Several writers at once: state tables, marks, appends, datasets; and writes that die."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.sources import publish, tables
from riskloom.sources.scratch import new_folder
from riskloom.streaming import increment

T0 = datetime(2024, 1, 1)
SCHEMA = schemas.WATERMARK
LOG = "timestamp timestamp_ntz, function_name string, id int"


def row(spark, key):
    return spark.createDataFrame([(key, T0)], SCHEMA)


def keys(state):
    return sorted(r.watermark_key for r in state.read().collect())


def test_a_writer_between_read_and_commit_is_not_lost(spark):
    path = new_folder(spark, "state")
    first, second = tables.StateTable(spark, path, SCHEMA), tables.StateTable(spark, path, SCHEMA)
    calls = []

    def slow(now):
        if not calls:
            second.update(lambda other: other.unionByName(row(spark, "second")))
        calls.append(1)
        return now.unionByName(row(spark, "first"))

    first.update(slow)
    assert keys(first) == ["first", "second"] and len(calls) == 2 and first.current() == 2
    assert publish.names(spark, f"{path}/snapshot=2") and len(publish.names(spark, f"{path}/snapshot=1")) == 1  # the lost try left nothing


def test_many_writers_at_once(spark):
    path = new_folder(spark, "state")
    tables.StateTable(spark, path, SCHEMA)
    add = lambda i: tables.StateTable(spark, path, SCHEMA).update(lambda now: now.unionByName(row(spark, f"w{i}")), tries=50)
    with ThreadPoolExecutor(6) as pool:
        numbers = sorted(pool.map(add, range(6)))
    assert numbers == [1, 2, 3, 4, 5, 6] and keys(tables.StateTable(spark, path, SCHEMA)) == [f"w{i}" for i in range(6)]


def test_a_writer_from_before_the_last_folding_is_refused(spark, monkeypatch):
    monkeypatch.setattr(tables, "COMPACT_EVERY", 4)
    state = tables.StateTable(spark, new_folder(spark, "state"), SCHEMA)
    for i in range(6):
        state.replace(row(spark, f"r{i}"))
    with pytest.raises(tables.Conflict):
        state.commit(row(spark, "late"), base=1)  # number 2 is free again
    assert keys(state) == ["r5"] and state.current() == 6


def test_two_jobs_at_one_mark(spark):
    folder = new_folder(spark, "jobs")
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [(at(1), "predict", 1), (at(2), "predict", 2)]
    marks, others = increment.Watermarks(spark, f"{folder}/marks"), increment.Watermarks(spark, f"{folder}/marks")
    plain = lambda part: part.select(F.col("timestamp").alias("inference_timestamp"), "id")
    log = spark.createDataFrame(rows, LOG)
    more = spark.createDataFrame([*rows, (at(3), "predict", 3)], LOG)

    def interrupted(part):
        # The other job sees a later log, but the interval's end was said first.
        assert increment.process_increment(more, others, f"{folder}/out", plain).mark == at(2)
        return plain(part)

    assert increment.process_increment(log, marks, f"{folder}/out", interrupted).rows == 2
    ids = lambda: sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect())
    assert ids() == [1, 2] and marks.mark() == at(2)
    assert increment.process_increment(more, marks, f"{folder}/out", plain).rows == 1
    assert ids() == [1, 2, 3] and marks.mark() == at(3)
    assert marks.advance(at(9), increment.fv.WATERMARK_KEY, at(2)) is False and marks.mark() == at(3)


def test_appends_at_the_same_time(spark):
    path = new_folder(spark, "alerts")
    tables.ensure_table(spark, path, schemas.ALERTS)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: tables.insert_row(spark, path, schemas.ALERTS, message=f"m{i}"), range(12)))
    assert sorted(r.message for r in spark.read.parquet(path).collect()) == sorted(f"m{i}" for i in range(12))


def test_a_killed_dataset_write_is_invisible(spark, monkeypatch):
    root = new_folder(spark, "datasets")
    monkeypatch.setattr(tables, "publish_text", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.write_dataset(spark.range(5), root, "d", "v1")
    monkeypatch.undo()
    assert tables.list_datasets(spark, root).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_dataset(spark, root, "d", "v1")
    assert tables.write_dataset(spark.range(7), root, "d", "v1")["row_count"] == 7
    assert tables.read_dataset(spark, root, "d", "v1").count() == 7
    assert [tuple(r) for r in tables.list_datasets(spark, root).collect()] == [("d", "v1", 7)]


def test_one_version_has_one_writer(spark):
    root = new_folder(spark, "datasets")

    def write(i):
        try:
            return tables.write_dataset(spark.range(i + 1), root, "a/b", "v=1")["row_count"]
        except FileExistsError:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = [n for n in pool.map(write, range(4)) if n is not None]
    assert len(done) == 1 and tables.read_dataset(spark, root, "a/b", "v=1").count() == done[0]
    assert [tuple(r) for r in tables.list_datasets(spark, root).collect()] == [("a/b", "v=1", done[0])]


def test_dataset_files_are_checked_against_the_manifest(spark):
    root = new_folder(spark, "datasets")
    path = tables.write_dataset(spark.range(5).repartition(2), root, "d", "v1")["path"]
    assert tables.dataset_problems(spark, root, "d", "v1") == []
    lost = next(iter(publish.sizes(spark, path)))
    publish.remove(spark, f"{path}/{lost}")
    assert len(tables.dataset_problems(spark, root, "d", "v1")) == 1


def test_the_file_systems_own_rename_gives_way_to_nobody(spark):
    folder = new_folder(spark, "rename")
    for name in ("a", "b"):
        spark.range(1).coalesce(1).write.parquet(f"{folder}/{name}")
    assert publish._renamed(spark, f"{folder}/a", f"{folder}/c") and not publish._renamed(spark, f"{folder}/b", f"{folder}/c")
    assert publish.names(spark, folder) == ["b", "c"]
