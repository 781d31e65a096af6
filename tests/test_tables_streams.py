"""Tables, snapshots, datasets, incremental and continuous processing."""

from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.catalog.operations import event_log
from riskloom.operators.latest import latest_per_key
from riskloom.operators.prep import fit_encoder, fit_scaler, encode
from riskloom import fixed_values as fv
from riskloom.sources import serving_log, tables
from riskloom.sources.scratch import new_folder, shared_folder
from riskloom.streaming import increment, live

T0 = datetime(2024, 1, 1)


def test_append_by_name_with_defaults(spark):
    path = f"{new_folder(spark, 'append')}"
    tables.ensure_table(spark, path, schemas.ALERTS)
    tables.ensure_table(spark, path, schemas.ALERTS)
    assert tables.insert_row(spark, path, schemas.ALERTS, message="m", alert_type="t") == 1
    rows = spark.createDataFrame([("u", "x")], "message string, alert_type string")
    tables.append(rows, path, schemas.ALERTS, {"alert_time": F.lit("2024-01-01 00:00:00")})
    got = sorted((r.message, r.alert_type, r.alert_time) for r in spark.read.parquet(path).collect())
    assert got == [("m", "t", None), ("u", "x", T0)]
    with pytest.raises(ValueError, match="not columns"):
        tables.append(rows.withColumn("zzz", F.lit(1)), path, schemas.ALERTS)


def test_overwrite_counts_rows_and_tables(spark):
    path = new_folder(spark, "overwrite")
    assert tables.overwrite(spark.range(7), path) == 7
    assert tables.overwrite(spark.range(3), path) == 3
    assert tables.read_table(spark, path).count() == 3
    assert tables.overwrite(spark.range(4), "overwritten_numbers") == 4
    assert tables.read_table(spark, "overwritten_numbers").count() == 4
    assert tables.read_sql(spark, "SELECT * FROM overwritten_numbers WHERE id >= :low", low=2).count() == 2


def test_merge_and_update(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(2, "x"), (3, "c")], "id int, v string")
    assert sorted(map(tuple, tables.insert_absent(target, source, ["id"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    updates = spark.createDataFrame([(2, None), (9, "q")], "id int, v string")
    assert sorted(map(tuple, tables.keyed_update(target, updates, ["id"]).collect())) == [(1, "a"), (2, None)]


def test_state_table_snapshots(spark):
    path = new_folder(spark, "state")
    state = tables.StateTable(spark, path, schemas.WATERMARK)
    assert state.read().count() == 0
    state.replace(spark.createDataFrame([("k", T0)], schemas.WATERMARK))
    # A snapshot that was written but never committed stays invisible and is replaced by the next commit.
    spark.createDataFrame([("half", T0)], schemas.WATERMARK).write.parquet(f"{path}/snapshot=2")
    assert [r.watermark_key for r in state.read().collect()] == ["k"]
    state.replace(state.read().withColumn("watermark_key", F.lit("k2")))
    assert [r.watermark_key for r in state.read().collect()] == ["k2"] and state.current() == 2


def test_datasets_are_immutable(spark):
    root = new_folder(spark, "datasets")
    info = tables.write_dataset(spark.range(5), root, "d", "v1")
    assert info["row_count"] == 5 and tables.read_dataset(spark, root, "d", "v1").count() == 5
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_dataset(spark.range(5), root, "d", "v1")


def test_shared_folder_rules():
    def session(configured, master):
        conf = SimpleNamespace(get=lambda key, default=None: configured)
        context = SimpleNamespace(getConf=lambda: conf, master=master, applicationId="app-1")
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_folder(session("hdfs:///shared", "yarn")) == "hdfs:///shared"
    assert shared_folder(session(None, "local[2]")) == shared_folder(session(None, "local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(None, "yarn"))


LOG = "timestamp timestamp_ntz, function_name string, id int"


def to_rows(part):
    return part.select(F.col("timestamp").alias("inference_timestamp"), "id")


def test_increments(spark):
    folder = new_folder(spark, "inc")
    marks = increment.Watermarks(spark, f"{folder}/marks")
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [(at(1), "predict", 1), (at(2), "PREDICT", 2), (at(3), "transform", 3)]
    run = lambda: increment.process_increment(spark.createDataFrame(rows, LOG), marks, f"{folder}/out", to_rows)
    ids = lambda: sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect())

    empty = increment.process_increment(spark.createDataFrame([], LOG), marks, f"{folder}/out", to_rows)
    assert empty.message == fv.NOTHING_NEW_MESSAGE and marks.mark() == datetime(1970, 1, 1)

    first = run()
    assert (first.rows, first.mark) == (2, at(2)) and "Processed 2 rows" in first.message and ids() == [1, 2]
    assert run().rows == 0 and ids() == [1, 2]

    rows += [(at(2), "predict", 4), (at(1), "predict", 5), (at(9), "predict", 6)]
    assert run().rows == 1 and ids() == [1, 2, 6] and marks.mark() == at(9)
    late = increment.late_rows(spark.createDataFrame(rows, LOG), spark.read.parquet(f"{folder}/out"), marks.mark())
    assert late.first()[0] == 2


def test_increment_survives_a_crash_before_the_mark_moves(spark, monkeypatch):
    folder = new_folder(spark, "crash")
    marks = increment.Watermarks(spark, f"{folder}/marks")
    log = spark.createDataFrame([(T0, "predict", 1)], LOG)
    monkeypatch.setattr(marks, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        increment.process_increment(log, marks, f"{folder}/out", to_rows)
    monkeypatch.undo()
    assert increment.process_increment(log, marks, f"{folder}/out", to_rows).rows == 1
    assert spark.read.parquet(f"{folder}/out").count() == 1


def test_log_to_transformation_results(spark):
    """Capture -> day folders -> increment -> typed result table with inputs and features."""
    folder = new_folder(spark, "log")
    row = {c: (3 if schemas.input_type(c).typeName() == "long" else 1.5 if schemas.input_type(c).typeName() == "double" else "Ford")
           for c in fv.MODEL_INPUT_COLS} | {"predicted_premium": 700.25}
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.MODEL_INPUT)
    scored = spark.createDataFrame([row, {**row, "car_make": "BMW", "age": 5}], f"{columns}, predicted_premium double")
    serving_log.append_log(serving_log.capture(scored, at="2024-01-02 10:00:00", prefix="svc"), f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log")
    assert "log_date" in log.columns
    encoder = fit_encoder(scored)
    scaler = fit_scaler(encode(scored, encoder), fv.MODEL_FEATURE_COLS)
    results = lambda part: increment.transformation_rows(part, encoder, scaler, prefix="svc", at="2024-01-02 11:00:00")
    marks = increment.Watermarks(spark, f"{folder}/marks")
    assert increment.process_increment(log, marks, f"{folder}/out", results, prefix="svc").rows == 2
    out = spark.read.parquet(f"{folder}/out").drop("after", "mark")
    assert out.columns == schemas.TRANSFORMATION_RESULTS.names and [f.dataType for f in out.schema] == [f.dataType for f in schemas.TRANSFORMATION_RESULTS]
    got = {r.car_make_input: r for r in out.collect()}
    assert (got["BMW"].age_input, got["BMW"].predicted_premium, got["BMW"].car_make_encoded, got["Ford"].car_make_encoded) == (5, 700.25, -1.0, 1.0)


def test_time_filter_reaches_the_scan(spark, sf):
    log = spark.read.parquet(f"{sf}/events.parquet").withColumnRenamed("ts", "timestamp").withColumnRenamed("event_type", "function_name")
    plan = increment.interval(log, "2024-01-02 00:00:00", "2024-01-03 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def write_parts(spark, sf, folder):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(folder)
    return events


def test_stream_over_several_batches_is_lossless_and_repeatable(spark, sf):
    folder = new_folder(spark, "many")
    events = write_parts(spark, sf, f"{folder}/in")

    def run():
        q = increment.start_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/cp", lambda b: b.select("event_id"),
                                   schema=events.schema, files_per_batch=1, condition=lambda log: F.col("event_type") == "click")
        q.awaitTermination()
        return q

    query = run()
    assert increment.progress_of(query)["batch_id"] >= 2
    want = sorted(r.event_id for r in events.filter("event_type = 'click'").collect())
    run()
    assert sorted(r.event_id for r in spark.read.parquet(f"{folder}/out").collect()) == want


def test_latest_table_over_batches_and_compaction(spark, sf):
    folder = new_folder(spark, "latest")
    events = write_parts(spark, sf, f"{folder}/in").drop("props")
    how = {"keys": ["user_id"], "ts": "ts", "tiebreak": ("event_id",)}
    want = sorted(map(tuple, latest_per_key(events, **how).collect()))
    stream = live.file_stream(spark, f"{folder}/in", spark.read.parquet(f"{sf}/events.parquet").schema, files_per_batch=1).drop("props")
    live.keep_latest(stream, f"{folder}/t", f"{folder}/cp", **how).awaitTermination()
    read = lambda: sorted(map(tuple, live.latest_table(spark, f"{folder}/t", **how).select(*events.columns).collect()))
    assert read() == want
    assert live.compact_latest(spark, f"{folder}/t", **how) == 2
    assert read() == want


def test_event_log_columns(spark, sf):
    assert event_log(spark, sf).columns == ["timestamp", "function_name", "resource_attributes", "record_attributes"]


def test_two_marks_keep_their_results_apart(spark):
    folder = new_folder(spark, "marks")
    marks = increment.Watermarks(spark, f"{folder}/marks")
    log = spark.createDataFrame([(T0, "predict", 1)], LOG)
    for key in ("first", "second/one"):
        increment.process_increment(log, marks, f"{folder}/out", to_rows, key=key)
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_state_table_stays_small(spark):
    path = new_folder(spark, "state")
    state = tables.StateTable(spark, path, schemas.WATERMARK)
    rows = lambda i: spark.createDataFrame([("k", datetime(2024, 1, 1 + i % 28))], schemas.WATERMARK)
    for i in range(tables.COMPACT_EVERY + 3):
        state.replace(rows(i))
    assert state.read().collect() == rows(i).collect()
    assert len(spark.read.parquet(f"{path}/commits").inputFiles()) <= 4
    assert not tables.exists(spark, f"{path}/snapshot=1") and tables.exists(spark, f"{path}/snapshot={tables.COMPACT_EVERY - 1}")
