"""The preparation and the log as functions of SQL text, and progress rows of streams."""

from datetime import datetime

from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom import schemas
from riskloom.operators import prep
from riskloom.plans import sql_functions
from riskloom.sources import serving_log
from riskloom.sources.scratch import new_folder
from riskloom.streaming import increment, progress


def inputs(spark):
    kinds = {"long": 3, "double": 1.5, "string": "Ford"}
    row = {c: kinds[schemas.input_type(c).typeName()] for c in fv.MODEL_INPUT_COLS}
    rows = [row, {**row, "car_make": "O'Neil \\ Co", "age": 50}, {**row, "car_make": None, "credit_score": None}]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.MODEL_INPUT)
    return spark.createDataFrame(rows, columns)


def test_transform_in_sql_text_equals_the_frames(spark):
    df = inputs(spark)
    encoder = prep.fit_encoder(df)
    scaler = prep.fit_scaler(prep.encode(df, encoder), fv.MODEL_FEATURE_COLS)
    name = sql_functions.register_transform(spark, encoder, scaler, "t_transform")
    other = df.unionByName(df.limit(1).withColumn("car_make", F.lit("never seen")))
    other.createOrReplaceTempView("t_inputs")
    out = spark.sql(f"SELECT t.* FROM (SELECT {name}({', '.join(fv.MODEL_INPUT_COLS)}) AS t FROM t_inputs)")
    assert out.columns == fv.MODEL_FEATURE_COLS and "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, out.collect())) == sorted(map(str, prep.transform(other, encoder, scaler).collect()))
    # Registered again with other classes, the name means the new ones.
    fewer = prep.fit_encoder(df.filter("car_make = 'Ford'"))
    sql_functions.register_transform(spark, fewer, scaler, "t_transform")
    got = spark.sql(f"SELECT t.car_make_encoded AS e FROM (SELECT {name}({', '.join(fv.MODEL_INPUT_COLS)}) AS t FROM t_inputs)")
    assert len({r.e for r in got.collect()}) == 1


def test_log_rows_in_sql_text(spark):
    df = inputs(spark).withColumn("predicted_premium", F.lit(700.5))
    log = serving_log.capture(df, at="2024-01-02 10:00:00", function_name="Predict").unionByName(
        serving_log.capture(df, at="2024-01-03 10:00:00", function_name="Predict")).unionByName(serving_log.capture(df, at="2024-01-03 10:00:00", function_name="other"))
    path = f"{new_folder(spark, 'log')}/log"
    serving_log.append_log(log, path)
    sql_functions.register_log(spark, spark.read.parquet(path), "t_log")
    call = "t_log(TIMESTAMP_NTZ'2024-01-02 10:00:00', TIMESTAMP_NTZ'2024-01-03 10:00:00', 'predict')"
    rows = spark.sql(f"SELECT timestamp, predicted_premium, age FROM {call}")
    assert sorted(tuple(r) for r in rows.collect()) == [(datetime(2024, 1, 3, 10), 700.5, age) for age in (3, 3, 50)]
    assert "GreaterThan(timestamp" in rows._jdf.queryExecution().executedPlan().toString()


def test_progress_rows_of_a_stream(spark, sf):
    folder = new_folder(spark, "progress")
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(f"{folder}/in")
    listener = progress.ProgressRows(spark, f"{folder}/rows")
    spark.streams.addListener(listener)
    try:
        query = increment.start_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/cp", lambda b: b.select("event_id"),
                                       schema=events.schema, files_per_batch=1, condition=lambda log: F.lit(True))
        query.awaitTermination()
        assert listener.wait(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    mine = progress.history(spark, f"{folder}/rows").filter(F.col("query_id") == str(query.id)).collect()
    assert [(r.batches, r.input_rows) for r in mine] == [(3, events.count())]
