"""The append-only log of scored requests: capture, storage and extraction.

Request and response sit in two JSON columns with flat keys that contain dots
('<prefix>.model_serving.request.data.AGE'). The function name and the date are kept as real
columns too, so that Parquet can skip files and row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom import fixed_values as fv
from riskloom.functions.times import clock
from riskloom.schemas import input_type

DEFAULT_PREFIX = "app"


class LogKeys:
    """Attribute names of a log; the prefix depends on the service that wrote it."""

    def __init__(self, prefix: str = DEFAULT_PREFIX):
        self.query_id = f"{prefix}.query.id"
        self.service_name = f"{prefix}.service.name"
        self.function_name = f"{prefix}.model_serving.function.name"
        self.request_time = f"{prefix}.model_serving.request.timestamp"
        self.response_time = f"{prefix}.model_serving.response.timestamp"
        self.prediction = f"{prefix}.model_serving.response.data.PREDICTED_PREMIUM"
        self._request_data = f"{prefix}.model_serving.request.data."

    def request(self, column: str) -> str:
        return self._request_data + column.upper()

    def resource_schema(self) -> StructType:
        return _texts([self.query_id, self.service_name])

    def record_schema(self, inputs: list[str]) -> StructType:
        return _texts([
            self.function_name, self.request_time, self.response_time, self.prediction,
            *[self.request(c) for c in inputs]])


def _texts(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def json_attribute(column: Column | str, key: str) -> Column:
    """Text of a flat key that may contain dots; NULL when absent or JSON null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.get_json_object(column, f"$['{key}']")


def object_of(**values: Column) -> Column:
    """A JSON object of the given values; NULL ones are left out."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))


def capture(
    scored: DataFrame, *, function_name: str = "predict", service_name: str = "pricing", prefix: str = DEFAULT_PREFIX,
    query_id: Column | None = None, at=None, request_time: Column | None = None, response_time: Column | None = None,
) -> DataFrame:
    """Scored rows (model columns and prediction) as log records."""
    keys = LogKeys(prefix)
    ts = clock(at)
    resource = {keys.query_id: F.expr("uuid()") if query_id is None else query_id, keys.service_name: F.lit(service_name)}
    record = {
        keys.function_name: F.lit(function_name),
        keys.request_time: (ts if request_time is None else request_time).cast("string"),
        keys.response_time: (ts if response_time is None else response_time).cast("string"),
        **{keys.request(c): F.col(c) for c in fv.MODEL_INPUT_COLS if c in scored.columns},
        keys.prediction: F.col(fv.PREDICTION_COL),
    }
    return scored.select(
        ts.alias("timestamp"), F.lit(function_name).alias("function_name"),
        object_of(**resource).alias("resource_attributes"), object_of(**record).alias("record_attributes"))


def append_log(records: DataFrame, path: str) -> None:
    """Append records, one folder per day."""
    records.withColumn("log_date", F.to_date("timestamp")).write.mode("append").partitionBy("log_date").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log as a table; filters on ``log_date``, ``timestamp`` and ``function_name`` skip files."""
    return spark.read.parquet(path)


def as_number(text: Column, name: str) -> Column:
    """A request attribute in its column's type; whole numbers round half up."""
    kind = input_type(name)
    if kind.typeName() == "long":
        return text.try_cast("decimal(38,0)").try_cast("bigint")
    return text if kind.typeName() == "string" else text.try_cast("double")


def extract(log: DataFrame, prefix: str = DEFAULT_PREFIX, inputs: list[str] = fv.MODEL_INPUT_COLS) -> DataFrame:
    """Typed columns of the log: timestamp, ids, names, times, the wanted inputs, the prediction.

    Each JSON column is parsed once per row: as the input of ``inline`` the parse is neither copied
    into the filters and projections that use its fields nor split into one parse per field.
    """
    keys = LogKeys(prefix)
    with_resource = log.select(
        "timestamp", "record_attributes", F.inline(F.array(F.from_json("resource_attributes", keys.resource_schema()))))
    parsed = with_resource.select(
        "timestamp", *[f"`{n}`" for n in keys.resource_schema().names],
        F.inline(F.array(F.from_json("record_attributes", keys.record_schema(inputs)))))

    def text(name: str) -> Column:
        return F.col(f"`{name}`")

    return parsed.select(
        "timestamp",
        text(keys.query_id).alias("query_id"), text(keys.service_name).alias("service_name"),
        text(keys.function_name).alias("function_name"),
        text(keys.request_time).try_cast("timestamp_ntz").alias("request_timestamp"),
        text(keys.response_time).try_cast("timestamp_ntz").alias("response_timestamp"),
        *[as_number(text(keys.request(c)), c).alias(c) for c in inputs],
        text(keys.prediction).try_cast("double").alias(fv.PREDICTION_COL))
