"""Table schemas and the model's input and output contract."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, LongType, MapType, StringType, StructField, StructType, TimestampNTZType,
)

from riskloom import fixed_values as fv


def _fields(**types) -> StructType:
    return StructType([StructField(name, t) for name, t in types.items()])


S, L, D, TS = StringType(), LongType(), DoubleType(), TimestampNTZType()

CUSTOMERS = _fields(
    customer_id=S, first_name=S, last_name=S, age=L, gender=S, years_licensed=L,
    claims_history=L, credit_score=L, state=S)

POLICIES = _fields(
    policy_id=S, customer_id=S, car_make=S, car_model=S, car_year=L, color=S, kilometers=L,
    engine_size=D, fuel_type=S, transmission=S, coverage_type=S, deductible=L,
    estimated_car_value=D, annual_premium=D, policy_start_date=S, updated_at=S)


def input_type(name: str):
    if name in fv.CATEGORICAL_COLS:
        return S
    return L if name in fv.INTEGER_INPUT_COLS else D


MODEL_INPUT = StructType([StructField(c, input_type(c)) for c in fv.MODEL_INPUT_COLS])
MODEL_OUTPUT = _fields(predicted_premium=D)

TRANSFORMATION_RESULTS = StructType(
    [StructField("inference_timestamp", TS), StructField("query_id", S), StructField("service_name", S),
     StructField("function_name", S), StructField("transform_timestamp", TS)]
    + [StructField(f"{c}_input", input_type(c)) for c in fv.MODEL_INPUT_COLS]
    + [StructField(fv.PREDICTION_COL, D)]
    + [StructField(f"{c}_transformed", D) for c in fv.NUMERIC_COLS]
    + [StructField(c, D) for c in fv.ENCODED_COLS])

INFERENCE_LOG = _fields(timestamp=TS, function_name=S, resource_attributes=S, record_attributes=S)
WATERMARK = _fields(watermark_key=S, last_processed=TS)
ALERTS = _fields(alert_time=TS, alert_type=S, message=S)
RUNS = _fields(name=S, state=S, scheduled_time=TS, completed_time=TS, error_message=S)
MODEL_EVENTS = _fields(
    model=S, version=S, event=S, metrics=MapType(S, D), artifact_path=S, comment=S, event_ts=TS)

REQUESTS = _fields(
    request_id=L, customer_id=S, car_age=L, kilometers=L, engine_size=D, estimated_car_value=D,
    age=L, years_licensed=L, car_make=S, car_model=S, fuel_type=S, transmission=S,
    coverage_type=S, gender=S, state=S)


def infer_contract(sample: DataFrame, rename: dict[str, str] | None = None) -> str:
    """The schema of a frame as JSON, with columns renamed (say, the label to the prediction)."""
    renamed = sample.withColumnsRenamed(rename or {})
    return renamed.schema.json()


def contract_problems(df: DataFrame, contract: StructType | str) -> list[str]:
    """What keeps a frame from meeting a contract: missing columns and other types."""
    wanted = StructType.fromJson(json.loads(contract)) if isinstance(contract, str) else contract
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in wanted.fields:
        if field.name not in have:
            problems.append(f"missing column {field.name}")
        elif have[field.name] != field.dataType:
            problems.append(f"{field.name} is {have[field.name].simpleString()}, not {field.dataType.simpleString()}")
    return problems


def conform(df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the schema's columns, in order, cast to their types; a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
