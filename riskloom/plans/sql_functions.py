"""The fitted preparation and the serving log as functions of SQL text.

``SELECT query_id, transform(car_age, ...).age FROM log(TIMESTAMP_NTZ'...', TIMESTAMP_NTZ'...', 'predict')``
is planned like any other query: the functions are SQL expressions and relations that Spark puts in
place of the call, no Python runs per row, and the time limits reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom import fixed_values as fv
from riskloom.operators.prep import Encoder, Scaler
from riskloom.schemas import MODEL_INPUT
from riskloom.sources.serving_log import DEFAULT_PREFIX, extract

#: Classes a function may hold: they are one value of the session. More of them are encoded by joins (`prep.encode`).
MOST_CLASSES = 100_000


def text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_transform(spark: SparkSession, encoder: Encoder, scaler: Scaler, name: str = "transform") -> str:
    """A temporary function of the 22 model inputs that returns their scaled features as a struct. Unknown classes get code 0.

    Registering again under the same name replaces it."""
    if encoder.classes.count() > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes: encode them by a join")
    holder, view = f"{name}_classes", f"{name}_class_table"
    encoder.classes.createOrReplaceTempView(view)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {holder} MAP<STRING, INT>")
    spark.sql(f"""SET VAR {holder} = (SELECT map_from_entries(collect_list(struct(concat(`column`, '=', value), code))) FROM {view})""")
    spark.catalog.dropTempView(view)

    def value(feature: str) -> str:
        mean, std = scaler.stats[feature]
        source = feature.removesuffix("_encoded")
        raw = f"{name}.{source}"
        if feature != source:
            raw = f"coalesce(try_element_at({holder}, concat('{source}=', coalesce(CAST({raw} AS STRING), {text(fv.MISSING_CLASS)}))), 0)"
        return f"(CAST({raw} AS DOUBLE) - CAST({mean!r} AS DOUBLE)) / CAST({(std if std > 0 else 1.0)!r} AS DOUBLE)"

    features = [c for c in fv.MODEL_FEATURE_COLS if c in scaler.stats]
    inputs = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MODEL_INPUT)
    fields = ", ".join(f"'{c}', {value(c)}" for c in features)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({inputs})
RETURNS STRUCT<{", ".join(f"{c}: DOUBLE" for c in features)}> RETURN named_struct({fields})""")
    return name


def register_log(spark: SparkSession, log: DataFrame, name: str = "log_rows", prefix: str = DEFAULT_PREFIX) -> str:
    """A temporary table function of (since, until, called): the typed log rows of a function in the times (since, until]."""
    view = f"{name}_source"
    rows = extract(log, prefix)
    rows.createOrReplaceTempView(view)
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(since TIMESTAMP_NTZ, until TIMESTAMP_NTZ, called STRING)
RETURNS TABLE({kinds}) RETURN SELECT {columns} FROM {view}
WHERE `timestamp` > {name}.since AND `timestamp` <= {name}.until AND lower(function_name) = lower({name}.called)""")
    return name
