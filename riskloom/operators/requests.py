"""Quote requests as a table: known or new customer, defaults, input sanitising, response parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from riskloom import fixed_values as fv
from riskloom.functions.numeric import safe_float, safe_int, text_or
from riskloom.functions.rating import history_defaults


def resolve_requests(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Every request with its feature columns and ``customer_type``.

    ``features`` holds one row per ``customer_id``. A match takes all its feature values (also the
    NULL ones) over the request's own; no match, a NULL or an empty id gives the new-customer
    defaults. Requests without an id get distinct never-matching join keys, so that they spread
    over all tasks instead of meeting in the one for NULL.
    """
    stored = [c for c in features.columns if c not in ("customer_id", "updated_at")]
    known = features.select(
        F.col("customer_id").alias("_key"), F.struct(*stored).alias("_stored"))
    nobody = F.concat(F.lit("\u0000"), F.xxhash64(*requests.columns).cast("string"))
    key = F.coalesce(F.nullif("customer_id", F.lit("")), nobody)
    joined = requests.withColumn("_key", key).join(known, "_key", "left")

    match = F.col("_stored").isNotNull()
    new = history_defaults("age", "years_licensed", "car_age", "kilometers", "estimated_car_value")

    def resolved(name: str) -> Column:
        own = new[name] if name in new else F.col(name)
        return F.when(match, F.col("_stored")[name]).otherwise(own)

    own_cols = [c for c in requests.columns if c not in stored]
    return joined.select(
        *own_cols,
        *[resolved(c).alias(c) for c in stored],
        F.when(match, "existing").otherwise("new").alias("customer_type"))


def sanitized_inputs(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The model columns with every missing or unreadable value replaced, absent columns included."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def number(name: str, default, whole: bool) -> Column:
        """The column's value or the default, by the least work its type needs."""
        kind = types.get(name)
        if kind is None:
            return default if isinstance(default, Column) else F.lit(default).cast("bigint" if whole else "double")
        if isinstance(kind, IntegralType):
            return F.coalesce(F.col(name).cast("bigint" if whole else "double"), default if isinstance(default, Column) else F.lit(default))
        if whole:
            return safe_int(name, default)
        return safe_float(name, default, isinstance(kind, StringType))

    def clean(name: str) -> Column:
        default = fv.REQUEST_DEFAULTS[name]
        if isinstance(default, str):
            return text_or(name, default) if name in types else F.lit(default)
        whole = isinstance(default, int)
        if name in fv.REQUEST_FALLBACKS:
            other = fv.REQUEST_FALLBACKS[name]
            default = number(other, fv.REQUEST_DEFAULTS[other], whole)
        return number(name, default, whole)

    return df.select(*keep, *[clean(c).alias(c) for c in fv.MODEL_INPUT_COLS])


def prediction_of(payload: Column | str, name: str = "PREDICTED_PREMIUM") -> Column:
    """The prediction in a JSON response, whose first data row may be [id, {name: x}], [id, x],
    {name: x} or [x]. NULL when none fits."""
    payload = F.col(payload) if isinstance(payload, str) else payload

    def at(path: str) -> Column:
        return F.get_json_object(payload, path)

    size = F.json_array_length(at("$.data[0]"))
    found = (
        F.when(size > 1, F.coalesce(at(f"$.data[0][1].{name}"), at("$.data[0][1]")))
        .when(size == 1, at("$.data[0][0]"))
        .when(size.isNull(), at(f"$.data[0].{name}"))
    )
    return found.try_cast("double")


def parsed_responses(df: DataFrame, payload: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their prediction, rows whose payload has no readable prediction)."""
    parsed = df.withColumn(fv.PREDICTION_COL, prediction_of(payload))
    readable = F.col(fv.PREDICTION_COL).isNotNull()
    return parsed.filter(readable), parsed.filter(~readable).drop(fv.PREDICTION_COL)


def lookup_rows(df: DataFrame, key: str, value) -> DataFrame:
    """The first row of a key, or none."""
    return df.filter(F.col(key) == value).limit(1)


def known_only(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key), key, "left_semi")


def unknown_only(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key), key, "left_anti")
