"""Feature preparation as tables: label codes, standard scaling, the 22-column model transform."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import fixed_values as fv
from riskloom.functions.draws import in_test_split
from riskloom.operators.ordered import dense_codes
from riskloom.sources.scratch import written


@dataclass(frozen=True)
class Encoder:
    """Codes of text classes: a table (column, value, code)."""

    columns: tuple[str, ...]
    classes: DataFrame

    @staticmethod
    def of(columns: list[str], classes: DataFrame) -> Encoder:
        """Keeps the classes in the shared folder, so that every use reads the same finished table."""
        return Encoder(tuple(columns), written(classes, "classes"))


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation per column."""

    stats: dict[str, tuple[float, float]]

    @property
    def columns(self) -> list[str]:
        return list(self.stats)


def class_text(c: str) -> Column:
    """Text of a value; a missing one is a class of its own."""
    return F.coalesce(F.col(c).cast("string"), F.lit(fv.MISSING_CLASS))


def class_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code): distinct texts of each column, coded 0.. in sorted order."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), class_text(c).alias("value")) for c in columns])
    return dense_codes(df.select(F.inline(pairs)).distinct(), ["column"], "value")


def fit_encoder(df: DataFrame, columns: list[str] = fv.CATEGORICAL_COLS) -> Encoder:
    return Encoder.of(list(columns), class_codes(df, list(columns)))


def encode(df: DataFrame, encoder: Encoder, flag_unknown: bool = False) -> DataFrame:
    """Adds ``<col>_encoded`` for the encoder's columns that ``df`` has. Unknown values get 0;
    ``flag_unknown`` adds ``<col>_unknown`` to tell them from the first class.

    Classes are joined per column, without a hint: whether a class table is broadcast is decided by
    its size on disk.
    """
    columns = available(df, list(encoder.columns))
    joined, code = df, {}
    for c in columns:
        text, number = f"_{c}_text", f"_{c}_code"
        classes = encoder.classes.filter(F.col("column") == c).select(
            F.col("value").alias(text), F.col("code").alias(number))
        joined = joined.join(classes, class_text(c) == F.col(text), "left")
        code[c] = F.col(number)
    unknown = [code[c].isNull().alias(f"{c}_unknown") for c in columns] if flag_unknown else []
    return joined.select(*df.columns, *[F.coalesce(code[c], F.lit(0)).alias(f"{c}_encoded") for c in columns], *unknown)


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``<col>_mean`` and ``<col>_std`` (population) of every column, in one pass."""
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        value = F.when(~F.isnan(value), value)
        aggregates += [F.avg(value).alias(f"{c}_mean"), F.stddev_pop(value).alias(f"{c}_std")]
    return df.agg(*aggregates)


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    row = scaler_stats(df, columns).first()
    return Scaler({c: (row[f"{c}_mean"] or 0.0, row[f"{c}_std"] or 0.0) for c in columns})


def scaled(c: str, scaler: Scaler) -> Column:
    """(x - mean) / std; a constant column is only centred."""
    mean, std = scaler.stats[c]
    return (F.col(c).cast("double") - F.lit(mean)) / F.lit(std if std > 0 else 1.0)


def scale(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.withColumns({c: scaled(c, scaler) for c in scaler.columns if c in df.columns})


def available(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of ``columns`` that the frame has, in their own order."""
    return [c for c in columns if c in df.columns]


def transform(df: DataFrame, encoder: Encoder, scaler: Scaler, keep: tuple[str, ...] | dict[str, str] = ()) -> DataFrame:
    """Encode, pick the available model features, scale; ``keep`` columns come first, untouched (under new names: ``{new: old}``)."""
    inputs, names = available(df, fv.MODEL_INPUT_COLS), keep if isinstance(keep, dict) else {c: c for c in keep}
    # What is kept of the inputs is read off them at the end: copies would double the rows that the class joins pass on.
    held = {c: c if c in inputs else f"_keep_{c}" for c in names.values()}
    encoded = encode(df.select(*[F.col(c).alias(at) for c, at in held.items() if at != c], *inputs), encoder)
    features = [c for c in available(encoded, fv.MODEL_FEATURE_COLS) if c in scaler.stats]
    return encoded.select(
        *[F.col(held[c]).alias(name) for name, c in names.items()],
        *[scaled(c, scaler).alias(c) for c in features])


def transform_struct(df: DataFrame, encoder: Encoder, scaler: Scaler, name: str = "t") -> DataFrame:
    """All columns of ``df`` plus one struct column holding the transformed features."""
    encoded = encode(df, encoder)
    features = [c for c in available(encoded, fv.MODEL_FEATURE_COLS) if c in scaler.stats]
    return encoded.select(*df.columns, F.struct(*[scaled(c, scaler).alias(c) for c in features]).alias(name))


def with_split(df: DataFrame, key: str, seed: int = fv.SEED, fraction: float = fv.TEST_FRACTION) -> DataFrame:
    """Adds ``split`` ('train' or 'test') by a hash of the key."""
    return df.withColumn("split", F.when(in_test_split(seed, key, fraction), "test").otherwise("train"))
