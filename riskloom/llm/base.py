"""Shared by the operators: reading tables, intermediate tables, bounded slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.scratch import new_folder
from riskloom.sources.tables import remove

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read back.

    Lineage ends there: a lost executor costs its unfinished tasks only, and what is read twice
    is computed once.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark keeps them until the driver's JVM collects the plans
    they belong to, which on a large driver may be long after."""
    spark.sparkContext._jvm.System.gc()


def discarded(first: DataFrame, *others: DataFrame) -> None:
    """Delete tables made by `stored` that nothing reads any more, and what Spark holds of the steps that made them:
    whoever needed them has been stored itself."""
    for df in (first, *others):
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            remove(df.sparkSession, folder)
    released(first.sparkSession)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_row(df: DataFrame) -> Column:
    """All columns of a frame as one struct, so that no name of theirs can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unwrapped(df: DataFrame, columns: list[str], row: str = "row") -> DataFrame:
    """The columns of such a struct."""
    return df.select(*[F.col(row)[c].alias(c) for c in columns])


def apart(df: DataFrame, key: str) -> DataFrame:
    """The same rows with the long ``key`` computed anew.

    A join on it then shuffles them for itself instead of taking over the partitions of the aggregate
    they come from, and only between two shuffles of its own does Spark split a hot key of the other side.
    """
    return df.withColumn(key, F.bitwise_not(F.bitwise_not(F.col(key))))


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; an absent id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of one text or binary column, at least one row each."""
    for batch in batches:
        values = batch.column(column)
        if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
            values = values.cast(pa.large_binary())
        sizes = [0 if n is None else n for n in pa.compute.binary_length(values).to_pylist()]
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
