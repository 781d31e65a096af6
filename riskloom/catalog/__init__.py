"""Registered queries over the star-schema test tables, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A query and its SQL twin; ``sql`` is None where SQL cannot express the result."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
