"""Filter interaction audit: how five filters share their work, in every order they could run in.

Each document is a cell of a 2x2x2x2x2 table, pass or fail along the axis of each filter. The table
of a part is all that its audit needs: a step of an order is one contraction of it, with a selector
(pass, fail or all) along each axis. One einsum answers all steps of all orders for many parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import SPACE, apart, let, stored

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
SYMBOLS = "[#$%&*|]"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
CELLS = 2 ** len(FILTERS)
#: What is counted per cell: all documents, those labelled good, those labelled toxic.
CHANNELS = ("n", "good", "toxic")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
#: Parts per contraction; bounds a task's memory.
PARTS = 256
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)


def selectors() -> dict[str, np.ndarray]:
    """Per measure the selector of every step along every axis: an array (orders x steps, filters, 2)."""
    out: dict[str, list] = {"kept": [], "removed": [], "failed": [], "unique_fails": []}
    for order in ORDERS:
        for step, name in enumerate(order):
            before = set(order[:step])
            out["kept"].append([PASS if f in before or f == name else ALL for f in FILTERS])
            out["removed"].append([FAIL if f == name else PASS if f in before else ALL for f in FILTERS])
            out["failed"].append([FAIL if f == name else ALL for f in FILTERS])
            out["unique_fails"].append([FAIL if f == name else PASS for f in FILTERS])
    return {k: np.array(v, np.int64) for k, v in out.items()}


def contracted(tables: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """``tables`` (parts, 2, 2, 2, 2, 2, channels) summed over what each row of ``chosen`` selects: (parts, rows, channels)."""
    return np.einsum("pabcdez,ka,kb,kc,kd,ke->pkz", tables, *[chosen[:, i] for i in range(len(FILTERS))], optimize=True)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chosen, per = selectors(), len(ORDERS) * STEPS
    names = np.array([o for o in ORDERS for _ in range(STEPS)], dtype=object)
    steps = np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))
    at_filter = np.array([FILTERS.index(c) for o in ORDERS for c in o])
    for batch in batches:
        for at in range(0, batch.num_rows, PARTS):
            some = batch.slice(at, PARTS)
            n = some.num_rows
            tables = np.stack([np.asarray(some.column(c).flatten(), np.int64).reshape(n, *[2] * len(FILTERS)) for c in CHANNELS], axis=-1)
            found = {k: contracted(tables, v) for k, v in chosen.items()}
            removed = found["removed"]
            shapley = np.zeros((n, len(FILTERS)), np.int64)
            for f in range(len(FILTERS)):
                shapley[:, f] = removed[:, at_filter == f, 0].sum(axis=1)
            measures = {"kept": found["kept"][..., 0], "removed": removed[..., 0], "redundant": found["failed"][..., 0] - removed[..., 0],
                        "unique_fails": found["unique_fails"][..., 0], "good_lost": removed[..., 1], "toxic_lost": removed[..., 2], "shapley": shapley[:, at_filter]}
            part = some.column("part").take(pa.array(np.repeat(np.arange(n), per)))
            yield pa.RecordBatch.from_arrays(
                [part, pa.array(np.tile(names, n), pa.string()), pa.array(np.tile(steps, n)), *[pa.array(np.ascontiguousarray(measures[m]).ravel()) for m in MEASURES]],
                names=["part", "filter_order", "step", *MEASURES])


def cell_of(text: Column, repeated: Column) -> Column:
    """The document's cell: five bits, that of filter A the highest, set where it fails."""
    def of(words: Column) -> Column:
        n = F.size(words)
        few, alike = n < LEAST_WORDS, F.size(F.array_distinct(words)) * 100 < n * LEAST_DISTINCT
        return few.cast("int") * 16 + alike.cast("int") * 8

    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * MOST_CAPITALS
    words = let(F.array_remove(F.split(text, SPACE, -1), ""), of)
    return words + capitals.cast("int") * 4 + text.rlike(SYMBOLS).cast("int") * 2 + repeated.cast("int")


def tested(docs: DataFrame) -> DataFrame:
    """``doc_id, part, cell`` for every row of ``docs``: which filters it fails.

    Only E looks beyond the row: equal texts are told by two hashes (64 and 128 bits), of which a
    table keeps the smallest doc_id. Texts are read once and never shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.xxhash64(text).alias("mark"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), cell_of(text, F.lit(False)).cast("int").alias("cell"))
    rows = stored(rows, "audit-rows")
    several = rows.groupBy("mark", "digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    joined = rows.join(apart(several, "mark"), ["mark", "digest"], "left")
    return joined.select("doc_id", "part", (F.col("cell") + F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")).alias("cell"))


def contingency(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part`` and per channel an array of the counts of its 32 cells."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).where("doc_id is not null and (good or toxic)")
    known = known.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    cells = tested(docs).join(apart(known, "doc_id"), "doc_id", "left").groupBy("part", "cell").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce("good", F.lit(False))).alias("good"), F.count_if(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    return cells.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("cell") == i, F.col(c))), F.lit(0)) for i in range(CELLS)]).alias(c) for c in CHANNELS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the measures of that step: a row per part, order of the filters and step, zeros included.

    Parts are sources; a null source is the part ``''``, as is an empty one. A null text is empty: it
    fails A and passes B and C. Repeated rows count as often as they come; none is smaller than its
    own doc_id, so rows of one doc_id repeat nothing in each other. A row without id repeats nothing, no row repeats it, and it has
    no label. A document is good or toxic if any of its label rows says so. No documents give no rows; no labels
    lose nothing. Other columns are not read. The work behind the texts is on 32 cells per part:
    a part that holds most rows is summed where it is read.
    """
    return contingency(docs, labels).mapInArrow(_audits, SCHEMA)
