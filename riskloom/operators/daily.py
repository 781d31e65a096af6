"""Statistics of any range of days from states that are kept per day, without reading the days' rows again.

A state is one row per group and day: counts, a fixed-point sum, extremes, a sketch of distinct
values, and a histogram of value cells. States merge by adding up, so a day may have several of them
(one per batch that brought rows of that day) and a range costs as much as it has days. Counts,
means and extremes are exact; percentiles and distinct counts have a stated error. Where exact ones
are wanted, `operators.statistics.latency_stats` stays the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.numeric import exact
from riskloom.operators.ordered import group_key, nearest_rank

#: Cells per doubling of the magnitude; a percentile is off by half a cell at most, `RELATIVE_ERROR` of its size.
CELLS = 128
RELATIVE_ERROR = 0.5 / CELLS
#: Magnitudes below 2 ** -LOWEST count as zero.
LOWEST = 30
#: Sketches of 2 ** 12 registers: a standard error of 1.7 in a hundred.
REGISTERS_LOG = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (REGISTERS_LOG / 2)


def sketch_cell(value: Column) -> Column:
    """Number of the cell of a finite double: 0 around zero, growing with the value, negative below."""
    size = F.abs(value)
    doubling = F.floor(F.log2(size))
    # A logarithm that is off at a power of two changes nothing: the next doubling's first cell follows this one's last.
    number = (doubling + LOWEST + 1) * CELLS + F.floor((size / F.pow(F.lit(2.0), doubling) - 1) * CELLS)
    return F.when(size < 2.0 ** -LOWEST, F.lit(0)).when(value < 0, -number).otherwise(number).cast("int")


def cell_middle(cell: Column) -> Column:
    """The value in the middle of a cell."""
    number = F.abs(cell)
    doubling = F.floor(number / CELLS)
    size = F.pow(F.lit(2.0), doubling - LOWEST - 1) * (1 + (number - doubling * CELLS + 0.5) / CELLS)
    return F.when(cell == 0, F.lit(0.0)).when(cell < 0, -size).otherwise(size)


def daily_states(df: DataFrame, *, ts: str, value: str, distinct: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``*by, day, n_rows, n, total, lo, hi, seen, cells``: one state per group and day of ``ts``.

    ``n_rows`` counts all rows, the rest those with a finite value; ``seen`` holds the distinct texts
    of ``distinct`` (null and empty ones aside). Rows without a time belong to no day and are left
    out; null groups are a group. The rows are summed per cell first (map-side), so a hot day or
    group is merged from partial counts; a state has at most as many cells as values, some thousands.
    """
    number = F.col(value).cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    rows = df.filter(F.col(ts).isNotNull()).select(group_key(list(by)).alias("_group"), F.to_date(ts).alias("day"), finite.alias("_value"),
                                                   F.nullif(F.col(distinct).cast("string"), F.lit("")).alias("_seen"))
    per_cell = rows.groupBy("_group", "day", sketch_cell(F.col("_value")).alias("cell")).agg(
        F.count("*").alias("n_rows"), F.count("_value").alias("n"), F.sum(exact("_value", 6)).alias("total"), F.min("_value").alias("lo"), F.max("_value").alias("hi"))
    filled = F.when(F.col("cell").isNotNull(), F.struct("cell", "n"))
    measures = per_cell.groupBy("_group", "day").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sort_array(F.collect_list(filled)).alias("cells"))
    seen = rows.groupBy("_group", "day").agg(F.hll_sketch_agg("_seen", REGISTERS_LOG).alias("seen"))
    both = measures.join(seen, ["_group", "day"])
    return both.select(*[F.col("_group")[c].alias(c) for c in by], "day", "n_rows", "n", "total", "lo", "hi", "seen", "cells")


def merged_states(states: DataFrame, percents: dict[str, float], *, by: tuple[str, ...] = (), since: str | None = None, until: str | None = None) -> DataFrame:
    """``*by, n_rows, n, mean, lo, hi, distinct``, and a column per percentile, over the days from ``since`` to ``until`` (both included).

    Percentiles follow the nearest rank and lie within `RELATIVE_ERROR` of the exact value and
    between the extremes; null without values. ``distinct`` lies within `DISTINCT_ERROR` in 997 of
    1000 cases, and may change a little inside that bound with how the rows were split into states;
    all else does not depend on it. No states in the range give no rows. The filter on ``day`` reaches the scan.
    """
    day = F.col("day")
    if since is not None:
        states = states.filter(day >= F.lit(since).cast("date"))
    if until is not None:
        states = states.filter(day <= F.lit(until).cast("date"))
    keyed = states.withColumn("_group", group_key(list(by)))
    sums = keyed.groupBy("_group").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.sum("total").alias("_total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.hll_sketch_estimate(F.hll_union_agg("seen")).alias("distinct"))
    cells = keyed.select("_group", F.inline("cells")).groupBy("_group", "cell").agg(F.sum("n").alias("_rows"))
    one = W.partitionBy("_group")
    placed = cells.withColumn("_end", F.sum("_rows").over(one.orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow))).withColumn("n", F.sum("_rows").over(one))
    tails = placed.groupBy("_group").agg(*[F.min(F.when(F.col("_end") > nearest_rank(p), F.col("cell"))).alias(name) for name, p in percents.items()])
    found = sums.join(tails, "_group", "left")
    kept = [F.least(F.greatest(cell_middle(F.col(name)), "lo"), "hi") for name in percents]
    kept = [F.when(F.col(name).isNotNull(), c).alias(name) for name, c in zip(percents, kept)]
    mean = F.try_divide(F.col("_total").cast("double"), F.col("n")).alias("mean")
    return found.select(*[F.col("_group")[c].alias(c) for c in by], "n_rows", "n", mean, "lo", "hi", "distinct", *kept)
