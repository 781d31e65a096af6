"""Positions and order statistics of ordered groups, without one task per group.

A group is cut into cells by a function that grows with the order (time cells, value cells, name
prefixes). Cells are sorted independently; where a cell starts comes from the running sum of the
cell counts, a table with one row per (group, cell). A group with a third of all rows is sorted by
as many tasks as it has cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.times import epoch_micros, time_cell

CELLS_PER_DOUBLING = 1024


def group_key(by: list[str]) -> Column:
    """The grouping columns as one struct: NULL group values compare equal to each other in joins."""
    return F.struct(F.lit(0).alias("_"), *by)


def own_shuffle(df: DataFrame, key: str) -> DataFrame:
    """The same rows with the whole-number ``key`` computed anew, so that a join on it shuffles them for itself:
    Spark splits a hot key only between two shuffles of the join's own."""
    return df.withColumn(key, F.bitwise_not(F.bitwise_not(F.col(key).cast("bigint"))))


def with_position(df: DataFrame, by: list[str], order: list, cell: Column) -> DataFrame:
    """Adds ``position`` (0-based, in ``order`` within ``by``) and ``group_rows`` (rows of the group).

    ``cell`` must be non-NULL and grow with ``order``.
    """
    keyed = df.withColumn("_group", group_key(by)).withColumn("_cell", cell)
    cells = keyed.groupBy("_group", "_cell").agg(F.count("*").alias("_rows"))
    before = W.partitionBy("_group").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select(
        "_group", "_cell",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(W.partitionBy("_group")).alias("group_rows"))
    rank = F.row_number().over(W.partitionBy("_group", "_cell").orderBy(*order))
    return (
        keyed.withColumn("_rank", rank)
        .join(starts, ["_group", "_cell"])
        .withColumn("position", F.col("_start") + F.col("_rank") - 1)
        .drop("_group", "_cell", "_rank", "_start")
    )


BOUNDS, SAMPLED, BOUND_CHARS = 63, 1024, 64


def text_cell(df: DataFrame, column: str) -> Column:
    """A cell for `with_position` that cuts a text column evenly, however alike its values begin.

    The bounds come from a sample (by hash, so reruns agree) of `SAMPLED` values, of which at most
    `BOUND_CHARS` characters each are needed; the cell of a value is how many bounds it has reached.
    """
    drawn = df.select(F.substring(column, 1, BOUND_CHARS).alias("b"), F.xxhash64(column).alias("h")).orderBy("h", "b").limit(SAMPLED)
    bounds = sorted({r["b"].encode() for r in drawn.collect() if r["b"]})
    step = max(1, len(bounds) // (BOUNDS + 1))
    chosen = [b.decode() for b in bounds[step::step]][:BOUNDS]
    return F.size(F.filter(F.array(*map(F.lit, chosen)), lambda b: b <= F.col(column))) if chosen else F.lit(0)


def dense_codes(values: DataFrame, by: list[str], value: str) -> DataFrame:
    """0-based code of each (distinct) text value in sorted order within ``by``."""
    return with_position(values, by, [value], text_cell(values, value)).select(
        *by, value, F.col("position").cast("int").alias("code"))


def values_at(df: DataFrame, by: list[str], value: str, positions: dict[str, Column]) -> DataFrame:
    """Exact order statistics: per group, the sorted value at each 0-based position.

    ``positions`` maps an output name to a position expressed over the column ``n`` (non-missing
    rows of the group). NULL and NaN values are left out; values keep their type. Output: ``by``
    columns, ``n`` and one column per name; groups without any value do not appear.

    Equal values merge before they travel; then only the cells that hold a wanted position are
    sorted. The cell of a value depends on the value alone, so the data is read once and an outlier
    changes no other value's cell.
    """
    counts = (
        df.select(*by, F.col(value).alias("_value"))
        .filter(F.col("_value").isNotNull() & ~F.isnan(F.col("_value").cast("double")))
        .groupBy(group_key(by).alias("_group"), "_value").agg(F.count("*").alias("_rows"))
    )
    placed = counts.select("_group", "_value", "_rows", value_cell(F.col("_value")).alias("_cell"))

    cells = placed.groupBy("_group", "_cell").agg(F.sum("_rows").alias("_rows"))
    running = W.partitionBy("_group").orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    wanted = [
        F.struct(F.lit(i).alias("which"), p.cast("bigint").alias("position"))
        for i, p in enumerate(positions.values())
    ]
    targets = (
        cells.withColumn("_end", F.sum("_rows").over(running))
        .withColumn("n", F.sum("_rows").over(W.partitionBy("_group")))
        .select("_group", "_cell", "n", (F.col("_end") - F.col("_rows")).alias("_start"), "_end",
                F.inline(F.array(*wanted)))
        .filter((F.col("position") >= F.col("_start")) & (F.col("position") < F.col("_end")))
        .select("_group", "_cell", "n", "which", (F.col("position") - F.col("_start")).alias("_offset"))
    )
    in_cell = W.partitionBy("_group", "_cell", "which").orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow)
    hits = (
        placed.join(targets, ["_group", "_cell"])
        .withColumn("_reached", F.sum("_rows").over(in_cell))
        .filter((F.col("_reached") > F.col("_offset")) & (F.col("_reached") - F.col("_rows") <= F.col("_offset")))
    )
    picks = [F.max(F.when(F.col("which") == i, F.col("_value"))).alias(name) for i, name in enumerate(positions)]
    found = hits.groupBy("_group").agg(F.max("n").alias("n"), *picks)
    return found.select(*[F.col("_group")[c].alias(c) for c in by], "n", *positions)


def value_cell(value: Column) -> Column:
    """A whole number that grows with the value: `CELLS_PER_DOUBLING` cells between a value and its
    double, on either side of zero. There are at most a few million cells, however much data there is."""
    v = value.cast("double")
    size = F.when(F.abs(v) == float("inf"), F.lit(1025.0)).otherwise(F.log2(F.abs(v)))
    from_zero = F.floor(size * CELLS_PER_DOUBLING).cast("int") + 1100 * CELLS_PER_DOUBLING
    return F.when(v == 0, F.lit(0)).when(v > 0, from_zero).otherwise(-from_zero)


def nearest_rank(percent: float) -> Column:
    """Position of the nearest-rank percentile: floor(n x percent / 100), at most the last."""
    n = F.col("n")
    if float(percent).is_integer():
        scaled = n * int(percent)
        index = ((scaled - scaled % 100) / 100).cast("bigint")
    else:
        index = F.floor(n * F.lit(float(percent)) / 100).cast("bigint")
    return F.least(index, n - 1)


def nearest_rank_percentiles(df: DataFrame, by: list[str], value: str, percents: dict[str, float]) -> DataFrame:
    return values_at(df, by, value, {name: nearest_rank(p) for name, p in percents.items()})


def interpolated_quantiles(df: DataFrame, by: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Quantiles with linear interpolation between the two neighbouring values."""
    positions: dict[str, Column] = {}
    for name, q in quantiles.items():
        rank = (F.col("n") - 1) * F.lit(q)
        positions[f"_low_{name}"] = F.floor(rank)
        positions[f"_high_{name}"] = F.ceil(rank)
    found = values_at(df, by, value, positions)
    rank = {name: (F.col("n") - 1) * F.lit(q) for name, q in quantiles.items()}
    return found.select(*by, "n", *[
        (F.col(f"_low_{name}") + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * (rank[name] - F.floor(rank[name]))).alias(name)
        for name in quantiles
    ])


def rolling_throughput(
    df: DataFrame, series: list[str], ts: str, tiebreak: tuple[str, ...] = (), *,
    widest: int = 20, share: int = 4, cell_seconds: int = 3600, min_rows: int = 11,
) -> DataFrame:
    """Events per second over the last ``w`` events at each event: w / (ts[i] - ts[i - w]).

    ``w`` is ``widest``, or a ``share``-th of the series if that is less. Rows without ``w``
    predecessors, or with no time between, are left out, and so are series of under ``min_rows``
    rows. Each row meets its ``w``-th predecessor by its position: an equi-join on (series,
    position), in which every row has one partner and no series is gathered.
    """
    timed = df.filter(F.col(ts).isNotNull())
    placed = with_position(timed, series, [ts, *tiebreak], time_cell(ts, cell_seconds))
    window = F.least(F.lit(widest), F.floor(F.col("group_rows") / share)).cast("bigint")
    placed = placed.filter(F.col("group_rows") >= min_rows).withColumn("window_rows", window).filter("window_rows > 0")
    placed = placed.withColumn("_group", group_key(series))
    before = placed.select("_group", (F.col("position") + F.col("window_rows")).alias("position"), F.col(ts).alias("_from"))
    seconds = (epoch_micros(ts) - epoch_micros("_from")) / F.lit(1_000_000)
    return (
        placed.join(before, ["_group", "position"])
        .withColumn("window_seconds", seconds)
        .filter(F.col("window_seconds") > 0)
        .withColumn("throughput", F.col("window_rows") / F.col("window_seconds"))
        .select(*df.columns, "window_rows", "window_seconds", "throughput")
    )
