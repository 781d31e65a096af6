"""Point-in-time (as-of, backward, inclusive) join without one task per key.

Rows are grouped by (key, time cell), so a key that owns a third of all rows is spread over the
cells it is active in. Inside a cell a running ``last`` finds the newest right row; what a cell
inherits comes from a table of one summary row per (key, cell), carried forward over the cells.
Both are read off one shuffle of the two sides together; nothing is multiplied, no pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.times import time_cell


def asof_join(
    left: DataFrame, right: DataFrame, *, on: list[str], left_ts: str, right_ts: str,
    tiebreak: tuple[str, ...] = (), cell_seconds: int = 86400,
) -> DataFrame:
    """Each ``left`` row with the latest ``right`` row of its key where ``right_ts <= left_ts``.

    Left rows without a match keep NULLs. Among right rows of one key and time, the greatest
    ``tiebreak`` wins. ``cell_seconds`` sets the width of a time cell: choose it so that the busiest
    key's rows of one cell fit in a task. Right columns other than the keys are appended.
    """
    payload = [c for c in right.columns if c not in on]
    clash = sorted(set(payload) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    keys = [f"_key{i}" for i in range(len(on))]
    group = [*keys, "_cell"]

    facts = right.filter(F.col(right_ts).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        time_cell(right_ts, cell_seconds).alias("_cell"),
        F.col(right_ts).alias("_ts"),
        F.lit(0).alias("_side"),
        F.struct(F.lit(0).alias("_"), *tiebreak).alias("_tie"),
        F.struct(*payload).alias("_fact"),
    )
    spine = left.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        time_cell(left_ts, cell_seconds).alias("_cell"),
        F.col(left_ts).alias("_ts"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_row"),
    )
    # Rows without a key or time match nothing; they take no part in the shuffle and come back as they are.
    whole = F.lit(True)
    for c in [*keys, "_ts"]:
        whole = whole & F.col(c).isNotNull()
    no_fact = F.lit(None).cast(facts.schema["_fact"].dataType).alias("_found")
    unmatched = spine.filter(~whole).select("_row", no_fact)
    both = spine.unionByName(facts, allowMissingColumns=True).filter(whole).repartition(*group)

    in_cell = (
        W.partitionBy(*group).orderBy("_ts", "_side", "_tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    filled = (
        both.withColumn("_here", F.last("_fact", ignorenulls=True).over(in_cell))
        .filter(F.col("_side") == 1)
        .select(*group, "_row", "_here")
    )
    matched = filled.join(carry_forward(both, keys), group, "left").select("_row", F.coalesce("_here", "_before").alias("_found"))
    return matched.unionByName(unmatched).select("_row.*", "_found.*")


def carry_forward(both: DataFrame, keys: list[str]) -> DataFrame:
    """For each (key, cell) that holds spine rows: the newest fact of the key from any earlier cell.

    It reads the same columns of ``both`` as the join's window does, so that the two share a shuffle."""
    cells = both.groupBy(*keys, "_cell").agg(
        F.max_by("_fact", F.when(F.col("_side") == 0, F.struct("_ts", "_tie"))).alias("_newest"),
        (F.count("_row") > 0).alias("_asked"))
    earlier = W.partitionBy(*keys).orderBy("_cell").rangeBetween(W.unboundedPreceding, -1)
    return (
        cells.withColumn("_before", F.last("_newest", ignorenulls=True).over(earlier))
        .filter("_asked")
        .select(*keys, "_cell", "_before")
    )
