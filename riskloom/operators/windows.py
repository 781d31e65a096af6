"""Time windows: order statistics of sliding windows, and trailing windows that end at every row.

No window is computed from its rows. Rows are summed per tick; ticks are merged into windows. Order
statistics merge histograms of value cells and look at single values only in the cells that hold a
wanted position. A trailing window is the end of one tick, some whole ticks, and the start of
another: each part is a running frame or a sum over ticks, so a series with most of all rows is
spread over its ticks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from riskloom.functions.numeric import exact, ratio
from riskloom.functions.times import epoch_micros, epoch_seconds, whole_div
from riskloom.operators.ordered import group_key, own_shuffle, value_cell

TAILS = {"p95_latency": 95, "p99_latency": 99}
#: Windows whose ticks one task merges, in window lengths, and the copies of ticks' cells it holds at a time.
SPAN, COPIES = 8, 2_000_000


def tick_values(df: DataFrame, *, ts: str, value: str, by: tuple[str, ...], slide_seconds: int) -> DataFrame:
    """``_group, _tick, _value, _cell, _rows``: how often each value occurs in each tick of a group; missing values are left out."""
    measured = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(ts).isNotNull())
    counts = measured.groupBy(group_key(by).alias("_group"), F.window(ts, f"{slide_seconds} seconds")["start"].alias("_tick"), F.col(value).alias("_value")).agg(F.count("*").alias("_rows"))
    return counts.withColumn("_cell", value_cell(F.col("_value")))


def into_windows(ticks: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """A copy of each row for every window that covers its tick."""
    steps = F.explode(F.sequence(F.lit(0), F.lit(window_seconds - slide_seconds), F.lit(slide_seconds)))
    return ticks.select("*", steps.alias("_step")).withColumn("window_start", F.timestamp_add("SECOND", -F.col("_step"), F.col("_tick"))).drop("_step")


def tail_targets(values: DataFrame, percents: dict[str, float], window_seconds: int, slide_seconds: int) -> DataFrame:
    """``_group, window_start, which, _cell, _offset``: the cell of each wanted position of each window, and the position inside it.

    The ticks of a span of windows meet in one task, so that a tick travels once or twice and not once per window; their
    histograms are merged there, a bounded number of copies at a time.
    """
    ticks = (window_seconds - slide_seconds) // slide_seconds + 1
    span = SPAN * ticks
    cells = values.groupBy("_group", "_tick", "_cell").agg(F.sum("_rows").alias("_rows"))
    # A zoned timestamp repeats an hour on its own clock; its instants do not.
    zoned = isinstance(values.schema["_tick"].dataType, TimestampType)
    number = whole_div(F.unix_seconds("_tick") if zoned else epoch_seconds("_tick"), slide_seconds)
    at = F.pmod(number, F.lit(span)).cast("int")
    # The span that a tick lies in, and the one before, of which the last windows reach into this one.
    spans = F.array_compact(F.array(F.struct(F.lit(0).alias("_back"), at.alias("_at")), F.when(at < ticks - 1, F.struct(F.lit(span).alias("_back"), (at + span).alias("_at")))))
    placed = cells.select("_group", "_tick", "_cell", "_rows", at.alias("_in"), F.inline(spans)).select(
        "_group", F.timestamp_add("SECOND", -(F.col("_in") + F.col("_back")) * slide_seconds, F.col("_tick")).alias("_from"), "_at", F.col("_cell").cast("int").alias("_cell"), "_rows")
    schema = StructType([placed.schema["_group"], placed.schema["_from"], *StructType.fromDDL("_window int, which int, _cell int, _offset bigint").fields])
    found = placed.groupBy("_group", "_from").applyInArrow(_places(ticks, span, list(percents.values()), COPIES), schema)
    return found.select("_group", F.timestamp_add("SECOND", F.col("_window") * slide_seconds, F.col("_from")).alias("window_start"), "which", "_cell", "_offset")


def _in_utc(kind: pa.DataType) -> pa.DataType:
    """The type Spark wants back: instants come to a task in the session's zone and must return in UTC."""
    if pa.types.is_struct(kind):
        return pa.struct([f.with_type(_in_utc(f.type)) for f in kind])
    return pa.timestamp("us", tz="UTC") if pa.types.is_timestamp(kind) and kind.tz else kind


def _places(ticks: int, span: int, percents: list[float], most: int):
    """Of one span: which cell of each window holds each wanted position, and at what place."""

    def run(table: pa.Table) -> pa.Table:
        at, cell, rows = (table.column(c).to_numpy() for c in ("_at", "_cell", "_rows"))
        order = np.argsort(at, kind="stable")
        at, cell, rows = at[order], cell[order], rows[order]
        found = []
        low = max(0, int(at[0]) - ticks + 1)
        while low < span and low <= at[-1]:
            # As many windows as keep the copies of the rows within bounds, one at least.
            first = np.searchsorted(at, low)
            high = min(span, max(low + 1, int(at[min(first + most // ticks, len(at) - 1)]) - ticks + 2))
            near = slice(first, np.searchsorted(at, high + ticks - 1))
            if near.stop > near.start:
                found.append(_places_of(low, high, at[near], cell[near], rows[near]))
            low = high
        windows, which, cells, offsets = (np.concatenate([f[i] for f in found]) for i in range(4))
        keys = table.select(["_group", "_from"]).slice(0, 1).take(pa.array(np.zeros(len(windows), np.int64)))
        keys = keys.cast(pa.schema([f.with_type(_in_utc(f.type)) for f in keys.schema]))
        columns = [pa.array(windows.astype(np.int32)), pa.array(which.astype(np.int32)), pa.array(cells), pa.array(offsets)]
        return pa.table([*keys.columns, *columns], names=["_group", "_from", "_window", "which", "_cell", "_offset"])

    def _places_of(low: int, high: int, at: np.ndarray, cell: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        by_cell = np.argsort(cell, kind="stable")
        at, cell, rows = at[by_cell], cell[by_cell], rows[by_cell]
        start = np.maximum(at - (ticks - 1), low)
        copies = np.minimum(at, high - 1) - start + 1
        source = np.repeat(np.arange(len(at)), copies)
        window = start[source] - low + np.arange(len(source)) - np.repeat(np.cumsum(copies) - copies, copies)
        # Rows are in the order of cells; a stable sort by window keeps it.
        by_window = np.argsort(window.astype(np.uint16) if high - low <= 1 << 16 else window, kind="stable")
        source, window = source[by_window], window[by_window]
        cell, end = cell[source], np.cumsum(rows[source])
        begins = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        lasts = np.r_[begins[1:], len(window)] - 1
        before = np.r_[0, end[lasts[:-1]]]
        n = end[lasts] - before
        # The first row of each run of equal cells in a window: what comes before it is before the cell.
        run = np.r_[True, (window[1:] != window[:-1]) | (cell[1:] != cell[:-1])]
        run_start = np.maximum.accumulate(np.where(run, np.arange(len(run)), 0))
        out = []
        for i, p in enumerate(percents):
            position = np.minimum(n * int(p) // 100 if float(p).is_integer() else np.floor(n * float(p) / 100).astype(np.int64), n - 1)
            hit = np.searchsorted(end, before + position, side="right")
            head = run_start[hit]
            reached = np.where(head > 0, end[head - 1], 0)
            out.append((window[hit] + low, np.full(len(hit), i), cell[hit], before + position - reached))
        return tuple(np.concatenate([o[i] for o in out]) for i in range(4))

    return run


def values_of_targets(values: DataFrame, targets: DataFrame, percents: dict[str, float], window_seconds: int, slide_seconds: int) -> DataFrame:
    """``_group, window_start`` and the value of each wanted position.

    Of a stretch of ``window_seconds`` only the values between the least and the greatest cell that any
    window over it wants are copied into windows.
    """
    block = lambda t: whole_div(epoch_seconds(t), window_seconds)
    first = block(F.col("window_start"))
    last = block(F.timestamp_add("SECOND", F.lit(window_seconds - slide_seconds), F.col("window_start")))
    reach = targets.select("_group", "which", "_cell", F.explode(F.array_distinct(F.array(first, last))).alias("_block"))
    reach = reach.groupBy("_group", "_block", "which").agg(F.min("_cell").alias("_low"), F.max("_cell").alias("_high"))
    reach = reach.groupBy("_group", "_block").agg(F.collect_list(F.struct("_low", "_high")).alias("_reach"))
    near = values.withColumn("_block", block(F.col("_tick"))).join(reach, ["_group", "_block"])
    near = near.filter(F.exists("_reach", lambda r: F.col("_cell").between(r["_low"], r["_high"]))).select("_group", "_tick", "_cell", "_value", "_rows")
    hits = into_windows(near, window_seconds, slide_seconds).join(targets, ["_group", "window_start", "_cell"])
    hits = hits.groupBy("_group", "window_start", "which", "_offset", "_value").agg(F.sum("_rows").alias("_rows"))
    upto = W.partitionBy("_group", "window_start", "which").orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = hits.withColumn("_reached", F.sum("_rows").over(upto)).filter("_reached > _offset AND _reached - _rows <= _offset")
    return found.groupBy("_group", "window_start").agg(*[F.max(F.when(F.col("which") == i, F.col("_value"))).alias(name) for i, name in enumerate(percents)])


def window_tails(
    df: DataFrame, *, ts: str, value: str, by: tuple[str, ...] = (), window_seconds: int = 30, slide_seconds: int = 1,
    percents: dict[str, float] = TAILS,
) -> DataFrame:
    """``by`` columns, ``window_start`` and the exact nearest-rank percentiles of every window that holds a value."""
    values = tick_values(df, ts=ts, value=value, by=by, slide_seconds=slide_seconds)
    targets = tail_targets(values, percents, window_seconds, slide_seconds)
    found = values_of_targets(values, targets, percents, window_seconds, slide_seconds)
    return found.select(*[F.col("_group")[c].alias(c) for c in by], "window_start", *percents)


def trailing_per_event(
    df: DataFrame, *, series: list[str], ts: str, succeeded: Column, latency: str, window_seconds: int = 30, tick_seconds: int = 1,
) -> DataFrame:
    """Every row with the statistics of its series over (its time - ``window_seconds``, its time].

    Adds ``window_total, window_successful, success_rate, throughput, avg_latency, max_latency``; latencies
    are those of successes. Rows of the same time see each other; rows without time are left out.
    ``tick_seconds`` divides the window and sets how much one task sorts: a tick of one series. Two
    shuffles of the rows, whatever the window; between them rows carry the sums of their own tick.
    """
    if window_seconds % tick_seconds:
        raise ValueError("the window must be a whole number of ticks")
    ticks, second = window_seconds // tick_seconds, 1_000_000
    micros = epoch_micros(ts)
    rows = df.filter(F.col(ts).isNotNull()).select(
        group_key(series).alias("_group"), micros.alias("_us"), whole_div(micros, tick_seconds * second).alias("_tick"), F.coalesce(succeeded, F.lit(False)).alias("_ok"),
        F.col(latency).alias("_value"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))

    def measures(counted: Column, good: Column) -> list[Column]:
        return [F.count_if(counted), F.count_if(counted & good), F.sum(F.when(counted & good, exact("_value", 6))), F.max(F.when(counted & good, F.col("_value")))]

    names = ("n", "good", "sum", "max")
    yes = F.lit(True)
    own_tick = W.partitionBy("_group", "_tick").orderBy("_us").rangeBetween(W.unboundedPreceding, W.currentRow)
    headed = rows.select("_group", "_us", "_tick", "_row", F.struct(*[m.over(own_tick).alias(n) for m, n in zip(measures(yes, F.col("_ok")), names)]).alias("_head"))

    # What lies between the two end ticks: whole ticks, copied into those they count for.
    whole = rows.groupBy("_group", "_tick").agg(*[m.alias(n) for m, n in zip(measures(yes, F.col("_ok")), names)])
    if ticks > 1:
        middle = whole.select("_group", *names, F.explode(F.sequence(F.col("_tick") + 1, F.col("_tick") + (ticks - 1))).alias("_tick"))
    else:
        middle = whole.filter(F.lit(False)).select("_group", *names, "_tick")
    middle = middle.groupBy("_group", "_tick").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("sum").alias("sum"), F.max("max").alias("max"))
    middle = middle.select("_group", "_tick", F.struct(*names).alias("_middle"))

    # The start of the window lies in an earlier tick: a probe row goes there and sees what is later than it.
    probes = headed.select("_group", (F.col("_us") - window_seconds * second).alias("_us"), (F.col("_tick") - ticks).alias("_tick"), F.lit(0).alias("_side"), "_row", "_head")
    facts = rows.select("_group", "_us", "_tick", F.lit(1).alias("_side"), "_ok", "_value")
    later = W.partitionBy("_group", "_tick").orderBy(F.desc("_us"), "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    fact = F.col("_side") == 1
    both = probes.unionByName(facts, allowMissingColumns=True)
    tailed = both.withColumn("_tail", F.struct(*[m.over(later).alias(n) for m, n in zip(measures(fact, F.col("_ok")), names)])).filter("_side = 0")

    tailed = own_shuffle(tailed.select("_group", (F.col("_tick") + ticks).alias("_tick"), "_row", "_head", "_tail"), "_tick")
    joined = tailed.join(own_shuffle(middle, "_tick"), ["_group", "_tick"], "left")
    parts = [F.col(c) for c in ("_head", "_middle", "_tail")]
    total, good = (sum((F.coalesce(p[n], F.lit(0)) for p in parts[1:]), F.coalesce(parts[0][n], F.lit(0))) for n in ("n", "good"))
    added = sum((F.coalesce(p["sum"], F.lit(0)).cast("decimal(38,6)") for p in parts[1:]), F.coalesce(parts[0]["sum"], F.lit(0)).cast("decimal(38,6)"))
    return joined.select("_row.*", total.alias("window_total"), good.alias("window_successful"), ratio(good * 100, total).alias("success_rate"),
                         (total / F.lit(float(window_seconds))).alias("throughput"), ratio(added.cast("double"), good, None).alias("avg_latency"),
                         F.greatest(*[p["max"] for p in parts]).alias("max_latency"))
